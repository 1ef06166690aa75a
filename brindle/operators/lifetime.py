"""Repeat purchases (BG/NBD) and spend (Gamma-Gamma): likelihoods and gradients summed over partitions, expectations as sums over the number of purchases.

A round of a fit sends a few candidate parameters to the tasks and gets one row of sums a task back, so the driver holds a handful of numbers however many
customers or histories there are. Steps follow a quasi-Newton direction; several lengths are tried in one pass.

Frequencies are whole numbers, so the gamma and beta functions of BG/NBD are rising products, looked up from running sums of logarithms. Given that a customer is
alive, the purchases to come are a negative binomial number of chances, of which the n-th counts if none before it was the last one: the expectation is a sum of
positive terms, computed by recurrences.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Step lengths that a round tries.
STEPS = (1.0, 0.5, 0.2, 0.05, 0.01, 2.0)

Terms = Callable[[np.ndarray, list[np.ndarray]], tuple[np.ndarray, list[np.ndarray]]]


def rising(start: float, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For whole x: sum of log(start + j) and of 1 / (start + j) over 0 <= j < x."""
    z = start + np.arange(int(x.max(initial=0)))
    logs, inverse = (np.concatenate([[0.0], np.cumsum(v)]) for v in (np.log(z), 1 / z))
    i = x.astype(np.int64)
    return logs[i], inverse[i]


def log_odds(p: np.ndarray, x: np.ndarray, tx: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log odds of having left after the last purchase; -inf without one."""
    r, alpha, a, b = p
    some = x > 0
    u = math.log(a) - np.log(np.where(some, b + x - 1, 1.0)) + (r + x) * np.log((alpha + t) / (alpha + tx))
    return np.where(some, u, -np.inf)


def purchase_terms(p: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log likelihood of each (frequency, recency, T), and its slopes by r, alpha, a and b."""
    r, alpha, a, b = p
    x, tx, t = rows
    u = log_odds(p, x, tx, t)
    gone = 1 / (1 + np.exp(-np.clip(u, -700, 700))) * (x > 0)
    rate, rate_ = rising(r, x)
    stay, stay_ = rising(b, x)
    all_, all__ = rising(a + b, x)
    span, last = np.log(alpha + t), np.log(alpha + tx)
    value = rate + r * math.log(alpha) - (r + x) * span + stay - all_ + np.logaddexp(0.0, u)
    by_alpha = r / alpha - (r + x) / (alpha + t) + gone * (r + x) * (1 / (alpha + t) - 1 / (alpha + tx))
    left = np.where(x > 0, b + x - 1, 1.0)
    return value, [rate_ + math.log(alpha) - span + gone * (span - last), by_alpha, gone / a - all__, stay_ - all__ - gone / left]


def stirling(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log gamma and digamma of positive numbers: moved up to 8 and more, then the asymptotic series."""
    z = np.array(z, dtype=float)
    lift, lift_ = np.zeros_like(z), np.zeros_like(z)
    for _ in range(8):
        low = z < 8
        lift += np.where(low, np.log(np.where(low, z, 1.0)), 0.0)
        lift_ += np.where(low, 1 / z, 0.0)
        z = z + low
    w = 1 / (z * z)
    log = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + (1 / 12 - w * (1 / 360 - w * (1 / 1260 - w / 1680))) / z
    psi = np.log(z) - 0.5 / z - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w / 240)))
    return log - lift, psi - lift_


def spend_terms(p: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log likelihood of each (frequency, mean value), and its slopes by p, q and g."""
    shape, q, g = p
    x, v = rows
    k = shape * x
    whole, part = g + x * v, x * v
    (both, both_), (own, own_), (one, one_) = stirling(k + q), stirling(k), stirling(np.array([q]))
    log_part, log_rest = np.log(part / whole), np.log(g / whole)
    value = both - own - one + k * log_part + q * log_rest - np.log(v)
    return value, [x * (both_ - own_ + log_part), both_ - one_ + log_rest, q / g - (k + q) / whole]


def sums(df: DataFrame, columns: Sequence[str], terms: Terms, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means over the rows of the value and of its slopes by the logs of the parameters, for each row of ``at`` (logs)."""
    wide = at.shape[1] + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((len(at), wide)), 0
        for pdf in batches:
            rows = [pdf[c].to_numpy(dtype=float) for c in columns]
            for i, logs in enumerate(at):
                p = np.exp(logs)
                value, slopes = terms(p, rows)
                total[i] += [value.sum(), *[s.sum() * k for s, k in zip(slopes, p, strict=True)]]
            n += len(pdf)
        yield pd.DataFrame({"i": [*range(len(at)), len(at)], **{f"s{j}": [*total[:, j], float(n)] for j in range(wide)}})

    parts = df.select(*[F.col(c).cast("double") for c in columns]).mapInPandas(run, "i int, " + ", ".join(f"s{j} double" for j in range(wide)))
    got = {r["i"]: r for r in parts.groupBy("i").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(wide)]).collect()}  # a row a candidate
    n = max(1.0, got[len(at)]["s0"])
    out = np.array([[got[i][f"s{j}"] for j in range(wide)] for i in range(len(at))]) / n
    return out[:, 0], out[:, 1:]


def maximise(df: DataFrame, columns: Sequence[str], terms: Terms, start: Sequence[float], penalty: float = 0.0, rounds: int = 80, tol: float = 1e-7, limit: float = 12.0) -> np.ndarray:
    """The parameters with the largest mean log likelihood, less penalty times their squares."""

    def measure(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value, slope = sums(df, columns, terms, at)
        return value - penalty * np.exp(2 * at).sum(axis=1), slope - 2 * penalty * np.exp(2 * at)

    here = np.log(np.array(start, dtype=float))
    value, slope = (v[0] for v in measure(here[None, :]))
    inverse = np.eye(len(here))
    for _ in range(rounds):
        way = inverse @ slope
        if way @ slope <= 0:
            inverse, way = np.eye(len(here)), slope
        way = way / max(1.0, np.abs(way).max())
        at = np.clip(here + np.outer(STEPS, way), -limit, limit)
        values, slopes = measure(at)
        k = int(np.nanargmax(values))
        if not values[k] > value + 1e-12:
            if np.allclose(inverse, np.eye(len(here))):
                break
            inverse = np.eye(len(here))  # once more along the slope itself
            continue
        step, turn = at[k] - here, slope - slopes[k]
        gained = values[k] - value
        here, value, slope = at[k], values[k], slopes[k]
        if np.abs(slope).max() < tol or gained < 1e-11:
            break
        if (c := step @ turn) > 1e-12:
            move = np.eye(len(here)) - np.outer(step, turn) / c
            inverse = move @ inverse @ move.T + np.outer(step, step) / c
    return np.exp(here)


def fit_bgnbd(summary: DataFrame, penalty: float = 1e-3) -> np.ndarray:
    """r, alpha, a, b from (frequency, recency, T)."""
    return maximise(summary, ["frequency", "recency", "T"], purchase_terms, [1.0] * 4, penalty)


def fit_gamma_gamma(summary: DataFrame) -> np.ndarray:
    """p, q, g of the spend model, from the customers with repeat purchases."""
    some = summary.where("frequency > 0 and monetary > 0")
    mean = some.agg(F.avg("monetary")).first()[0] or 1.0
    return maximise(some, ["frequency", "monetary"], spend_terms, [1.0, 1.6, mean], limit=20.0)


def hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray, terms: int = 2000) -> np.ndarray:
    """Gauss series, for 0 <= z < 1."""
    out = term = np.ones(np.broadcast(a, b, c, z).shape)
    for k in range(terms):
        term = term * (a + k) * (b + k) / (c + k) / (k + 1) * z
        out = out + term
        if np.all(np.abs(term) < 1e-12 * np.abs(out)):
            break
    return out


def to_come(p: np.ndarray, x: np.ndarray, t: np.ndarray, ahead: np.ndarray, terms: int = 20_000) -> np.ndarray:
    """(rows, len(ahead)): expected purchases in the next ``ahead`` weeks of customers that are alive."""
    r, alpha, a, b = p
    shape, stay = (r + x)[:, None], (b + x)[:, None]
    u = ahead[None, :] / (alpha + t[:, None] + ahead[None, :])
    mass = (1 - u) ** shape
    seen, out = mass.copy(), np.zeros_like(mass)
    chance, count = np.ones_like(stay), np.zeros_like(stay)
    for n in range(terms):
        # The n+1-th purchase happens if all before it let the customer stay.
        count = count + chance
        chance = chance * (stay + n) / (a + stay + n)
        mass = mass * (shape + n) / (n + 1) * u
        seen = seen + mass
        out = out + mass * count
        if np.all((1 - seen) * (count + 1) < 1e-10):
            break
    return out


def lifetime_values(summary: DataFrame, bg: Sequence[float], gg: Sequence[float], key: str = "customer_id", weeks: float = 52.0, discount: float = 0.10) -> DataFrame:
    """(key, p_alive, purchases, order_value, value): expected purchases by month, discounted, times expected order value."""
    chance, (shape, q, g) = np.array([float(v) for v in bg]), (float(v) for v in gg)
    month = 4.345
    ends = month * np.arange(1, int(round(weeks / month)) + 1)
    worth = (1 + discount) ** (-np.arange(1, len(ends) + 1) / 12.0)
    # Discounting the months' shares of a running sum is the same as weighing the sum itself by how much the worth falls.
    fall = worth - np.append(worth[1:], 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, tx, t, m = (pdf[c].to_numpy(dtype=float) for c in ("frequency", "recency", "T", "monetary"))
            alive = 1 / (1 + np.exp(np.clip(log_odds(chance, x, tx, t), -700, 700))) if len(x) else x
            ahead = alive[:, None] * to_come(chance, x, t, ends)
            order = shape * (g + np.where(x > 0, x * m, 0.0)) / (shape * x + q - 1)
            yield pd.DataFrame({key: pdf[key], "p_alive": alive, "purchases": ahead[:, -1], "order_value": order, "value": order * (ahead @ fall)})

    return summary.select(key, "frequency", "recency", "T", "monetary").mapInPandas(run, f"{key} {summary.schema[key].dataType.simpleString()}, p_alive double, purchases double, order_value double, value double")
