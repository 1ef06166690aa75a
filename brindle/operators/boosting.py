"""Boosted trees on histograms, for any loss that gives a gradient and a hessian per row.

Features are cut into bins once, at approximate quantiles. A level of all trees of a round is one aggregate: rows meet as sums of gradient, hessian and count by
(loss, node, feature, bin), at most losses x 2^depth x features x bins of them, whatever the rows. The driver sees these sums only; it picks the splits and sends
them back as a column expression. Several losses on the same rows (a point forecast and its quantiles) grow side by side in the same passes.

A missing feature has a bin of its own, the lowest. A node is split where the gain is largest (ties: first feature, lowest bin), with MIN_ROWS rows
on either side. Scores are rewritten every STAGE rounds, so that plans stay short.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .graph import _checkpoint, _forget

BINS = 32
STAGE = 4


@dataclass(frozen=True)
class Loss:
    """start: aggregate for the first score. slope: (gradient, hessian) of (score, label). quantile: leaves become this quantile of label - score."""

    start: Callable[[Column], Column]
    slope: Callable[[Column, Column], tuple[Column, Column]]
    quantile: float | None = None
    link: str = "identity"


def squared() -> Loss:
    return Loss(F.avg, lambda f, y: (f - y, F.lit(1.0)))


def logistic() -> Loss:
    p = lambda f: 1 / (1 + F.exp(-f))
    return Loss(lambda y: F.log((F.sum(y) + 0.5) / (F.sum(1 - y) + 0.5)), lambda f, y: (p(f) - y, p(f) * (1 - p(f))), link="sigmoid")


def tweedie(power: float = 1.3) -> Loss:
    a, b = 1 - power, 2 - power
    return Loss(lambda y: F.log(F.greatest(F.avg(y), F.lit(1e-6))), lambda f, y: (F.exp(b * f) - y * F.exp(a * f), b * F.exp(b * f) - a * y * F.exp(a * f)), link="exp")


def pinball(q: float) -> Loss:
    """Trees follow the loss's slope; each leaf is then fitted as the conditional quantile of what is left."""
    return Loss(lambda y: F.percentile_approx(y, F.lit(q), F.lit(10_000)), lambda f, y: (F.when(y < f, 1.0).otherwise(0.0) - q, F.lit(1.0)), q)


def given() -> Loss:
    """The caller's own slopes (``lists``); scores start at 0."""
    return Loss(lambda y: F.lit(0.0), lambda f, y: (F.col("g"), F.col("h")))


@dataclass
class Tree:
    """Nodes in heap order (children of n: 2n, 2n + 1). split: node -> (feature, last bin that goes left); value: leaf -> score."""

    split: dict[int, tuple[int, int]] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)

    def walk(self, leaf: Callable[[int], Column], n: int = 1) -> Column:
        if n not in self.split:
            return leaf(n)
        f, b = self.split[n]
        return F.when(F.get("bins", F.lit(f)) <= b, self.walk(leaf, 2 * n)).otherwise(self.walk(leaf, 2 * n + 1))

    def score(self) -> Column:
        return self.walk(lambda n: F.lit(float(self.value.get(n, 0.0))))

    def scores(self, bins: np.ndarray) -> np.ndarray:
        at = np.ones(len(bins), dtype=np.int64)
        for n in sorted(self.split):
            f, b = self.split[n]
            here = at == n
            at[here] = 2 * n + (bins[here, f] > b)
        out = np.zeros(len(bins))
        for n in np.unique(at):
            out[at == n] = self.value.get(int(n), 0.0)
        return out


@dataclass
class Boosted:
    columns: list[str]
    edges: list[list[float]]
    rate: float
    links: list[str]
    start: list[float]
    trees: list[list[Tree]] = field(default_factory=list)

    def bin(self, x: np.ndarray) -> np.ndarray:
        """0 for missing, else 1 and up."""
        out = np.stack([np.searchsorted(e, x[:, j], side="right") + 1 for j, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(self.edges)), dtype=np.int64)
        out[np.isnan(x)] = 0
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self.bin(x)
        return np.stack([s + self.rate * sum((t.scores(b) for t in trees), np.zeros(len(b))) for s, trees in zip(self.start, self.trees, strict=True)], axis=1)

    def predict(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """Adds a column per loss, in Arrow batches."""
        links = {"identity": lambda z: z, "exp": np.exp, "sigmoid": lambda z: 1 / (1 + np.exp(-z))}

        @F.pandas_udf("array<double>")
        def score(*x: pd.Series) -> pd.Series:
            z = self.raw(np.stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in x], axis=1))
            return pd.Series(list(np.stack([links[k](z[:, m]) for m, k in enumerate(self.links)], axis=1)))

        out = df.withColumn("_p", score(*[F.col(c).cast("double") for c in self.columns]))
        return out.withColumns({n: F.get("_p", F.lit(m)) for m, n in enumerate(names)}).drop("_p")

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "edges": self.edges, "rate": self.rate, "links": self.links, "start": self.start, "trees": [[{"split": list(t.split.items()), "value": list(t.value.items())} for t in ts] for ts in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Boosted:
        d = json.loads(text)
        trees = [[Tree({n: (s[0], s[1]) for n, s in t["split"]}, dict(map(tuple, t["value"]))) for t in ts] for ts in d.pop("trees")]
        return cls(**d, trees=trees)

    def gains(self) -> dict[str, int]:
        """How often each feature splits."""
        used = [f for ts in self.trees for t in ts for f, _ in t.split.values()]
        return {c: used.count(j) for j, c in enumerate(self.columns)}


def edges_of(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    at = df.approxQuantile(list(columns), [i / bins for i in range(1, bins)], 0.2 / bins)
    return [sorted(set(e)) for e in at]


def binned(df: DataFrame, model: Boosted) -> DataFrame:
    @F.pandas_udf("array<int>")
    def cut(*x: pd.Series) -> pd.Series:
        return pd.Series(list(model.bin(np.stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in x], axis=1)).astype(np.int32)))

    return df.withColumn("bins", cut(*[F.col(c).cast("double") for c in model.columns]))


def best_splits(sums: pd.DataFrame, wide: int, reg: float, min_rows: int) -> dict[tuple[int, int], tuple]:
    """sums: m, node, feature, bin, g, h, n. Per (m, node): (feature, bin, left (g, h), right (g, h)), or None."""
    out: dict[tuple[int, int], tuple] = {}
    for (m, node), part in sums.groupby(["m", "node"]):
        d = int(part.feature.max()) + 1
        grid = np.zeros((3, d, wide))
        for i, c in enumerate(("g", "h", "n")):
            grid[i, part.feature.to_numpy(), part.bin.to_numpy()] = part[c].to_numpy()
        left = np.cumsum(grid, axis=2)[:, :, :-1]
        right = grid.sum(axis=2)[:, :, None] - left
        gain = left[0] ** 2 / (left[1] + reg) + right[0] ** 2 / (right[1] + reg) - grid[0].sum(axis=1)[:, None] ** 2 / (grid[1].sum(axis=1)[:, None] + reg)
        gain = np.where((left[2] >= min_rows) & (right[2] >= min_rows), gain, -np.inf)
        at = int(np.argmax(np.round(gain, 9)))
        f, b = divmod(at, wide - 1)
        total = (float(grid[0, 0].sum()), float(grid[1, 0].sum()))
        out[int(m), int(node)] = (f, b, (float(left[0, f, b]), float(left[1, f, b])), (float(right[0, f, b]), float(right[1, f, b])), total) if gain[f, b] > 1e-9 else (None, None, None, None, total)
    return out


def grow(df: DataFrame, slopes: Sequence[tuple[Column, Column]], losses: Sequence[Loss], depth: int, wide: int, reg: float, min_rows: int, label: str) -> list[Tree]:
    """One tree per loss on rows with ``bins`` and the scores f0, f1, ..."""
    trees, open_ = [Tree() for _ in losses], {(m, 1) for m in range(len(losses))}
    for level in range(depth):
        if not open_:
            break
        # Leaves that no longer grow are left out of the sums.
        part = [F.struct(F.lit(m).alias("m"), t.walk(lambda n, m=m: F.lit(n if (m, n) in open_ else None).cast("int")).alias("node"), g.cast("double").alias("g"), h.cast("double").alias("h")) for m, (t, (g, h)) in enumerate(zip(trees, slopes, strict=True))]
        rows = df.select("bins", F.explode(F.array(*part)).alias("x")).where("x.node is not null").select("x.*", F.posexplode("bins").alias("feature", "bin"))
        sums = rows.groupBy("m", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")).toPandas()
        step, open_ = best_splits(sums, wide, reg, min_rows), set()
        for (m, n), (f, b, left, right, total) in step.items():
            leaf = lambda s: -s[0] / (s[1] + reg)
            if f is None:
                trees[m].value[n] = leaf(total)
                continue
            trees[m].split[n] = (int(f), int(b))
            trees[m].value.pop(n, None)
            trees[m].value |= {2 * n: leaf(left), 2 * n + 1: leaf(right)}
            open_ |= {(m, 2 * n), (m, 2 * n + 1)}
    if any(x.quantile is not None for x in losses):
        at = [(m, x.quantile) for m, x in enumerate(losses) if x.quantile is not None]
        part = F.array(*[F.struct(F.lit(i).alias("i"), trees[m].walk(F.lit).alias("node"), (F.col(label) - F.col(f"f{m}")).alias("left")) for i, (m, _) in enumerate(at)])
        rest = df.select(F.explode(part).alias("x")).groupBy("x.i", "x.node").agg(F.percentile_approx("x.left", F.array(*[F.lit(q) for _, q in at]), F.lit(10_000)).alias("v"))
        for r in rest.collect():  # leaves only
            trees[at[r.i][0]].value[r.node] = float(r.v[r.i])
    return trees


def fit(train: DataFrame, columns: Sequence[str], label: str, losses: Sequence[Loss], rounds: int = 20, depth: int = 4, rate: float = 0.1, bins: int = BINS, reg: float = 1.0, min_rows: int = 20, slopes: Callable[[DataFrame], DataFrame] | None = None, keep: Sequence[str] = (), watch: Callable[[DataFrame], float] | None = None, valid: DataFrame | None = None, patience: int = 5, by: Sequence[str] = ()) -> Boosted:
    """slopes: adds g and h to rows with f0 and the columns ``keep`` (for ``given``); ``by``: group and key by which its rows are dealt, once. watch: a figure of ``valid`` with a column ``score``, larger is better;
    rounds after its best one are cut off once ``patience`` have brought nothing."""
    model = Boosted(list(columns), edges_of(train, columns, bins), rate, [x.link for x in losses], [], [[] for _ in losses])
    rows = binned(train.select(*columns, *dict.fromkeys([label, *keep])), model).drop(*[c for c in columns if c not in keep and c != label])
    written = rows = _checkpoint(dealt(rows, *by) if by else rows)
    first = rows.agg(*[x.start(F.col(label).cast("double")).cast("double").alias(f"s{m}") for m, x in enumerate(losses)]).first()
    model.start = [0.0 if v is None or math.isnan(v) else float(v) for v in first]
    rows = rows.withColumn(label, F.col(label).cast("double")).withColumns({f"f{m}": F.lit(s) for m, s in enumerate(model.start)})
    best, best_at = -math.inf, 0
    for r in range(rounds):
        now = _checkpoint(slopes(rows)) if slopes else rows
        if slopes:  # a round's rows replace those before: two copies at most are kept
            _forget(written)
            written = now
        grown = grow(now, [x.slope(F.col(f"f{m}"), F.col(label)) for m, x in enumerate(losses)], losses, depth, bins + 1, reg, min_rows, label)
        for trees, t in zip(model.trees, grown, strict=True):
            trees.append(t)
        rows = now.withColumns({f"f{m}": F.col(f"f{m}") + rate * t.score() for m, t in enumerate(grown)})
        if slopes:
            rows = rows.drop("g", "h")
        elif r % STAGE == STAGE - 1:
            rows = _checkpoint(rows)
            _forget(written)
            written = rows
        if watch is not None and valid is not None:
            figure = watch(model.predict(valid, ["score"]))
            if figure > best + 1e-9:
                best, best_at = figure, r + 1
            elif r + 1 - best_at >= patience:
                break
    _forget(written)
    if watch is not None and valid is not None:
        model.trees = [t[:best_at] for t in model.trees]
    return model


# Lists: gradients of pairs inside a query, weighted by what their exchange does to NDCG.


def pair_slopes(start: np.ndarray, f: np.ndarray, y: np.ndarray, w: np.ndarray, top: int, sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """g and h of rows that lie list by list, each by its key; ``start``: where lists begin. NaN stands for null. Lists of like length are laid side by side, best score first,
    and each of a list's first ``top`` meets all others, so a block has BLOCK_PAIRS pairs or one list's."""
    g, h, size = np.zeros(len(f)), np.zeros(len(f)), np.diff(np.append(start, len(f)))
    gain, order, lo = np.exp2(y) - 1, np.argsort(size, kind="stable"), 0
    while lo < len(order):
        most = BLOCK_PAIRS // np.maximum(size[order[lo:]] * np.minimum(size[order[lo:]], top), 1)
        hi = lo + max(1, int(np.sum(np.arange(1, len(most) + 1) <= most)))
        own, lo = order[lo:hi], hi
        wide = int(size[own].max())
        head = min(top, wide)
        at, there = start[own][:, None] + np.arange(wide), np.arange(wide) < size[own][:, None]
        at = np.where(there, at, 0)
        cut = np.where(np.arange(wide) < top, 1 / np.log2(np.arange(wide) + 2.0), 0.0)
        ideal = -np.sort(np.where(there, -gain[at], np.nan), axis=1)
        best = np.nansum(ideal * cut, axis=1)
        at = np.take_along_axis(at, np.argsort(np.where(there, -f[at], np.inf), axis=1, kind="stable"), axis=1)
        score, gains, weight = f[at], np.where(there, gain[at], np.nan), w[at]
        apart = gains[:, :head, None] - gains[:, None, :]
        # The better row's weight is the pair's: a click counts by its inverse propensity.
        pair = np.abs(apart) * np.abs(cut[:head, None] - cut) * np.where(apart > 0, weight[:, :head, None], weight[:, None, :])
        better = np.sign(apart)
        with np.errstate(over="ignore"):
            rho = 1 / (1 + np.exp(sigma * better * (score[:, :head, None] - score[:, None, :])))
        met = (np.abs(apart) > 0) & (best > 0)[:, None, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            pair = pair / best[:, None, None]
        dg, dh = np.where(met, -better * sigma * rho * pair, 0.0), np.where(met, sigma * sigma * rho * (1 - rho) * pair, 0.0)
        # Rows beyond the first ``top`` meet only these.
        gs = np.concatenate([dg.sum(axis=2), -dg[:, :, head:].sum(axis=1)], axis=1)
        hs = np.concatenate([dh.sum(axis=2), dh[:, :, head:].sum(axis=1)], axis=1)
        g[at[there]], h[at[there]] = np.nan_to_num(gs[there]), np.nan_to_num(hs[there])
    return g, h


#: Pairs of rows that are computed at a time.
BLOCK_PAIRS = 500_000


def dealt(df: DataFrame, group: str, key: str) -> DataFrame:
    """Lists whole in a partition, one after the other."""
    return df.repartition(group).sortWithinPartitions(group, key)


def lists(group: str, label: str, key: str, weight: str | None = None, top: int = 20, sigma: float = 1.0, deal: bool = True) -> Callable[[DataFrame], DataFrame]:
    """Adds g and h by pairs of rows of a query with different gains, of which one at least is among its ``top`` by score. Queries are result lists of bounded length
    (``impressions``). Without ``deal`` the rows must come as ``dealt`` leaves them; they are then not exchanged again, so a round costs a pass."""

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda t, c: t[c].cast(pa.float64()).to_numpy()

        def add(t: pa.Table, start: np.ndarray) -> Iterator[pa.RecordBatch]:
            w = number(t, weight) if weight else np.ones(len(t))
            for name, v in zip("gh", pair_slopes(start, number(t, "f0"), number(t, label), w, top, sigma), strict=True):
                t = t.append_column(name, pa.array(v))
            yield from t.combine_chunks().to_batches()

        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            code = t[group].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(t) else np.zeros(0, dtype=np.int64)
            if len(start) > 1:
                yield from add(t.slice(0, start[-1]), start[:-1])
            held = t.slice(start[-1]) if len(start) else None  # the last list may go on in the next batch
        if held is not None:
            yield from add(held, np.zeros(1, dtype=np.int64))

    def add(df: DataFrame) -> DataFrame:
        d = dealt(df, group, key) if deal else df
        return d.mapInArrow(slopes, StructType([*d.schema.fields, StructField("g", DoubleType()), StructField("h", DoubleType())]))

    return add


def impressions(log: DataFrame, group: str, position: str, max_position: int = 48, min_rows: int = 1) -> DataFrame:
    """Result lists as they were shown, down to ``max_position`` (so a list's length has a bound), of queries with enough rows."""
    n = F.count("*").over(Window.partitionBy(group))
    return log.where(F.col(position) <= max_position).withColumn("_n", n).where(F.col("_n") >= min_rows).drop("_n")


def click_weights(log: DataFrame, propensity: DataFrame, position: str = "position", clicked: str = "clicked", most: float = 20.0) -> DataFrame:
    """Adds weight: 1 for no click; a click's inverse propensity (of the last position where one is missing), within 1 and ``most``."""
    p = propensity.select(position, "propensity")  # one row a position
    low = p.agg(F.min("propensity")).first()[0] or 1.0
    w = F.least(F.lit(most), F.greatest(F.lit(1.0), 1 / F.coalesce("propensity", F.lit(float(low)))))
    return log.join(p, position, "left").withColumn("weight", F.when(F.col(clicked) == 1, w).otherwise(1.0)).drop("propensity")


def listwise_ranker(train: DataFrame, columns: Sequence[str], group: str, clicked: str, key: str, weight: str | None = None, rounds: int = 20, depth: int = 4, rate: float = 0.1, min_rows: int = 20, valid: DataFrame | None = None, patience: int = 5, top: int = 20) -> Boosted:
    """Trees on the pair gradients of ``lists``; with ``valid``, as many as give its best NDCG@10."""
    from .models import ndcg

    watch = (lambda df: ndcg(df, group, "score", clicked, key).first()[0] or 0.0) if valid is not None else None
    keep = [group, key, *([weight] if weight else [])]
    return fit(train, columns, clicked, [given()], rounds, depth, rate, reg=1e-3, min_rows=min_rows, slopes=lists(group, clicked, key, weight, top, deal=False), by=(group, key), keep=keep, watch=watch, valid=valid, patience=patience)


def train_ranker(clicks: DataFrame, columns: Sequence[str], config, query: str = "query_id", key: str = "sku", clicked: str = "clicked", position: str = "position", day: str = "event_date") -> tuple[Boosted, dict]:
    """A ranker as a RankerConfig asks for: lists down to ``max_position`` of queries with ``min_impressions`` rows, the last ``holdout_days`` held out, clicks weighted by the
    training part's position curve, rounds stopped by the held-out NDCG@10. Also its figures."""
    from .models import ndcg
    from .search import position_propensity

    shown = impressions(clicks, query, position, config.max_position, config.min_impressions)
    cutoff = F.date_sub(F.lit(shown.agg(F.max(day)).first()[0]), config.holdout_days)
    train, valid = shown.where(F.col(day) < cutoff), shown.where(F.col(day) >= cutoff)
    curve = position_propensity(train.select(F.col(position).alias("position"), F.col(clicked).alias("clicked")))
    weighed = _checkpoint(click_weights(train, curve.withColumnRenamed("position", position), position, clicked))
    depth = max(1, math.ceil(math.log2(config.leaves)))
    model = listwise_ranker(weighed, columns, query, clicked, key, "weight", config.rounds, depth, config.learning_rate, config.min_leaf, valid=_checkpoint(valid), patience=config.patience, top=config.truncation)
    scored = model.predict(valid, ["score"])
    return model, {"best_iteration": len(model.trees[0]), "ndcg_at_10": ndcg(scored, query, "score", clicked, key).first()[0], "splits": model.gains()}
