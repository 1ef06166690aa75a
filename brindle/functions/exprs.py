"""Column builders: time, decay, statistics, vectors. All stay in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000_000

#: Aggregates that a feature view may ask for.
AGGREGATES = {"count": F.count, "count_distinct": F.count_distinct, "sum": F.sum, "avg": F.avg}


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def age_days(as_of: str, ts: str | Column) -> Column:
    """Fractional days from ts to as_of."""
    return (micros(F.lit(as_of)) - micros(ts)) / F.lit(float(DAY))


def half_life(age: Column, life: float) -> Column:
    return F.pow(F.lit(0.5), age / F.lit(float(life)))


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Null stays null."""
    out = c if lo is None else F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))
    return out if hi is None else F.when(out.isNotNull(), F.least(out, F.lit(hi)))


#: Added before rounding, so that a half, which sums in another order may miss by the last bit, always goes up.
NUDGE = 1.3e-7


def rounded(c: Column, digits: int = 4) -> Column:
    """Rounded, without a negative zero."""
    return F.round(c + F.lit(NUDGE), digits) + F.lit(0.0)


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def hour_of_week(ts: Column, hours: int = 3) -> Column:
    """Monday's first slot is 0."""
    return (F.weekday(ts) * (24 // hours) + F.floor(F.hour(ts) / hours)).cast("int")


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds."""
    out = None
    for cond, value in rules:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def cut(c: Column, edges: list[float], labels: list) -> Column:
    """Right-closed bins: label i for edges[i] < c <= edges[i + 1]; null outside."""
    return first_match([((c > lo) & (c <= hi), label) for lo, hi, label in zip(edges, edges[1:], labels, strict=False)])


def rank_band(rank: Column, count: Column, bands: int) -> Column:
    """Of rank 1..count, which of the equal-sized bands 0..bands-1 with linearly interpolated edges."""
    return F.greatest(F.lit(0), F.ceil((rank - 1) * bands / F.greatest(count - 1, F.lit(1))) - 1).cast("int")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 1e-9) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(eps))


def normalized(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))


def beta_smoothed(hits: Column, n: Column, prior_hits: float, prior_n: float) -> Column:
    return (hits + F.lit(float(prior_hits))) / (n + F.lit(float(prior_n)))


def idf(n_docs: Column, df: Column) -> Column:
    """Smoothed: ln((N + 1) / (df + 1)) + 1."""
    return F.log((n_docs + 1) / (df + 1)) + 1


Z95 = 1.959963984540054
LN2 = math.log(2)


def paired(a: Column, b: Column, most: int) -> Column:
    """Elements of two arrays side by side, the first ``most``; null if the arrays are not equally long."""
    return F.when(F.size(a) == F.size(b), F.arrays_zip(F.slice(a, 1, most).alias("a"), F.slice(b, 1, most).alias("b")))


def from_json_map(c: Column) -> Column:
    """A JSON object as a map of texts; null if it is none."""
    return F.from_json(c, "map<string,string>")


def path_of(*levels: Column) -> Column:
    """Levels that are known, joined by " > "."""
    return F.concat_ws(" > ", *levels)
