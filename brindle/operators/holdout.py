"""Exact hold-outs: a stated number of rows, or of whole groups, of every stratum, the same for reruns and partitionings.

Each unit has a rank: 60 bits of a digest of its key. The cut of a stratum is found from histograms of the ranks, 12 bits a pass: the bin where the count is reached is looked
into further, so no stratum is sorted in one task and the passes are five at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import _checkpoint

BITS, STEP = 60, 12


def rank(key: Column, seed: int = 0) -> Column:
    """60 bits of the MD5 of the seed and the key as text."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, BITS // 4), 16, 10).cast("long")


def counts_of(units: DataFrame, share: float) -> DataFrame:
    """(stratum, need): the share of each stratum's units, rounded half up."""
    return units.groupBy("stratum").agg(F.floor(F.count("*") * share + 0.5).cast("long").alias("need"))


def cuts(units: DataFrame, need: DataFrame) -> DataFrame:
    """(stratum, cut, need): units with a rank below cut are held out, and ``need`` more with exactly this rank. units: stratum, rank; need: stratum, need."""
    state = _checkpoint(need.select("stratum", F.lit(0).cast("long").alias("prefix"), "need"))
    for done in range(0, BITS, STEP):
        same = F.col("u.stratum").eqNullSafe(F.col("s.stratum")) & (F.shiftright("u.rank", BITS - done) == F.col("s.prefix"))
        inside = units.alias("u").join(state.alias("s"), same).select("s.stratum", "s.prefix", "s.need", F.expr(f"shiftright(u.rank, {BITS - done - STEP}) & {(1 << STEP) - 1}").alias("bin"))
        bins = inside.groupBy("stratum", "prefix", "need", "bin").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("bin"))  # 4096 bins at most
        # The first bin that goes beyond what is needed; without one, all of the range is taken.
        first = F.min(F.when(F.col("upto") > F.col("need"), F.struct("bin", (F.col("need") - F.col("upto") + F.col("n")).alias("rest"))))
        found = bins.withColumn("upto", upto).groupBy("stratum").agg(first.alias("x"), F.max("upto").alias("all"))
        met = state.alias("s").join(found.alias("f"), F.col("s.stratum").eqNullSafe(F.col("f.stratum")), "left")
        wide = 1 << STEP
        prefix = F.when(F.col("f.x").isNotNull(), F.col("s.prefix") * wide + F.col("f.x.bin")).otherwise((F.col("s.prefix") + 1) * wide)
        rest = F.coalesce("f.x.rest", F.col("s.need") - F.coalesce("f.all", F.lit(0)))
        state = _checkpoint(met.select("s.stratum", prefix.alias("prefix"), rest.alias("need")))
    return state.select("stratum", F.col("prefix").alias("cut"), "need")


def hold_out(rows: DataFrame, key: str, stratum: str | Column | None = None, share: float = 0.2, group: str | None = None, seed: int = 0) -> DataFrame:
    """Adds ``held``. Without a group, ``key`` is unique and the share is of the rows of each stratum; with one, of its groups, which stay whole (a group belongs to the stratum
    of its smallest key). Rows with equal keys share a fate."""
    s = F.lit(None).cast("string") if stratum is None else F.col(stratum) if isinstance(stratum, str) else stratum
    own = rows.columns
    unit = key if group is None else group
    x = rows.select(F.col(unit).alias("unit"), F.col(key).alias("key"), s.cast("string").alias("stratum"))
    units = x.groupBy("unit").agg(F.min_by("stratum", F.col("key")).alias("stratum")) if group is not None else x.select("unit", "stratum").distinct()
    units = _checkpoint(units.withColumn("rank", rank(F.col("unit"), seed)))
    cut = cuts(units, counts_of(units, share))
    met = units.alias("u").join(cut.alias("c"), F.col("u.stratum").eqNullSafe(F.col("c.stratum")))
    met = met.select("u.unit", "u.stratum", "u.rank", "c.cut", "c.need")
    # Units of one rank: a few at most, by unit.
    tied = met.where((F.col("rank") == F.col("cut")) & (F.col("need") > 0)).withColumn("_r", F.row_number().over(Window.partitionBy("stratum").orderBy("unit"))).where(F.col("_r") <= F.col("need"))
    held = met.where(F.col("rank") < F.col("cut")).select("unit").unionByName(tied.select("unit")).withColumn("_held", F.lit(True))
    return rows.join(held, rows[unit].eqNullSafe(held.unit), "left").select(*[rows[c] for c in own], F.coalesce("_held", F.lit(False)).alias("held"))
