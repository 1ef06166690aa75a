"""Experiment analysis: sample ratio, variance reduction, tests, intervals, false discovery rate, uplift curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.exprs import Z95, rank_band
from brindle.functions.tails import chi2_p, normal_p, t_p

from .ranking import running_least, running_sums


def arm_sizes(units: DataFrame) -> DataFrame:
    """(experiment_id, chi2, df): goodness of fit of the arms to an equal split. units: experiment_id, variant, unit_id."""
    n = units.groupBy("experiment_id", "variant").agg(F.count_distinct("unit_id").alias("n"))
    e = n.withColumn("e", F.avg("n").over(Window.partitionBy("experiment_id")))
    return e.groupBy("experiment_id").agg(F.sum((F.col("n") - F.col("e")) ** 2 / F.col("e")).alias("chi2"), (F.count("*") - 1).alias("df"))


def cuped(metrics: DataFrame, least: float = 0.5) -> DataFrame:
    """Adds adjusted and theta: value - theta * (pre - mean pre), theta pooled over arms; missing pre values are the mean. Below ``least`` coverage nothing changes."""
    by = ["experiment_id", "metric"]
    filled = metrics.join(metrics.groupBy(*by).agg(F.avg("pre_value").alias("_pre")), by).withColumn("_x", F.coalesce("pre_value", "_pre")).drop("_pre")
    stats = filled.groupBy(*by).agg(F.covar_samp("_x", "value").alias("_cov"), F.var_samp("_x").alias("_var"), F.avg("_x").alias("_mean"), F.avg(F.when(F.col("pre_value").isNotNull(), 1.0).otherwise(0.0)).alias("_cover"))
    j = filled.join(stats, by)
    theta = F.when((F.col("_cover") >= least) & (F.col("_var") > 0), F.col("_cov") / F.col("_var")).otherwise(0.0)
    return j.withColumn("theta", theta).withColumn("adjusted", F.col("value") - F.col("theta") * (F.col("_x") - F.col("_mean"))).drop("_x", "_cov", "_var", "_mean", "_cover")


def arm_stats(metrics: DataFrame, value: str = "value") -> DataFrame:
    return metrics.groupBy("experiment_id", "metric", "metric_type", "variant").agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"), F.sum(value).alias("total"))


def compare(stats: DataFrame, control: str = "control") -> DataFrame:
    """Each variant against control: lift with its delta-method interval, the test statistic (Welch t or two-proportion z) and its degrees of freedom."""
    by = ["experiment_id", "metric", "metric_type"]
    c = stats.where(F.col("variant") == control).select(*by, *[F.col(x).alias(f"c_{x}") for x in ("n", "mean", "var", "total")])
    j = stats.where(F.col("variant") != control).join(c, by)
    a, b = F.col("var") / F.col("n"), F.col("c_var") / F.col("c_n")
    pooled = (F.col("total") + F.col("c_total")) / (F.col("n") + F.col("c_n"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / F.col("c_n")))
    binary = F.col("metric_type") == "binary"
    d = F.col("mean") - F.col("c_mean")
    stat = F.when(binary, F.when(se == 0, 0.0).otherwise(d / se)).otherwise(d / F.sqrt(a + b))
    df = F.when(~binary, (a + b) ** 2 / (a * a / (F.col("n") - 1) + b * b / (F.col("c_n") - 1)))
    half = Z95 * F.sqrt(F.col("var") / (F.col("n") * F.col("c_mean") ** 2) + F.col("mean") ** 2 * F.col("c_var") / (F.col("c_n") * F.col("c_mean") ** 4))
    lift = F.when(F.col("c_mean") != 0, F.col("mean") / F.col("c_mean") - 1)
    return j.select(*by, "variant", F.col("c_n").alias("n_control"), F.col("n").alias("n_treatment"), F.col("c_mean").alias("mean_control"), F.col("mean").alias("mean_treatment"), lift.alias("lift"), (lift - half).alias("lift_low"), (lift + half).alias("lift_high"), stat.alias("statistic"), df.alias("df"))


def adjust_p(df: DataFrame, by: list[str], p: str = "p_value", tie: str = "metric") -> DataFrame:
    """Benjamini-Hochberg: adds p_adjusted. Ranks, and the least of what follows, are running figures over ranges of the order: no task sorts a whole family, and no
    row looks at all that follow."""
    x = running_sums(df, by, [F.asc(p), F.asc(tie)], {"_r": F.lit(1)})
    x = running_least(x, by, [F.desc("_r")], {"_q": F.col(p) * F.col("_r_all") / F.col("_r")})
    return x.withColumn("p_adjusted", F.least(F.lit(1.0), "_q")).drop("_r", "_r_all", "_q")


def analyse(units: DataFrame, metrics: DataFrame, control: str = "control", alpha: float = 0.05, srm: float = 0.001) -> DataFrame:
    """The whole chain; a result counts only if the arms have the planned sizes."""
    m = metrics.join(units.select("experiment_id", "unit_id", "variant"), ["experiment_id", "unit_id"])
    adj = cuped(m).withColumn("value", F.when(F.col("metric_type") == "continuous", F.col("adjusted")).otherwise(F.col("value")))
    r = compare(arm_stats(adj), control)
    r = r.withColumn("p_value", F.when(F.col("metric_type") == "binary", normal_p(F.col("statistic"))).otherwise(t_p(F.col("statistic"), F.coalesce("df", F.lit(1.0)))))
    r = adjust_p(r, ["experiment_id"])
    s = arm_sizes(units).withColumn("srm_flag", chi2_p(F.col("chi2"), F.col("df").cast("double")) < srm).select("experiment_id", "srm_flag")
    return r.join(s, "experiment_id").withColumn("significant", (F.col("p_adjusted") < alpha) & ~F.col("srm_flag"))


def qini(scored: DataFrame, score: str = "uplift", key: str = "unit_id") -> DataFrame:
    """(rank, frac, n_t, n_c, qini, score): incremental conversions when the first rows by score are targeted. scored: treated, converted 0/1.

    Running sums over a total order: the rows are cut into ranges of the score first, so that no task sorts all of them."""
    sums = {"rank": F.lit(1), "n_t": F.col("treated"), "n_c": 1 - F.col("treated"), "y_t": F.col("converted") * F.col("treated"), "y_c": F.col("converted") * (1 - F.col("treated"))}
    j = running_sums(scored.select(key, score, "treated", "converted"), [], [F.desc(score), F.asc(key)], sums).select(key, F.col(score).alias("score"), F.col("rank_all").alias("total"), *sums)
    q = F.col("y_t") - F.when(F.col("n_c") > 0, F.col("y_c") * F.col("n_t") / F.col("n_c")).otherwise(0.0)
    return j.select(key, "rank", (F.col("rank") / F.col("total")).alias("frac"), "n_t", "n_c", q.alias("qini"), "score")


def qini_summary(curve: DataFrame, population: int, margin: float, cost: float) -> DataFrame:
    """One row: area over random, the same per unit, and the most profitable share to target. The curve has a row a unit, so this is two aggregates."""
    last = F.broadcast(curve.agg(F.max_by("qini", "rank").alias("total"), F.count("*").alias("n")))  # one row
    j = curve.join(last).withColumn("over", F.col("qini") - F.col("frac") * F.col("total"))
    # The trapezoids' sum: all steps are 1 / n wide.
    area = (F.sum("over") - F.min_by("over", "rank") / 2 - F.max_by("over", "rank") / 2) / F.max("n")
    profit = F.col("qini") * population / F.col("n") * margin - F.col("frac") * population * cost
    best = F.max_by(F.struct("frac", "score", profit.alias("profit")), F.struct(F.round(profit, 6), -F.col("rank")))
    return j.agg(area.alias("area"), best.alias("b"), F.max("n").alias("n")).select("area", (F.col("area") / F.col("n")).alias("area_per_unit"), F.col("b.frac").alias("target_frac"), F.col("b.score").alias("threshold"), F.col("b.profit").alias("profit"))


def band_table(scored: DataFrame, score: str = "uplift", key: str = "unit_id", bands: int = 10) -> DataFrame:
    """(band, rates by arm, observed and predicted uplift), bands by falling score."""
    q = qini(scored, score, key).select(key, "rank", (F.col("rank") / F.col("frac")).cast("long").alias("n"))
    d = scored.join(q, key).withColumn("band", rank_band(F.col("rank"), F.col("n"), bands) + 1)
    rate: Column = lambda t: F.avg(F.when(F.col("treated") == t, F.col("converted")))
    g = d.groupBy("band").agg(rate(0).alias("rate_control"), rate(1).alias("rate_treated"), F.avg(score).alias("predicted_uplift"))
    return g.withColumn("observed_uplift", F.col("rate_treated") - F.col("rate_control"))
