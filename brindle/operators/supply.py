"""Demand panels, forecasts' scores, replenishment and markdown plans, elasticities."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.exprs import clip

from .graph import _checkpoint
from .ranking import running_sums

#: ISO weeks of the year's peaks.
HOLIDAYS = {"memorial_day": [21, 22], "july_4": [27], "labor_day": [36], "black_friday": [47, 48], "holiday_season": [50, 51, 52], "white_sale": [1, 2]}


def week(ts: str | Column) -> Column:
    """Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", ts))


def weekly(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lines.groupBy(*keys, week("order_ts").alias("week_start")).agg(F.sum("quantity").alias("units"))


def densify(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row for every key and week between the first and the last; missing units are 0. The calendar is generated per key, not joined."""
    span = F.broadcast(sales.agg(F.min("week_start").alias("lo"), F.max("week_start").alias("hi")))  # one row
    grid = sales.select(*keys).distinct().join(span).select(*keys, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    return grid.join(sales, [*keys, "week_start"], "left").withColumn("units", F.coalesce("units", F.lit(0.0)))


def lag_features(panel: DataFrame, keys: Sequence[str], lags: Sequence[int] = (1, 2, 4, 52), means: Sequence[int] = (4, 8, 13)) -> DataFrame:
    """Earlier weeks and trailing means and deviation, never including the row's own week. One sort serves all."""
    w = Window.partitionBy(*keys).orderBy("week_start")
    cols = {f"lag_{n}": F.lag("units", n).over(w) for n in lags}
    cols |= {f"roll_mean_{n}": F.avg("units").over(w.rowsBetween(-n, -1)) for n in means}
    cols["roll_std_8"] = F.stddev_samp("units").over(w.rowsBetween(-8, -1))
    return panel.withColumns(cols).withColumn("yoy_ratio", F.col("roll_mean_4") / (F.col("lag_52") + 1))


def calendar_features(df: DataFrame, day: str = "week_start") -> DataFrame:
    n = F.weekofyear(day)
    turn = 2 * np.pi * n / 52.0
    return df.withColumns({"week_of_year": n, "woy_sin": F.sin(turn), "woy_cos": F.cos(turn), **{f"hol_{k}": n.isin(v).cast("int") for k, v in HOLIDAYS.items()}})


def price_features(df: DataFrame, keys: Sequence[str], depth: str = "markdown") -> DataFrame:
    d = clip(F.coalesce(depth, F.lit(0.0)), 0.0, 0.8)
    return df.withColumn("depth", d).withColumn("depth_change", F.coalesce(F.col("depth") - F.lag("depth").over(Window.partitionBy(*keys).orderBy("week_start")), F.lit(0.0)))


def elasticity_panel(lines: DataFrame, prices: DataFrame) -> DataFrame:
    """Units and realised price per item and week, where a list price is known for that week. prices: sku, category, effective_date, price."""
    u = lines.where(~F.col("is_return")).groupBy("sku", week("order_ts").alias("week_start")).agg(F.sum("quantity").alias("units"), F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"))
    p = prices.groupBy("sku", week("effective_date").alias("week_start")).agg(F.avg("price").alias("list_price"), F.max("category").alias("category"))
    avg = F.coalesce(F.col("revenue") / F.nullif("units", F.lit(0.0)), F.col("list_price"))
    return u.join(p, ["sku", "week_start"]).where("units > 0").select("sku", "category", "week_start", F.weekofyear("week_start").alias("week_of_year"), "units", avg.alias("avg_price"))


#: Places in an observation: log price, the ISO weeks 1 to 53, log units. Beside the products of these, sums are kept in ROWS and ITEMS.
PRICE, UNITS, ROWS, ITEMS = 0, 54, 55, 56
SOLVED = "category string, beta double, spread double, n_obs long, n_skus long, r2 double, coef array<double>, lead array<double>"


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(category, i, j, v): the items' demeaned cross products, summed over the items of a task; at (week, ROWS) the rows of the week."""
    sums: dict[str | None, np.ndarray] = {}

    def cells() -> Iterator[pd.DataFrame]:
        for c, m in sums.items():
            i, j = np.nonzero(np.triu(m))
            yield pd.DataFrame({"category": c, "i": i.astype(np.int32), "j": j.astype(np.int32), "v": m[i, j]})
        sums.clear()

    for pdf in batches:
        code, names = pd.factorize(pdf.category, use_na_sentinel=False)
        item = np.repeat(np.arange(len(pdf)), pdf.week.str.len())
        w, n, sx, sy = (np.concatenate(pdf[c].to_numpy()) for c in ("week", "n", "sx", "sy"))
        total = np.zeros((len(pdf), ROWS))
        total[item, w], total[:, PRICE], total[:, UNITS] = n, np.bincount(item, sx), np.bincount(item, sy)
        rows = np.bincount(item, n)
        for k, name in enumerate(names):
            m = sums.setdefault(None if pd.isna(name) else name, np.zeros((ITEMS + 1, ITEMS + 1)))
            own, at = code == k, code[item] == k
            m[:ROWS, :ROWS] -= (total[own] / rows[own, None]).T @ total[own]
            np.add.at(m, (w[at], w[at]), n[at])
            np.add.at(m, (np.full(at.sum(), PRICE), w[at]), sx[at])
            np.add.at(m, (w[at], np.full(at.sum(), UNITS)), sy[at])
            np.add.at(m, (w[at], np.full(at.sum(), ROWS)), n[at])
            xx = pdf.sxx[own].sum()
            m[PRICE, PRICE] += xx
            m[PRICE, ROWS] += xx
            m[PRICE, UNITS] += pdf.sxy[own].sum()
            m[UNITS, UNITS] += pdf.syy[own].sum()
            m[ROWS, ROWS] += rows[own].sum()
            m[ITEMS, ITEMS] += own.sum()
        if len(sums) > 256:
            yield from cells()
    yield from cells()


def _normal_equations(min_skus: int, min_obs: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in SOLVED.split(", ")]
        m = np.zeros((ITEMS + 1, ITEMS + 1))
        m[pdf.i, pdf.j] = m[pdf.j, pdf.i] = pdf.v
        rows, items = int(m[ROWS, ROWS]), int(m[ITEMS, ITEMS])
        # Sums leave a trace of rounding where an item's prices or weeks don't vary.
        if items < min_skus or rows < min_obs or m[PRICE, PRICE] <= 1e-11 * m[PRICE, ROWS]:
            return pd.DataFrame(columns=names)
        weeks = np.flatnonzero(m[1:UNITS, ROWS])[1:] + 1
        x = np.array([PRICE, *[w for w in weeks if m[w, w] > 1e-9]])
        g, xy, yy = m[np.ix_(x, x)], m[x, UNITS], max(m[UNITS, UNITS], 0.0)
        inv = np.linalg.pinv(g, rcond=1e-12, hermitian=True)
        b = inv @ xy
        coef, lead = np.zeros(ROWS), np.zeros(ROWS)
        coef[x], coef[UNITS], lead[x] = -b, 1.0, inv[0]
        scale = items / (items - 1) * (rows - 1) / max(rows - len(x) - items, 1)
        left = yy - 2 * b @ xy + b @ g @ b
        return pd.DataFrame([(pdf.category.iloc[0], b[0], scale, rows, items, 1 - left / yy if yy > 0 else 0.0, coef, lead)], columns=names)

    return solve


def fit_elasticity(panel: DataFrame, min_skus: int = 3, min_obs: int = 60) -> DataFrame:
    """Per category: log units on log price with item effects (demeaned) and week dummies; errors clustered by item.

    Each item is reduced to sums by week. Their demeaned cross products add up to one matrix of 55 x 55 a category, all that meets in one task; a second
    pass over the items, in column expressions, adds up the squared scores that the clustered error needs. A category of any size spreads over tasks."""
    x, y = F.ln("avg_price"), F.ln("units")
    cells = panel.where("units > 0 and avg_price > 0").groupBy("category", "sku", F.col("week_of_year").cast("int").alias("week"))
    cells = cells.agg(F.count("*").cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("xx"), F.sum(x * y).alias("xy"), F.sum(y * y).alias("yy"))
    lists = F.collect_list(F.struct("week", "n", "sx", "sy")).alias("cells")  # at most 53
    items = _checkpoint(cells.groupBy("category", "sku").agg(lists, F.sum("xx").alias("sxx"), F.sum("xy").alias("sxy"), F.sum("yy").alias("syy")))
    flat = items.select("category", *[F.col(f"cells.{c}").alias(c) for c in ("week", "n", "sx", "sy")], "sxx", "sxy", "syy")
    grams = flat.mapInPandas(_grams, "category string, i int, j int, v double").groupBy("category", "i", "j").agg(F.sum("v").alias("v"))
    fits = grams.groupBy("category").applyInPandas(_normal_equations(min_skus, min_obs), SOLVED)

    c, e = F.col("coef"), F.col("lead")
    over = lambda f: F.aggregate("cells", F.lit(0.0), lambda total, k: total + f(k))
    sx, sy, n = over(lambda k: k.sx), over(lambda k: k.sy), over(lambda k: k.n)
    raw = over(lambda k: e[k.week] * (k.sx * c[PRICE] + k.n * c[k.week] + k.sy * c[UNITS])) + e[PRICE] * (F.col("sxx") * c[PRICE] + over(lambda k: k.sx * c[k.week]) + F.col("sxy") * c[UNITS])
    means = (sx * e[PRICE] + over(lambda k: k.n * e[k.week])) * (sx * c[PRICE] + over(lambda k: k.n * c[k.week]) + sy * c[UNITS]) / n
    of = fits.select(F.col("category").alias("of"), "coef", "lead")
    meat = items.join(of, F.col("category").eqNullSafe(F.col("of"))).select("of", (raw - means).alias("s")).groupBy("of").agg(F.sum(F.col("s") * F.col("s")).alias("meat"))
    out = fits.join(meat, F.col("category").eqNullSafe(F.col("of")))
    return out.select("category", "beta", F.sqrt(F.col("spread") * F.col("meat")).alias("se"), "n_obs", "n_skus", "r2")


def shrink(fits: DataFrame) -> DataFrame:
    """Empirical Bayes: estimates move toward the precision-weighted mean by their noise. A few categories; two one-row aggregates."""
    w = 1 / F.greatest("se", F.lit(1e-6)) ** 2
    g = fits.withColumn("w", w)
    mean = F.broadcast(g.agg((F.sum(F.col("w") * F.col("beta")) / F.sum("w")).alias("mean"), F.sum("w").alias("sw"), F.sum(F.col("w") ** 2).alias("sw2"), F.count("*").alias("k")))  # one row
    j = g.join(mean)
    q = F.broadcast(j.agg(F.sum(F.col("w") * (F.col("beta") - F.col("mean")) ** 2).alias("q")))  # one row
    denom = F.col("sw") - F.col("sw2") / F.col("sw")
    tau2 = F.when(denom > 0, F.greatest(F.lit(0.0), (F.col("q") - (F.col("k") - 1)) / denom)).otherwise(0.0)
    j = j.join(q).withColumn("tau2", tau2).withColumn("weight", F.when(F.col("tau2") > 0, F.col("tau2") / (F.col("tau2") + F.col("se") ** 2)).otherwise(0.0))
    return j.select("category", "beta", "se", "n_obs", "n_skus", "r2", "weight", (F.col("weight") * F.col("beta") + (1 - F.col("weight")) * F.col("mean")).alias("elasticity"), F.col("mean").alias("global_elasticity"), (F.col("beta") / F.col("se")).alias("t_stat"))


def reorder(forecast: DataFrame, stock: DataFrame, terms: DataFrame, z: float = 1.645, review: float = 1.0, spread: float = 2.563) -> DataFrame:
    """Order lines of an (s, S) policy. forecast: sku, warehouse_id, horizon, p10, p50, p90; stock: ..., on_hand, on_order, allocated, margin;
    terms: sku, vendor_id, lead_days, case_pack, moq, unit_cost. Demand over a fractional number of weeks weighs the last one."""
    key = ["sku", "warehouse_id"]
    lead = F.col("lead_days") / 7
    f = forecast.join(terms, "sku").withColumn("i", F.row_number().over(Window.partitionBy(*key).orderBy("horizon")) - 1)
    sigma2 = (F.greatest(F.col("p90") - F.col("p10"), F.lit(0.0)) / spread) ** 2
    share = lambda weeks: F.when(F.col("i") < F.floor(weeks), 1.0).when(F.col("i") == F.floor(weeks), weeks - F.floor(weeks)).otherwise(0.0)
    level = lambda weeks: F.sum(share(weeks) * F.col("p50")) + z * F.sqrt(F.sum(share(weeks) * sigma2))
    g = f.groupBy(*key).agg(level(lead).alias("reorder_point"), level(lead + review).alias("order_up_to"), *[F.first(c).alias(c) for c in ("vendor_id", "case_pack", "moq", "unit_cost")])
    ip = F.col("on_hand") + F.col("on_order") - F.col("allocated")
    j = g.join(stock, key).withColumn("position", ip).where(F.col("position") <= F.col("reorder_point"))
    pack = F.col("case_pack")
    units = F.ceil((F.col("order_up_to") - F.col("position")) / pack) * pack
    qty = F.when(F.col("order_up_to") <= F.col("position"), 0).otherwise(F.greatest(units, F.ceil(F.col("moq") / pack) * pack))
    out = j.withColumn("order_qty", qty.cast("long")).where("order_qty > 0")
    return out.withColumn("cost", F.col("order_qty") * F.col("unit_cost")).select(*key, "vendor_id", "reorder_point", "order_up_to", "position", "order_qty", "unit_cost", "margin", "cost")


def within_budget(lines: DataFrame, budget: float) -> DataFrame:
    """The lines with the highest margins whose running cost stays within the budget: the rest, from the lowest margin, is dropped."""
    order = [F.desc("margin"), F.asc("sku"), F.asc("warehouse_id")]
    return running_sums(lines, [], order, {"running_cost": F.col("cost")}).where(F.col("running_cost") <= budget).drop("running_cost_all")


def excess_stock(stock: DataFrame, today: str) -> DataFrame:
    """Items that full-price sales can't clear by the season's end. stock: sku, on_hand, weekly_units, season_end."""
    weeks = F.greatest(F.floor(F.datediff("season_end", F.lit(today).cast("date")) / 7), F.lit(0))
    return stock.withColumn("weeks_left", weeks.cast("int")).where((F.col("weeks_left") > 0) & (F.col("on_hand") > F.col("weekly_units") * F.col("weeks_left")))


PLAN = "sku long, week int, discount double, units double, remaining double, plan_value double"


def markdown_ladder(units: int, price: float, base: float, elasticity: float, weeks: int, steps: Sequence[float] = (0.0, 0.1, 0.2, 0.3, 0.4), buckets: int = 50, holding: float = 0.004, salvage: float = 0.15, penalty: float = 0.25) -> tuple[list[tuple[int, float, float, float]], float]:
    """The discounts per week that earn most, never falling, by backward induction over (stock bucket, discount). All states of a week at once."""
    size = max(units / buckets, 1.0)
    stock = np.arange(int(np.ceil(units / size)) + 1) * size
    d = np.asarray(steps)
    sold = np.minimum(base * (1 - d[None, :]) ** elasticity, stock[:, None])
    left = stock[:, None] - sold
    gain = sold * price * (1 - d) - left * price * holding
    nxt = np.minimum(np.round(left / size).astype(int), len(stock) - 1)
    value = np.repeat((stock * price * (salvage - penalty))[:, None], len(d), axis=1)
    choice = []
    for _ in range(weeks):
        total = gain + value[nxt, np.arange(len(d))]
        # best[b, k]: the first of the best choices at discount k or deeper.
        pick = np.stack([k + np.argmax(total[:, k:], axis=1) for k in range(len(d))], axis=1)
        choice.append(pick)
        value = np.take_along_axis(total, pick, axis=1)
    rows, have, k = [], float(units), 0
    for t, pick in enumerate(reversed(choice)):
        k = int(pick[min(int(round(have / size)), len(stock) - 1), k])
        q = min(base * (1 - d[k]) ** elasticity, have)
        have -= q
        rows.append((t, float(d[k]), q, have))
    return rows, float(value[min(int(round(units / size)), len(stock) - 1), 0])


def markdown_plan(candidates: DataFrame, elasticities: DataFrame, default: float = -1.5) -> DataFrame:
    """candidates: sku, category, on_hand, price, weekly_units, weeks_left. Missing or useless elasticities are replaced by the default."""
    e = candidates.join(elasticities, "category", "left")
    e = e.withColumn("elasticity", F.when(F.coalesce("elasticity", F.lit(default)) > -0.2, default).otherwise(F.coalesce("elasticity", F.lit(default))))

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                rows, value = markdown_ladder(int(r.on_hand), float(r.price), float(r.weekly_units), float(r.elasticity), int(r.weeks_left))
                out += [(r.sku, *x, value) for x in rows]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PLAN.split(", ")])

    return e.select("sku", "on_hand", "price", "weekly_units", "elasticity", "weeks_left").mapInPandas(run, PLAN)


def forecast_scores(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Weighted error, bias and interval coverage. rows: units, p10, p50, p90."""
    a = F.sum("units")
    return rows.groupBy(*by).agg(
        F.when(F.sum(F.abs("units")) > 0, F.sum(F.abs(F.col("units") - F.col("p50"))) / F.sum(F.abs("units"))).alias("wape"), F.when(a > 0, (F.sum("p50") - a) / a).alias("bias"),
        F.avg(F.when(F.col("units").between(F.col("p10"), F.col("p90")), 1.0).otherwise(0.0)).alias("coverage"), F.count("*").alias("n"),
    )


def seasonal_forecast(panel: DataFrame, keys: Sequence[str], origin: str, horizon: int = 12, window: int = 8) -> DataFrame:
    """(keys, week_start, horizon, p10, p50, p90): trailing mean and quantiles before the origin, carried forward."""
    past = panel.where((F.col("week_start") <= F.lit(origin).cast("date")) & (F.col("week_start") > F.date_sub(F.lit(origin).cast("date"), 7 * window)))
    g = past.groupBy(*keys).agg(F.avg("units").alias("p50"), F.percentile("units", F.lit(0.1)).alias("q1"), F.percentile("units", F.lit(0.9)).alias("q9"))
    h = g.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return h.select(*keys, F.date_add(F.lit(origin).cast("date"), F.col("horizon") * 7).alias("week_start"), "horizon", F.least("q1", "p50").alias("p10"), "p50", F.greatest("q9", "p50").alias("p90"))


def rolling_backtest(panel: DataFrame, keys: Sequence[str], origins: Sequence[str], horizon: int = 12, forecast=seasonal_forecast) -> DataFrame:
    """(origin, wape, bias, coverage, n): a forecast made at each origin against the weeks that followed. forecast(panel, keys, origin, horizon) must only
    look at weeks up to the origin."""
    out = None
    for o in origins:
        f = forecast(panel, keys, o, horizon).join(panel.select(*keys, "week_start", "units"), [*keys, "week_start"]).withColumn("origin", F.lit(o))
        out = f if out is None else out.unionByName(f)
    return forecast_scores(out, ["origin"])


def expanding_fits(examples: DataFrame, columns: Sequence[str], y: str, week: str, origins: Sequence[object]) -> DataFrame:
    """(origin, coefficients): at each origin the least squares over all examples up to it. Cross products are summed by week in one pass; an origin's are a running sum over
    weeks, so further origins cost no further pass. A constant comes first in the coefficients."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    d = len(x)
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    products = [F.sum(x[i] * x[j]).alias(f"a{i}_{j}") for i, j in cells] + [F.sum(x[i] * F.col(y)).alias(f"b{i}") for i in range(d)]
    weekly_ = examples.dropna(subset=[*columns, y]).groupBy(week).agg(*products)
    names = [f"a{i}_{j}" for i, j in cells] + [f"b{i}" for i in range(d)]
    at = examples.sparkSession.createDataFrame([(o,) for o in origins], "origin string").withColumn("_at", F.col("origin").cast("date"))
    upto = at.join(weekly_, F.col(week) <= F.col("_at")).groupBy("origin").agg(*[F.sum(n).alias(n) for n in names])  # origins x weeks rows of sums
    fits = []
    for r in upto.collect():
        a = np.zeros((d, d))
        for i, j in cells:
            a[i, j] = a[j, i] = r[f"a{i}_{j}"]
        fits.append((r.origin, [float(v) for v in np.linalg.pinv(a, hermitian=True) @ np.array([r[f"b{i}"] for i in range(d)])]))
    return examples.sparkSession.createDataFrame(fits, "origin string, coefficients array<double>")


def expanding_backtest(examples: DataFrame, keys: Sequence[str], columns: Sequence[str], y: str, week: str, origins: Sequence[str], horizon: int = 12) -> DataFrame:
    """(keys, origin, week, horizon, units, p50) of the weeks after each origin, by the fit of what was known at it. The columns must be known ``horizon`` weeks ahead."""
    fits = expanding_fits(examples, columns, y, week, origins)
    ahead = (F.datediff(F.col(week), F.col("origin").cast("date")) / 7).cast("int")
    rows = examples.dropna(subset=list(columns)).join(F.broadcast(fits), ahead.between(1, horizon)).withColumn("horizon", ahead)  # a row an origin
    p = F.get("coefficients", F.lit(0)) + sum((F.get("coefficients", F.lit(i + 1)) * F.col(c) for i, c in enumerate(columns)), F.lit(0.0))
    return rows.select(*keys, "origin", week, "horizon", F.col(y).alias("units"), F.greatest(p, F.lit(0.0)).alias("p50"))
