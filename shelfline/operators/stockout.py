"""Stock-out patterns, risk scores, reorder points and alerts."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.lookups import ALERT_LEVELS, RISK_LEVELS, SEASON_LABELS, WEEKDAYS
from shelfline.functions.rounding import round_exact, round_scaled, whole_text
from shelfline.operators.features import SERIES
from shelfline.plans.staging import Stage, lazy

# The published ordering parameters.
LEAD_TIME_DAYS, ORDER_CYCLE_DAYS, Z_95, Z_99 = 2, 7, 1.65, 2.33


def attach_predictions(df: DataFrame, predictions: DataFrame | None = None) -> DataFrame:
    """Predicted sales by series and day; null where there is none, actual sales if no table is given."""
    if predictions is None:
        return df.withColumn("predicted_sales", F.col("sales"))
    keyed = predictions.select(*SERIES, "date", F.col("predicted").alias("predicted_sales"))
    return df.join(keyed, [*SERIES, "date"], "left")


def row_count(df: DataFrame) -> Column:
    """Number of panel rows in a group of the panel, or behind a group of its sums (``rollup``)."""
    return F.sum("_rows") if "_rows" in df.columns else F.count(F.lit(1))


def mean_of(df: DataFrame, column: str) -> Column:
    """Mean of a column over the panel's rows, from them or from sums."""
    return F.sum(column) / F.sum("_rows") if "_rows" in df.columns else F.avg(column)


def _zero_rate(df: DataFrame) -> Column:
    return mean_of(df, "is_zero_sale") * 100


def stockout_overall(df: DataFrame) -> DataFrame:
    return df.agg(row_count(df).alias("total_days"), F.sum("is_zero_sale").alias("stockout_days"),
                  _zero_rate(df).alias("stockout_rate"))


def _by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        row_count(df).alias("total_days"), F.sum("is_zero_sale").alias("stockout_days"),
        mean_of(df, "sales").alias("avg_sales")).withColumn(
        "stockout_rate", round_scaled(F.col("stockout_days") / F.col("total_days") * 100, 1))


def stockout_by_store_type(df: DataFrame) -> DataFrame:
    return _by(df, "store_type").orderBy(F.desc("stockout_rate"), "store_type")


def stockout_by_category(df: DataFrame, n: int | None = None) -> DataFrame:
    ordered = _by(df, "category").orderBy(F.desc("stockout_rate"), "category")
    return ordered if n is None else ordered.limit(n)


def weekday_position(column: str = "day_name") -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col(column)).cast("int") - 1


def weekday_order(df: DataFrame, column: str = "day_name") -> DataFrame:
    return df.withColumn("day_order", weekday_position(column)).orderBy("day_order")


def stockout_by_dow(df: DataFrame) -> DataFrame:
    return weekday_order(_by(df, "day_name").drop("avg_sales"))


def season_means(df: DataFrame, value: str, flags: list[str]) -> DataFrame:
    """Mean of a value with each flag set and not set, in one pass, as (flag, inside, outside); from the panel or its sums."""
    if "_rows" in df.columns:
        kind = {"sales": "sales", "is_zero_sale": "zeros"}[value]
        ins = {f: (F.sum(f"{f}_{kind}"), F.sum(f"{f}_rows")) for f in flags}
        sums = df.agg(*[F.try_divide(a, n).alias(f"{f}_1") for f, (a, n) in ins.items()],
                      *[F.try_divide(F.sum(value) - a, F.sum("_rows") - n).alias(f"{f}_0") for f, (a, n) in ins.items()])
    else:
        sums = df.agg(*[F.avg(F.when(F.col(f) == v, F.col(value))).alias(f"{f}_{v}") for f in flags for v in (1, 0)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col(f"{f}_1").alias("inside"), F.col(f"{f}_0").alias("outside"))
        for f in flags])))


def stockout_by_season(df: DataFrame) -> DataFrame:
    means = season_means(df, "is_zero_sale", list(SEASON_LABELS))
    name = F.coalesce(*[F.when(F.col("flag") == f, F.lit(label)) for f, label in SEASON_LABELS.items()])
    change = F.col("inside") * 100 - F.col("outside") * 100
    return means.select(name.alias("season"), (F.col("inside") * 100).alias("in_rate"),
                        (F.col("outside") * 100).alias("out_rate"), change.alias("difference"),
                        F.when(change > 0, "UP").otherwise("DOWN").alias("direction"))


def stockout_by_family(df: DataFrame, n: int = 15) -> DataFrame:
    return (df.groupBy("family").agg(_zero_rate(df).alias("stockout_rate"))
            .orderBy(F.desc("stockout_rate"), "family").limit(n))


def stockout_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy("month").agg(_zero_rate(df).alias("stockout_rate"))


def attribute_lookup(df: DataFrame, keys: str, columns: list[str]) -> DataFrame:
    """One value per key and attribute; attributes are constant per key, so the smallest is the value."""
    return df.groupBy(keys).agg(*[F.min(c).alias(c) for c in columns])


def risk_category(score: Column) -> Column:
    """Right-closed bands of 25; 0 and anything above 100 have none."""
    low, medium, high, critical = RISK_LEVELS
    return (F.when((score > 0) & (score <= 25), low).when((score > 25) & (score <= 50), medium)
            .when((score > 50) & (score <= 75), high).when((score > 75) & (score <= 100), critical))


def risk_scores(df: DataFrame, stage: Stage = lazy) -> DataFrame:
    """Risk of each store and family from its zero share, demand, longest streak and volatility.

    The attributes travel as ``min`` in the same aggregation, so no join rebuilds them. The three maxima
    are one scalar row; a writing ``stage`` keeps the sums per series, so that the panel is read once.
    """
    stats = stage(df.groupBy(*SERIES).agg(
        F.count("sales").alias("total_days"), F.sum("is_zero_sale").alias("zero_sale_days"),
        F.avg("sales").alias("avg_sales"), F.sum("sales").alias("total_sales"),
        F.max("consecutive_zeros").alias("max_consecutive_zeros"),
        F.avg("sales_rolling_mean_7d").alias("avg_rolling_mean"),
        F.avg("sales_rolling_std_7d").alias("sales_volatility"),
        F.min("city").alias("city"), F.min("store_type").alias("store_type"),
        F.min("category").alias("category"), F.min("is_fmcg").alias("is_fmcg")), "series_stats")
    top = stats.agg(F.struct(F.max("avg_sales").alias("a"), F.max("max_consecutive_zeros").alias("z"),
                             F.max("sales_volatility").alias("v")).alias("top")).scalar()

    def share(value: str, largest: str) -> Column:
        return F.try_divide(F.col(value), F.col(f"_top.{largest}")) * 100

    rate = round_scaled(F.col("zero_sale_days") / F.col("total_days") * 100, 2)
    scored = stats.withColumn("stockout_rate", rate).withColumn("_top", top).withColumn(
        "risk_score", round_scaled(F.col("stockout_rate") * 0.3 + share("avg_sales", "a") * 0.3
                                   + share("max_consecutive_zeros", "z") * 0.2
                                   + share("sales_volatility", "v") * 0.2, 1))
    return scored.withColumns({
        "revenue_impact": round_scaled(F.col("avg_sales") * F.col("zero_sale_days"), 0),
        "risk_category": risk_category(F.col("risk_score"))}).drop("_top")


def risk_distribution(risk: DataFrame) -> DataFrame:
    counts = risk.groupBy("risk_category").agg(F.count(F.lit(1)).alias("series"))
    total = F.sum("series").over(Window.partitionBy())  # at most five rows
    return counts.withColumn("pct", F.col("series") / total * 100)


def top_risks(risk: DataFrame, n: int = 20) -> DataFrame:
    return risk.orderBy(F.desc("risk_score"), *SERIES).limit(n)


def reorder_points(df: DataFrame, lead_time: int = LEAD_TIME_DAYS, z_95: float = Z_95, z_99: float = Z_99,
                   cycle: int = ORDER_CYCLE_DAYS) -> DataFrame:
    """Safety stock, reorder points and order quantity per store and family.

    The exact median stays: a series has one row per day, so its value map is small.
    """
    stats = df.groupBy(*SERIES).agg(
        F.avg("sales").alias("avg_daily_demand"), F.stddev_samp("sales").alias("std_daily_demand"),
        F.max("sales").alias("max_daily_demand"), F.median("sales").alias("median_demand"),
        F.count("sales").alias("total_days"),
        F.min("city").alias("city"), F.min("category").alias("category"), F.min("is_fmcg").alias("is_fmcg"))
    demand, deviation = F.col("avg_daily_demand"), F.col("std_daily_demand")
    stats = stats.withColumns({
        "safety_stock_95": round_scaled(F.lit(z_95) * deviation * sqrt(lead_time)),
        "safety_stock_99": round_scaled(F.lit(z_99) * deviation * sqrt(lead_time)),
        "suggested_order_qty": round_scaled(demand * cycle)})
    return stats.withColumns({
        "reorder_point_95": round_scaled(demand * lead_time + F.col("safety_stock_95")),
        "reorder_point_99": round_scaled(demand * lead_time + F.col("safety_stock_99")),
        "max_stock_level": round_scaled(F.col("suggested_order_qty") + F.col("safety_stock_95"))})


def reorder_with_risk(reorder: DataFrame, risk: DataFrame) -> DataFrame:
    """Both sides are grouped by series already, so the join needs no further shuffle."""
    return reorder.join(risk.select(*SERIES, "stockout_rate", "risk_score", "risk_category"), SERIES, "left")


def top_reorders(reorder: DataFrame, n: int = 20, active_only: bool = False) -> DataFrame:
    rows = reorder.where(F.col("avg_daily_demand") > 0) if active_only else reorder
    return rows.orderBy(F.desc("risk_score"), *SERIES).limit(n)


def latest_snapshot(df: DataFrame, as_of=None) -> DataFrame:
    """Rows of one day, by default the newest; the filter reaches the scan as a runtime value.

    A panel with a ``year`` column is cut to the year first: where years are folders, the others are not read.
    """
    if "year" in df.columns:
        year = F.year(F.lit(as_of).cast("date")) if as_of is not None else df.agg(F.max("year")).scalar()
        df = df.where(F.col("year") == year)
    day = F.lit(as_of).cast("date") if as_of is not None else df.agg(F.max("date").alias("d")).scalar()
    return df.where(F.col("date") == day)


def last_per_series(df: DataFrame, days: int = 7) -> DataFrame:
    """Each series' newest row in the last days of the data."""
    newest = df.agg(F.max("date").alias("d")).scalar()
    others = [c for c in df.columns if c not in (*SERIES, "date")]
    recent = df.where(F.col("date") >= F.date_sub(newest, days))
    return (recent.groupBy(*SERIES).agg(F.max_by(F.struct("date", *others), "date").alias("r"))
            .select(*SERIES, "r.*"))


def alert_ladder(snapshot: DataFrame) -> DataFrame:
    """First matching rule gives the level; rows that match none are dropped.

    A seven-row mean cannot exceed 10 after seven zeros, so CRITICAL fires on streaks of 3 to 6 only.
    """
    streak, demand, expected = F.col("consecutive_zeros"), F.col("sales_rolling_mean_7d"), F.col("predicted_sales")
    out = F.col("is_zero_sale") == 1
    streak_text = streak.cast("string")
    rules = [
        ("CRITICAL", (streak >= 3) & (F.col("is_fmcg") == 1) & (demand > 10),
         F.concat(streak_text, F.lit(" consecutive zero-sale days for high-demand FMCG product"))),
        ("HIGH", (streak >= 2) & (demand > 10),
         F.concat(streak_text, F.lit(" consecutive zero-sale days, avg demand: "), whole_text(demand))),
        ("MEDIUM", out & (expected > demand * 1.2),
         F.concat(F.lit("Stockout today, predicted demand ("), whole_text(expected),
                  F.lit(") above average ("), whole_text(demand), F.lit(")"))),
        ("LOW", out & (demand > 5),
         F.concat(F.lit("Stockout today for product with avg demand "), whole_text(demand))),
    ]
    hit = F.coalesce(*[F.when(condition, F.struct(F.lit(level).alias("level"), text.alias("reason")))
                       for level, condition, text in rules])
    return snapshot.withColumn("_hit", hit).where(F.col("_hit").isNotNull()).select(
        "store_id", "family", F.coalesce("city", F.lit("Unknown")).alias("city"),
        F.coalesce("category", F.lit("Unknown")).alias("category"), F.col("_hit.level").alias("alert_level"),
        F.col("_hit.reason").alias("alert_reason"), F.col("consecutive_zeros").cast("int").alias("consecutive_zeros"),
        round_exact(demand, 1).alias("avg_daily_demand"), round_exact(expected, 1).alias("predicted_demand"),
        round_exact(demand * 7, 0).alias("suggested_order"), F.col("date").cast("string").alias("date"))


def severity(column: str = "alert_level") -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in ALERT_LEVELS]), F.col(column))


def sort_alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(severity(), F.desc("avg_daily_demand"), *SERIES)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts per level in severity order; a level without alerts counts 0."""
    columns = [F.count_if(F.col("alert_level") == level).alias(level) for level in ALERT_LEVELS]
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("severity"), F.lit(level).alias("alert_level"),
                               F.col(level).alias("alerts")) for i, level in enumerate(ALERT_LEVELS)])
    return alerts.agg(*columns).select(F.inline(pairs)).orderBy("severity")


def alert_volume_by_family(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (alerts.groupBy("family").agg(F.sum("suggested_order").alias("suggested_order"))
            .orderBy(F.desc("suggested_order"), "family").limit(n))


def stockout_heatmap(df: DataFrame, categories: list[str], n: int = 20) -> DataFrame:
    """Zero share by store and category for the n worst stores, one column per category.

    Sums per store and category come first; picking the stores and pivoting then touch only those.
    """
    sums = df.groupBy("store_id", "category").agg(F.sum("is_zero_sale").alias("z"), row_count(df).alias("n"))
    per_store = sums.groupBy("store_id").agg((F.sum("z") / F.sum("n")).alias("_rate"))
    worst = per_store.orderBy(F.desc("_rate"), "store_id").limit(n).select("store_id")
    cells = sums.join(F.broadcast(worst), "store_id", "left_semi")  # n rows
    return (cells.groupBy("store_id").pivot("category", categories).agg(F.max(F.col("z") / F.col("n") * 100))
            .na.fill(0.0))


def alert_totals(risk: DataFrame, alerts: DataFrame) -> DataFrame:
    series = risk.agg(F.count(F.lit(1)).alias("n")).scalar()
    return alerts.agg(F.count(F.lit(1)).alias("total_alerts"),
                      F.count_if(F.col("alert_level") == "CRITICAL").alias("critical_alerts")).withColumn(
        "total_series", series)


def filter_alert_levels(alerts: DataFrame, levels: list[str]) -> DataFrame:
    return alerts.where(F.col("alert_level").isin(levels))
