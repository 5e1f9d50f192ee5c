"""The dense panel: one row per series and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.plans.staging import Stage, lazy


def densify_panel(sales: DataFrame, keys: list[str], date: str = "date",
                  measures: dict[str, str] | None = None, stage: Stage = lazy) -> DataFrame:
    """Give each observed series a row for each observed day; absent days hold 0.

    Rows are first summed per series and day (map-side combine), then only those sums move to the
    series' partition. The zero days are added there, so the dense panel itself is never shuffled and
    arrives partitioned by series, ready for the windows. A series holds at most one entry per day.

    A writing ``stage`` keeps the sums, so that ``sales``, which may be the result of joins, is read once; the days then come from the sums.
    """
    measures = measures or {"sales": "double", "onpromotion": "int"}
    daily = sales.groupBy(*keys, date).agg(*[F.sum(m).cast(t).alias(m) for m, t in measures.items()])
    if stage is not lazy:
        daily = sales = stage(daily, "daily")
    # without a stage, the days come from the rows themselves, deduplicated where they are read, not from the shuffled sums
    empty_days = (sales.select(date).distinct().agg(F.collect_set(date).alias("days"))
                  .select(F.transform("days", lambda day: F.struct(
                      day.alias(date), *[F.lit(0).cast(t).alias(m) for m, t in measures.items()])).alias("rows"))
                  .scalar())
    series = daily.groupBy(*keys).agg(F.collect_list(F.struct(date, *measures)).alias("rows"))
    return (series.withColumn("rows", F.concat("rows", empty_days))
            .select(*keys, F.inline("rows"))
            .groupBy(*keys, date).agg(*[F.sum(m).cast(t).alias(m) for m, t in measures.items()]))
