"""Exact quantiles, ranks and row numbers over a whole table without a one-task sort.

Ranks over tables of unknown size first count the rows of each distinct value, so a value that holds a large share of
the table is one row from then on. The distinct values are cut into buckets at approximate quantiles,
running counts are taken inside each bucket in parallel, and an offset from the bucket totals (at most
``buckets`` rows) is added. The cuts only balance the work; the results are exact whatever they are. Quantiles work alike, on
the values near them alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.plans.sizing import is_small
from shelfline.plans.staging import Stage, WrittenTables, lazy

_ACCURACY = 10000  # of sketches: ranks are off by one in so many rows at most

def _buckets(df: DataFrame, buckets: int | None) -> int:
    """As many as there are shuffle partitions, so the work spreads with the cluster."""
    return buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _offsets(totals: DataFrame, order: Column) -> DataFrame:
    """Rows before each bucket, and of all; ``totals`` has one row per bucket."""
    running = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.select("_bucket", (F.sum("_weight").over(running) - F.col("_weight")).alias("_before"),
                         F.sum("_weight").over(Window.partitionBy()).alias("_rows"))


def _value_spans(df: DataFrame, column: str, descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Distinct values with the half-open range of positions [_lo, _hi) their rows take, and the row count.

    Values keep their type; only the cut points are doubles, as they decide nothing but the bucket.
    """
    buckets = _buckets(df, buckets)
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    near = F.col("_v").cast("double")
    cuts = counts.agg(F.percentile_approx(near, [i / buckets for i in range(1, buckets)], _ACCURACY).alias("c")).scalar()
    # never null, so that no null check on the bucket is pushed down to the rows of the table
    position = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < near)), F.lit(0))
    placed = counts.withColumn("_cuts", cuts).withColumn("_bucket", position).drop("_cuts")

    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    offsets = _offsets(placed.groupBy("_bucket").agg(F.sum("_n").alias("_weight")), order)
    inside = Window.partitionBy("_bucket").orderBy(F.col("_v").desc() if descending else F.col("_v").asc())
    upper = F.col("_before") + F.sum("_n").over(inside)
    return (placed.join(F.broadcast(offsets), "_bucket")  # at most ``buckets`` rows
            .select("_v", "_n", "_rows", upper.alias("_hi"), (upper - F.col("_n")).alias("_lo")))


def _spans_near(df: DataFrame, column: str, q: float, buckets: int | None = None) -> DataFrame:
    """Spans of positions as above, value by value around the quantile and in one row each for all below and all above.

    A sketch gives bounds that hold the quantile between them, whatever the distribution: its ranks are off by a ten-thousandth of
    the rows at most, and the bounds are three of these away. The second pass adds up rows on each side and counts only the values
    between, so about a two-thousandth of the rows is shuffled. ``_lowest`` and ``_highest`` are the ends of a span's values.
    """
    buckets, margin = _buckets(df, buckets), 3 / _ACCURACY
    first, last = max(0.0, q - margin), min(1.0, q + margin)
    rows = df.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull())
    cuts = rows.agg(F.percentile_approx(F.col("_v").cast("double"), [first + (last - first) * i / buckets for i in range(buckets + 1)],
                                        _ACCURACY).alias("c")).scalar()
    near = F.col("_v").cast("double")
    side = F.when(near < F.get("_cuts", F.lit(0)), -1).when(near > F.get("_cuts", F.lit(buckets)), 1).otherwise(0)
    groups = (rows.withColumn("_cuts", cuts).withColumn("_side", side).groupBy("_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lowest"), F.max("_v").alias("_highest")))
    place = F.size(F.filter("_cuts", lambda cut: cut < F.col("_lowest").cast("double")))
    bucket = F.coalesce(F.when(F.col("_side") == 0, place).otherwise(F.col("_side") * (buckets + 2)), F.lit(0))
    placed = groups.withColumn("_cuts", cuts).withColumn("_bucket", bucket).drop("_cuts", "_side", "_v")

    # reads all columns of the groups, as the join below does, so that both share one exchange and the table is not read again
    weight = F.sum(F.when(F.col("_lowest") <= F.col("_highest"), F.col("_n")))
    offsets = _offsets(placed.groupBy("_bucket").agg(weight.alias("_weight")), F.col("_bucket").asc())
    upper = F.col("_before") + F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_lowest"))
    return (placed.join(F.broadcast(offsets), "_bucket")  # at most ``buckets`` rows and three
            .select("_lowest", "_highest", "_rows", upper.alias("_hi"), (upper - F.col("_n")).alias("_lo")))


def exact_quantile(df: DataFrame, column: str, q: float, buckets: int | None = None) -> DataFrame:
    """One row, column ``quantile`` (double): linear interpolation between the two nearest order statistics.

    The order statistics are found in the column's own type; only the interpolated result is a double. Nulls are left out,
    and the quantile of nothing is null. The table is read twice, and no list of all its values is made.
    """
    position = (F.col("_rows") - 1) * F.lit(float(q))
    low, high = F.floor(position), F.ceil(position)

    def value_at(index: Column) -> Column:
        at_first = (F.col("_lowest") == F.col("_highest")) | (index == F.col("_lo"))
        value = (F.when(at_first, F.col("_lowest")).when(index == F.col("_hi") - 1, F.col("_highest"))
                 .otherwise(F.raise_error(F.lit("the quantile is outside the bounds of its sketch"))))
        return F.max(F.when((F.col("_lo") <= index) & (index < F.col("_hi")), value))

    ends = _spans_near(df, column, q, buckets).agg(
        value_at(low).cast("double").alias("_a"), value_at(high).cast("double").alias("_b"), F.max(position - low).alias("_t"))
    return ends.select((F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_t")).alias("quantile"))


def with_rank(df: DataFrame, key: str, out: str, method: str = "min", bound: DataFrame | None = None,
              buckets: int | None = None) -> DataFrame:
    """Rank by ``key``, largest first. ``min`` gives SQL RANK, ``average`` the mean rank of ties.

    If the rows are bounded by a table of checked small size (``bound``), one task ranks them. Otherwise
    ranks are found per distinct value, and rows get theirs by an equi-join, where adaptive execution
    splits a value that many rows share. Both ways compare keys in their own type and give the same ranks. Rows
    with a null key are left out.
    """
    if is_small(bound):
        first = F.rank().over(Window.partitionBy().orderBy(F.col(key).desc()))
        ties = F.count(F.lit(1)).over(Window.partitionBy(key))
        rank = first + (ties - 1) / 2.0 if method == "average" else first.cast("long")
        return df.where(F.col(key).isNotNull()).withColumn(out, rank)
    spans = _value_spans(df, key, descending=True, buckets=buckets)
    rank = F.col("_lo") + (F.col("_n") + 1) / 2.0 if method == "average" else (F.col("_lo") + 1).cast("long")
    ranks = spans.select(F.col("_v").alias("_key"), rank.alias(out))
    return df.join(ranks, F.col(key) == F.col("_key")).drop("_key")


def with_row_number(df: DataFrame, order: list[str], out: str = "row_number", total: str | None = None,
                    stage: Stage | None = None) -> DataFrame:
    """1-based position by ``order`` over the whole table; the columns of ``order`` identify a row.

    Rows are range-partitioned on the whole key, so no prefix of it has to fit in one task, and written once
    with their partition and place in it, when this is called. Row counts per partition then give each partition's
    offset. ``lazy`` is refused: the ranges would be drawn anew for the offsets, and might not fit the rows.
    """
    if stage is lazy:
        raise ValueError("row numbers need a stage that writes")
    stage = stage or WrittenTables(df.sparkSession)
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_id", F.monotonically_increasing_id()), "ordered_rows")
    part = F.shiftright("_id", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("_part", (F.sum("_size").over(running) - F.col("_size")).alias("_before"),
                           F.sum("_size").over(Window.partitionBy()).alias("_rows"))
    place = F.col("_id").bitwiseAND(F.lit(2 ** 33 - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # one row per partition
    columns = [*df.columns, (F.col("_before") + place + 1).alias(out)]
    return numbered.select(*columns, *([F.col("_rows").alias(total)] if total else []))
