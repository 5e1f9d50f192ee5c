"""Writers for panels, result tables and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.sources.readers import path_exists


#: order of a panel's rows inside the files of a year
PANEL_ORDER = ("store_id", "family", "date")


def sort_panel(panel: DataFrame) -> DataFrame:
    """Rows of a task in order of year, series and day; readers of a year, a store or a series can skip the rest of a file."""
    if "year" not in panel.columns:
        panel = panel.withColumn("year", F.year("date"))
    return panel.sortWithinPartitions("year", *PANEL_ORDER)


def write_panel(panel: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a panel split by year and sorted inside each file, so that readers can skip.

    The one shuffle before the write spreads every year over many tasks by series.
    """
    if "year" not in panel.columns:
        panel = panel.withColumn("year", F.year("date"))
    writer = sort_panel(panel.repartition("year", "store_id", "family")).write.mode("overwrite").partitionBy("year")
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def write_bucketed(panel: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """Write a panel as a table in buckets by series, sorted by series and day, and return the table.

    Windows over a series, sums per series and joins of such tables then need no exchange. There are as many buckets as shuffle
    partitions unless told otherwise, and one file each. ``path`` is a folder that every executor can reach; the catalog holds the rest.
    """
    spark = panel.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (panel.repartition(count, *PANEL_ORDER[:2]).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(count, *PANEL_ORDER[:2]).sortBy(*PANEL_ORDER).saveAsTable(table))
    return spark.table(table)


def full_reload(table: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a warehouse table as a whole."""
    writer = table.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_results(results: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    for name, table in results.items():
        writer = table.write.mode("overwrite")
        target = f"{folder}/{name}"
        writer.csv(target, header=True) if fmt == "csv" else writer.format(fmt).save(target)


def export_subset(panel: DataFrame, from_year: int, fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """All rows of the recent years plus a seeded sample of the rest."""
    year = F.year("date")
    return panel.where(year >= from_year).unionByName(panel.where(year < from_year).sample(fraction, seed))


def export_subset_stable(panel: DataFrame, from_year: int, percent: int = 15,
                         keys: tuple[str, ...] = ("store_id", "family", "date")) -> DataFrame:
    """The same export with the sample decided by the row's keys, so that it repeats on any cluster."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).cast("binary"))
    drawn = F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % 100 < percent
    return panel.where((F.year("date") >= from_year) | drawn)


def export_small_results(spark: SparkSession, source: str, target: str, names: list[str]) -> list[str]:
    """Copy the result tables that exist to CSV; returns the names that were missing."""
    missing = []
    for name in names:
        if path_exists(spark, f"{source}/{name}"):
            spark.read.parquet(f"{source}/{name}").write.mode("overwrite").csv(f"{target}/{name}", header=True)
        else:
            missing.append(name)
    return missing


def export_model_metrics(spark: SparkSession, metrics: dict[str, float], path: str) -> None:
    spark.createDataFrame([metrics]).write.mode("overwrite").csv(path, header=True)


def export_alerts_csv(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("overwrite").csv(path, header=True)
