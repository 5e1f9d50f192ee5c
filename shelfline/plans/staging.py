"""Written tables between the steps of a flow.

A step whose result several later steps read is written once to the shared folder and read back as
Parquet: the plan stays small, later steps read only the columns they need, and a lost executor never
forces the flow to start over. ``lazy`` keeps everything in one plan instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.session import ensure_checkpoint_dir

Stage = Callable[..., DataFrame]


def lazy(df: DataFrame, name: str, partition_by: tuple = (), sort_by: tuple = ()) -> DataFrame:
    return df


class WrittenTables:
    """Stage that writes each table under a folder of its own and returns the table read back."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self._written = 0
        self.root = f"{(folder or ensure_checkpoint_dir(spark)).rstrip('/')}/shelfline-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str, partition_by: tuple = (), sort_by: tuple = ()) -> DataFrame:
        """Write and reread; with folders by ``partition_by``, and rows in order of ``sort_by`` inside each file."""
        self._written += 1
        path = f"{self.root}/{self._written:03d}-{name}"  # never over a table that a frame still reads
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(df.columns)

    def close(self) -> None:
        """Remove the written tables; frames that read them can't be used any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> WrittenTables:
        return self

    def __exit__(self, *_) -> None:
        self.close()
