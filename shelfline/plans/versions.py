"""Tables with versions: a run publishes a whole new state at once, and readers see the old one until then.

Each run writes a folder of its own and then publishes it by creating a small file, ``_versions/<n>``, that says which
folder holds which part of the table. The newest such file is the table. A run that fails before leaves no file, so nothing
changes; of two runs that publish the same number, the second fails. Parts are the values of one partition column: a run that
touches a few of them writes those alone, and the new version takes the others from where they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

WHOLE = ""


class VersionedTable:
    """A table under ``root``, in parts by ``part`` if it is given. Parts are values of a string, integer or date column, not null."""

    def __init__(self, spark: SparkSession, root: str, part: str | None = None):
        self.spark, self.root, self.part = spark, root.rstrip("/"), part
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path

    def _file(self, name: str):
        path = self._fs_path(f"{self.root}/_versions/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        path, fs = self._file("")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(path)) if fs.exists(path) else []

    def _state(self, version: int | None) -> dict:
        held = self.versions()
        if version is None and not held:
            raise LookupError(f"nothing is published under {self.root}")
        path, fs = self._file(f"{held[-1] if version is None else version:08d}")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or a given one."""
        state = self._state(version)
        schema = StructType.fromJson(state["schema"])
        folders: dict[str, list[str]] = {}
        for value, folder in state["parts"].items():
            folders.setdefault(folder, []).append(value)
        out = None
        for folder, values in sorted(folders.items()):
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
            if self.part:
                rows = rows.where(F.col(self.part).cast("string").isin(values))  # on a folder's name: prunes, reads nothing
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], schema) if out is None else out.select(schema.fieldNames())

    def publish(self, rows: DataFrame) -> int:
        """Replace the table as a whole; returns the version."""
        return self._publish(rows, {})

    def publish_parts(self, rows: DataFrame) -> int:
        """Replace the parts that ``rows`` touch and keep all others."""
        if not self.part:
            raise ValueError("the table has no parts")
        return self._publish(rows, self._state(None)["parts"] if self.versions() else {})

    def _publish(self, rows: DataFrame, kept: dict[str, str]) -> int:
        version = (self.versions() or [0])[-1] + 1
        folder = f"v{version}-{uuid.uuid4().hex[:8]}"  # no two runs write the same folder
        writer = rows.write
        (writer.partitionBy(self.part) if self.part else writer).parquet(f"{self.root}/{folder}")
        touched = [WHOLE]
        if self.part:  # one row a part, from the folders' names
            written = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")
            touched = [r[0] for r in written.select(F.col(self.part).cast("string")).distinct().collect()]
        state = {"schema": rows.schema.jsonValue(), "parts": {**kept, **dict.fromkeys(touched, folder)}}
        path, fs = self._file(f"{version:08d}")
        stream = fs.create(path, False)  # fails if another run has published this number
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        return version
