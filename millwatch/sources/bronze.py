"""The bronze table: files in order of date, machine and time, and a manifest that says what is in each.

A version of the table is a list of files with their bounds (a zone map), written whole and put in place by a rename, so a
reader sees one version or the next. Readers choose files by their bounds before they open any; nothing is listed but the
manifest folder, which holds the last few versions. Files are never changed: a replacement or a compaction writes new
files and a version without the old ones, which readers of an earlier version still find until ``vacuum``.

One writer at a time: the stream that owns the table. A version that exists is not written again, so a second writer fails
instead of losing rows. A micro-batch is written once: its number is kept with the version, and a replay is left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEY = ("machine_id", "timestamp")
#: Versions that are kept for readers.
VERSIONS = 10
#: Files below half of this are put together by ``compact``.
FILE_BYTES = 128 << 20
ZONES = ("file string, first_machine string, last_machine string, first_ts bigint, last_ts bigint, rows bigint, "
         "bytes bigint, last_batch bigint")


def open_table(spark: SparkSession, path: str, schema: StructType | None = None) -> Bronze:
    """The table under a path; its schema is that of its files where none is given."""
    if schema is None:
        first = Bronze(spark, path, StructType([])).zones().select("file").take(1)
        schema = spark.read.parquet(first[0]["file"]).schema if first else StructType([])
    return Bronze(spark, path, schema)


@dataclass(frozen=True)
class Bronze:
    """A table of readings under ``path``. ``schema`` is that of its rows, with ``machine_id``, ``timestamp`` and ``date``."""

    spark: SparkSession
    path: str
    schema: StructType

    # versions

    def _files(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.path}/_manifest")
        return hadoop, folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the versions in place, in order."""
        _, folder, system = self._files()
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def zones(self, version: int | None = None) -> DataFrame:
        """The files of a version (the last one) with their bounds."""
        there = self.versions()
        if version is None and there:
            version = there[-1]
        if version is None:
            return self.spark.createDataFrame([], ZONES)
        return self.spark.read.schema(ZONES).parquet(f"{self.path}/_manifest/v={version:012d}")

    def _commit(self, zones: DataFrame, version: int) -> None:
        hadoop, folder, system = self._files()
        temporary = f"{self.path}/_manifest/_temporary-{uuid.uuid4().hex}"
        zones.coalesce(1).write.parquet(temporary)  # a row per file
        place = hadoop.Path(f"{self.path}/_manifest/v={version:012d}")
        if system.exists(place) or not system.rename(hadoop.Path(temporary), place):
            raise RuntimeError(f"version {version} has been written by another writer")
        for old in self.versions()[:-VERSIONS]:
            system.delete(hadoop.Path(f"{self.path}/_manifest/v={old:012d}"), True)

    # writing

    def _written(self, rows: DataFrame, last_batch: int, parts: int | None = None) -> DataFrame:
        """Write rows in order, in a folder of their own, and give the bounds of its files. Of no rows, none."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        order = ["date", *KEY]
        own = rows.select(*self.schema.names)
        ranged = own.repartitionByRange(parts, *order) if parts else own.repartitionByRange(*order)
        ranged.sortWithinPartitions(*order).write.parquet(folder)
        back = self.spark.read.schema(self.schema).parquet(folder)
        return back.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min("machine_id").alias("first_machine"), F.max("machine_id").alias("last_machine"),
            F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count(F.lit(1)).alias("rows"),
            F.max("_metadata.file_size").alias("bytes"), F.lit(last_batch).cast("bigint").alias("last_batch"))

    def _last_batch(self, zones: DataFrame) -> int:
        return zones.agg(F.coalesce(F.max("last_batch"), F.lit(-1).cast("bigint"))).first()[0]

    def append(self, rows: DataFrame, batch_id: int | None = None) -> bool:
        """Add rows; False if the micro-batch is in the table already."""
        return self._put(rows, batch_id, replace=False)

    def replace_last(self, rows: DataFrame, batch_id: int | None = None, order: str = "seq") -> bool:
        """Add rows so that one is left per machine and time: the last by ``order``, whenever it arrives.

        Only files that hold one of the arriving (machine, time) pairs are written anew.
        """
        return self._put(rows, batch_id, replace=True, order=order)

    def _put(self, rows: DataFrame, batch_id: int | None, replace: bool, order: str = "seq") -> bool:
        there = self.versions()
        zones = self.zones()
        last = self._last_batch(zones)
        if batch_id is not None and batch_id <= last:
            return False
        now = max(last, batch_id if batch_id is not None else last)
        if replace:
            rows, gone = self._with_older(_last(rows, order), zones, order)
            zones = zones.join(gone, "file", "left_anti")
        added = self._written(rows, now)
        number = (there[-1] if there else -1) + 1
        self._commit(zones.withColumn("last_batch", F.greatest("last_batch", F.lit(now))).unionByName(added), number)
        return True

    def _with_older(self, rows: DataFrame, zones: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
        """The rows together with those of all files that hold one of their keys, and these files."""
        low, high = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
        near = self._chosen(zones, since=low, until=high) if low is not None else []
        nothing = self.spark.createDataFrame([], "file string")
        if not near:
            return rows, nothing
        hit = self._open(near).select(*KEY, F.col("_metadata.file_path").alias("file")).join(
            rows.select(*KEY), list(KEY), "left_semi").select("file").distinct()
        names = [r["file"] for r in hit.collect()]  # names of files, not rows
        if not names:
            return rows, nothing
        both = self._open(names).unionByName(rows.select(*self.schema.names))
        return _last(both, order), self.spark.createDataFrame([(n,) for n in names], "file string")

    def compact(self, file_bytes: int = FILE_BYTES) -> int:
        """Put small files together, in order; gives how many were replaced. Readers of earlier versions are not disturbed."""
        there, zones = self.versions(), self.zones()
        names = [r["file"] for r in zones.where(F.col("bytes") < file_bytes // 2).select("file").collect()]
        if len(names) < 2:
            return 0
        size = zones.where(F.col("bytes") < file_bytes // 2).agg(F.sum("bytes")).first()[0]
        added = self._written(self._open(names), self._last_batch(zones), max(1, -(-size // file_bytes)))
        gone = self.spark.createDataFrame([(n,) for n in names], "file string")
        self._commit(zones.join(gone, "file", "left_anti").unionByName(added), there[-1] + 1)
        return len(names)

    def vacuum(self) -> int:
        """Delete files that no kept version names; gives how many. For times without readers of older versions."""
        used = {r["file"] for v in self.versions() for r in self.zones(v).select("file").collect()}
        hadoop, _, system = self._files()
        data = hadoop.Path(f"{self.path}/data")
        gone = 0
        for folder in system.listStatus(data) if system.exists(data) else []:
            for file in system.listStatus(folder.getPath()):
                name = file.getPath()
                if name.getName().endswith(".parquet") and not any(u.endswith(f"{folder.getPath().getName()}/{name.getName()}") for u in used):
                    gone += system.delete(name, False)
        return gone

    # reading

    def _chosen(self, zones: DataFrame, *, since: int | None = None, until: int | None = None,
                machines: Sequence[str] | None = None) -> list[str]:
        keep = F.lit(True)
        if since is not None:
            keep = keep & (F.col("last_ts") >= since)
        if until is not None:
            keep = keep & (F.col("first_ts") <= until)
        if machines is not None:
            inside = F.lit(False)
            for m in machines:
                inside = inside | F.lit(m).between(F.col("first_machine"), F.col("last_machine"))
            keep = keep & inside
        return [r["file"] for r in zones.where(keep).select("file").collect()]

    def _open(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*names)

    def read(self, *, since: int | None = None, until: int | None = None, machines: Sequence[str] | None = None,
             version: int | None = None) -> DataFrame:
        """Rows of a version (the last one), by bounds in epoch ms, both included, and machines.

        Only files whose bounds meet the request are opened; within them Spark pushes the same bounds to the row groups.
        """
        if not self.schema.names:  # opened before anything had been written
            return self.spark.createDataFrame([], self.schema)
        rows = self._open(self._chosen(self.zones(version), since=since, until=until, machines=machines))
        if since is not None:
            rows = rows.where(F.col("timestamp") >= since)
        if until is not None:
            rows = rows.where(F.col("timestamp") <= until)
        return rows if machines is None else rows.where(F.col("machine_id").isin(*machines))


def _last(rows: DataFrame, order: str) -> DataFrame:
    """One row per machine and time, the last by ``order``; combined before the shuffle."""
    names = rows.columns
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*names), order).alias("_r")).select("_r.*")
