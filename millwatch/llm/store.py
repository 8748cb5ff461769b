"""What the operators share on Spark's side: the shared folder, saved tables, ids that may be null, Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A table may be broadcast when its whole rows, as measured, are within so many bytes.
BROADCAST_BYTES = 64 << 20
#: Stands for a null id inside an operator, so that such rows join, sort first and are not lost.
NO_ID = -(1 << 63)
_OWN: dict[str, str] = {}
#: Spark's setting for deleting the files of an execution's shuffles when it ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Seconds between two looks for shuffles that are done with.
CLEAN_SECONDS = 5.0
_CLEANED = 0.0
#: Rows of an Arrow batch between Spark and a worker: documents are long, and both sides hold whole batches.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Set the session to batches of BATCH_ROWS rows, for long rows; the setting stays, since a result is computed later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one that the cluster names in ``spark.checkpoint.dir``.

    Where the setting is missing, a session within one process gets a temporary folder; others are an error,
    since their executors may not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _OWN.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="millwatch-llm-")
        _OWN[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, and lineage ends there.

    The shuffles of the write are deleted when it ends, as nothing reads them again.
    """
    path = folder(df.sparkSession, name)
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path)
    _clean(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within it, an execution's shuffle files go when it ends, not when the driver's garbage collection finds them."""
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_END)
        else:
            spark.conf.set(SHUFFLES_END, before)


def _clean(spark: SparkSession) -> None:
    """Have the driver notice which shuffles nothing refers to any more, a few times a minute, so that Spark deletes their files."""
    global _CLEANED
    if (now := time.monotonic()) - _CLEANED >= CLEAN_SECONDS and (jvm := getattr(spark, "_jvm", None)) is not None:
        _CLEANED = now
        jvm.System.gc()


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast if the (saved) table's rows take at most BROADCAST_BYTES, else leave it to a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def id_key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


#: Column of ``keyed``.
KEY = "__key"


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(`docs` with KEY, keys): a number for each distinct (doc_id, text), in the order of doc_id (null first), then text.

    Where no rows share an id (one null among them), the number is that of ``id_key`` and keys is None. Else keys is a
    saved table of KEY and doc (NO_ID for null); texts of one id go by digest.
    """
    if docs.select(id_key("doc_id").alias("id")).groupBy("id").count().where("count > 1").isEmpty():
        return docs.withColumn(KEY, id_key("doc_id")), None
    own = docs.withColumns({"__doc": id_key("doc_id"), "__digest": F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))})
    # ranges are in order of partitions, and so are the numbers
    ranged = own.select("__doc", "__digest").distinct().repartitionByRange("__doc", "__digest").sortWithinPartitions("__doc", "__digest")
    keys = saved(ranged.withColumn(KEY, F.monotonically_increasing_id()), "keys")
    marked = own.join(small(keys, 100), ["__doc", "__digest"]).select(*[F.col(f"`{c}`") for c in docs.columns], KEY)
    return marked, keys.select(KEY, F.col("__doc").alias("doc"))


def map_arrow(df: DataFrame, fn: Callable[..., dict], schema: StructType | str, *extra, rows: int = 4096) -> DataFrame:
    """Apply ``fn(batch: pa.RecordBatch, *extra) -> {column: values}`` to pieces of at most `rows` rows."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return df.mapInArrow(Tidy(partial(_run, fn, schema, extra, rows)), schema)


class Tidy:
    """A function of ``mapInArrow`` whose worker gives free memory back to the system when the task ends.

    Workers are kept for later tasks, and what their allocators hold would be kept with them.
    """

    def __init__(self, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> None:
        self.fn = fn

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from self.fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # only where the C library can
                ctypes.CDLL("libc.so.6").malloc_trim(0)


def _run(fn, schema, extra, rows, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    target = arrow_schema(schema)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield record(fn(batch.slice(start, rows), *extra), target)


def arrow_schema(schema: StructType | str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def record(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    arrays = [
        v.cast(f.type) if isinstance(v := columns[f.name], pa.Array) else pa.array(v, type=f.type, from_pandas=False)
        for f in target
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def octets_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A binary column as a list of bytes; null is empty."""
    return [b"" if t is None else t for t in batch.column(name).to_pylist()]


def open_store(uri: str):
    """(file system, path) of a shared folder: a local or mounted path, or any scheme that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _rename(batch: pa.RecordBatch, uri: str) -> dict:
    store, path = open_store(uri)
    from pyarrow import fs

    for temporary, name in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist(), strict=True):
        # a task that runs again finds the file in place
        if store.get_file_info(f"{path}/{temporary}").type == fs.FileType.File:
            store.move(f"{path}/{temporary}", f"{path}/{name}")
        elif store.get_file_info(f"{path}/{name}").type != fs.FileType.File:
            raise FileNotFoundError(f"{path}/{temporary}")
    return {c: batch.column(c) for c in batch.schema.names}


def one_per_task(files: DataFrame) -> DataFrame:
    """The rows of a manifest dealt out evenly, about one to a task: a name is short, but the file behind it is not."""
    return files.repartition(_tasks(files))


def _tasks(files: DataFrame) -> int:
    return max(1, min(files.count(), 100_000))


def committed(written: DataFrame, uri: str, order: list[str], pattern: str) -> DataFrame:
    """Run a writer and give its files their names, numbered in order: the saved manifest of what is in place.

    `written` has one row per file with `temporary`, its name below `uri`. Only rows of tasks that succeeded are in it,
    so files of lost attempts keep their temporary names and are never read. The numbering is a window over one row
    per file, in an order that is the same however often it runs. Files are renamed one to a task, and the manifest is
    one file: each file that Spark writes to a folder of the local kind starts processes of the executor.
    """
    files = saved(written, "written")
    number = F.row_number().over(Window.orderBy(*order, "temporary")) - 1
    named = files.withColumn("name", F.format_string(pattern, number)).repartition(_tasks(files))
    return saved(map_arrow(named, _rename, named.schema, uri).repartition(1), "manifest")
