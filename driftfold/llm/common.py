"""What the text operators share: tables, shared scratch tables, and reading texts in Python workers."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts)), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where all run in one process."""
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if not (own := spark.sparkContext.getCheckpointDir()):
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="driftfold-"))
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # at exit the JVM may be gone already; the folder then goes with the cluster's scratch space
        pass


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as a table in the shared folder and return a scan of it.

    This cuts lineage so that a lost executor costs a re-read instead of a recomputation, and makes
    values that a rerun could change (generated ids) final. The table goes when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/driftfold/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)
    atexit.register(_remove, spark, path)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def discard(written: DataFrame) -> None:
    """Delete a table that materialize wrote; nothing may read it any more."""
    _remove(written.sparkSession, written.written_to)


#: Rows of text in an Arrow batch: the default, ten thousand, makes batches of long texts too large for a worker.
BATCH_ROWS = 1_000
#: Bytes of an Arrow batch after which no further row is put in; Spark's default is 64 MiB.
BATCH_BYTES = 1 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, after lowering its session's rows and bytes an Arrow batch to BATCH_ROWS and BATCH_BYTES where they are more."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(name)) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


#: Characters of text a Python worker turns into objects at once.
SLICE_CHARS = 4_000_000


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about `most` bytes of text or a single row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if column.nbytes <= most or batch.num_rows == 1:
            if batch.num_rows:
                yield batch
            continue
        start, size = 0, 0
        for i, n in enumerate(pc.binary_length(column).to_pylist()):
            if size and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        yield batch.slice(start)
    trim()


def trim() -> None:
    """Give memory that a worker no longer needs back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def hash_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The `limit` rows of smallest key hash.

    A first count sets a share that lets about twice as many rows through, so tasks do not each offer `limit` rows.
    """
    share = min(1.0, 2 * limit / max(1, df.count()))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    return df.where(place <= int(share * (1 << 30))).orderBy(place, key).limit(limit)


_MADE: dict[str, object] = {}


#: Leading characters of a key that name the use it belongs to.
USE = 32


def once(key: str, make: Callable[[], T]) -> T:
    """make(), once a worker process and key. What other uses have left is dropped: workers outlive them."""
    if key not in _MADE:
        for other in [k for k in _MADE if k[:USE] != key[:USE]]:
            del _MADE[other]
        _MADE[key] = make()
        trim()
    return _MADE[key]


def forget() -> None:
    """Drop what earlier uses have left in this worker."""
    _MADE.clear()
    trim()


def sized(df: DataFrame, name: str, rows: int, row_bytes: int) -> DataFrame:
    """df with a broadcast hint; rows * row_bytes must be a bound that holds for any input."""
    if rows * row_bytes > 1 << 28:
        raise ValueError(f"{name}: {rows * row_bytes} bytes are too many to broadcast")
    return F.broadcast(df)
