"""Shared storage, input columns and packed shuffles of the llm operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task turns into numpy arrays at a time (a longer single
#: text is taken whole).
CHUNK_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, so
    that workers import it wherever they were started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) gets a folder of ours;
    a cluster without one is an error, since executors' own disks are not
    visible to each other.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "/tmp/snapmetrics-checkpoints"
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/snapmetrics-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, and a
    lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """The two columns that matter, under names of ours, so that extra
    columns never clash; null text is empty.  ``more``: other columns made
    of the documents'."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more
    )


def byte_view(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, row offsets) of a string column, without copying."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def text_chunks(
    batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES, rows: int = 1 << 12
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` bytes of ``text`` and at most
    ``rows`` rows each, as (slice, bytes, offsets)."""
    for batch in batches:
        raw, off = byte_view(batch.column("text"))
        a = 0
        while a < batch.num_rows:
            b = min(max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1), a + rows)
            yield batch.slice(a, b - a), raw[off[a] : off[b]], off[a : b + 1] - off[a]
            a = b
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: a worker that is used again for
    another stage would otherwise keep its peak beside the next one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def input_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame, to choose partition counts."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
