"""Helpers shared by the text operators: shared scratch storage, Arrow batches, byte-wise words."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``: later joins on it don't shuffle it again."""
    spark = df.sparkSession
    path = work_path(spark, "buckets")
    name = "buckets_" + path.rpartition("-")[2]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, as ``--py-files`` would, and keep Arrow batches of texts small."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        path = os.path.join(tempfile.mkdtemp(prefix="roadrisk-py-"), "roadrisk_llm.zip")
        Path(path).write_bytes(held.getvalue())
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    if spark.conf.get(_BATCH_ROWS) == "10000":  # Spark's default, which is for short rows; a setting of the user's stays
        spark.conf.set(_BATCH_ROWS, "1000")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a path as Spark writes it (``file:/x``, ``/x`` or ``scheme://x``)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def text_bytes(col: str) -> Column:
    """UTF-8 bytes of a text column, null as empty: Python tasks get them without decoding."""
    return F.coalesce(F.encode(F.col(col).cast("string"), "UTF-8"), F.lit(b""))


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to ``rows`` rows, which bounds the Python objects alive at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lower_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (``bytes`` methods know ASCII only)."""
    return text.lower().split()


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8"))
