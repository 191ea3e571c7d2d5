"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pushlake.session import scratch_path

#: Fixed word pattern of the text contracts: runs of anything but these separators.
WORD_SEPARATORS = "[\\x20\\x09-\\x0D]+"

#: Largest object an operator may broadcast (vocabularies, query blocks, fitted models).
MAX_BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once per row (it becomes a
    lambda variable, which Catalyst does not substitute into its uses)."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back:
    lineage ends there, and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` and aggregates of the rows, taken while they are written."""
    seen = Observation()
    out = materialize(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), name)
    return out, seen.get


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            if "/scratch/" in folder:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def broadcast_bytes(spark: SparkSession, data: bytes):
    """A Spark broadcast of ``data``, refused beyond the size bound."""
    if len(data) > MAX_BROADCAST_BYTES:
        raise ValueError(f"{len(data)} bytes exceed the broadcast bound of {MAX_BROADCAST_BYTES}")
    return spark.sparkContext.broadcast(data)


def unique_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str | None:
    """The mounted path of a ``file:`` URI or plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if os.path.isabs(uri) else None


#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 512
_CACHES: dict[str, object] = {}


def slices(batches, rows: int = SLICE_ROWS):
    """Small slices of Arrow batches, so that no task holds a batch as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def only_cache(name: str, cache):
    """Register a worker's cache and empty those of other operators: a Python worker
    that serves several operators in turn holds one cache at a time."""
    for other, held in _CACHES.items():
        if other != name:
            held.clear()
    _CACHES[name] = cache
    return cache
