"""Sinks (K1-K9). Writers are plain DataFrame writers; the projections they need
are separate functions so they can be checked and reused on streams."""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushlake.functions import text as X
from pushlake.session import delete_path, scratch_path

# Fixed values of the typed Parquet writer (K2).
PARQUET_DEFAULT_CODEC = "gzip"
_WIDEN_TO_INT = (T.ByteType, T.ShortType)
_PARQUET_OK = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.StringType)
# Fixed value: documents per bulk request of the index sink (K7).
INDEX_BULK = 3000
# Fixed value: field separator of the warehouse text rows.
CTRL_A = "\u0001"


# ORC files without dictionaries: for large text columns, less CPU time of the writer.
ORC_PLAIN = {"orc.dictionary.key.threshold": "0"}


def to_orc(df: DataFrame, path: str, mode: str = "overwrite", options: dict[str, str] | None = None) -> None:
    """K1: parsed records to ORC."""
    df.write.mode(mode).options(**(options or {})).orc(path)


def typed_for_parquet(df: DataFrame) -> DataFrame:
    """K2 projection: byte and short widened to int; any other type than int, long,
    float, double, boolean, string raises; a null in any column fails the job when
    the rows are written (the reference's columns are all required, D19)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, _WIDEN_TO_INT):
            c = c.cast("int")
        elif not isinstance(f.dataType, _PARQUET_OK):
            raise TypeError(f"unsupported type for the typed Parquet writer: {f.name} {f.dataType.simpleString()}")
        c = F.when(c.isNull(), F.raise_error(F.lit(f"null value in required column {f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_parquet_typed(df: DataFrame, path: str, codec: str = PARQUET_DEFAULT_CODEC, mode: str = "overwrite") -> None:
    """K2: typed Parquet, GZIP unless another codec is given."""
    typed_for_parquet(df).write.mode(mode).option("compression", codec).parquet(path)


def ctrl_a_lines(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K3 projection: one ``\\u0001``-joined text row per record; null prints ``null``."""
    return df.select(F.concat_ws(CTRL_A, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]).alias("value"))


def to_ctrl_a_text(df: DataFrame, cols: Sequence[str], path: str, mode: str = "append") -> None:
    """K3: ``\\u0001``-delimited text files, one record per line."""
    ctrl_a_lines(df, cols).write.mode(mode).text(path)


def topic_records(df: DataFrame, line_col: str = "line") -> DataFrame:
    """K4 projection: trimmed lines as message values, no key; blank lines are sent."""
    return df.select(X.java_trim(F.col(line_col)).alias("value"))


def to_topic(df: DataFrame, servers: str, topic: str, line_col: str = "line") -> None:
    """K4: lines to a topic, waiting for all replicas (needs the Kafka connector)."""
    from pushlake.sources.readers import require_kafka

    require_kafka(df.sparkSession)
    (
        topic_records(df, line_col)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def to_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 1000, mode: str = "append", properties: dict | None = None) -> None:
    """K5: relational sink with batched statements. Replace-into: build the
    table with ``merge.replace_into`` and write it to a staging table that is then
    swapped in. Overwriting the table itself would truncate what the plan still has
    to read; appends are not safe to rerun."""
    df.write.option("batchsize", batchsize).jdbc(url, table, mode=mode, properties=properties or {})


def index_docs(runs: DataFrame, id_col: str, pkg_col: str, itime: int | Column) -> DataFrame:
    """K7 projection: (id, pkg, itime) documents; one per id (the caller passes W2 output)."""
    it = F.lit(itime) if isinstance(itime, int) else itime
    return runs.select(F.col(id_col).cast("string").alias("id"), F.col(pkg_col).alias("pkg"), it.cast("bigint").alias("itime"))


Failures = Iterable["str | tuple[str, str]"]


def send_in_batches(df: DataFrame, send: Callable[[list[dict]], Failures | None], batch: int = INDEX_BULK, attempts: int = 1) -> DataFrame:
    """K7: ``send(docs)`` with at most ``batch`` documents at a time, on the executors; the
    failures as rows (id, reason). ``send`` returns the failed ids, or (id, reason) pairs.
    A request that raises is tried ``attempts`` times; then all its documents fail with the
    error's text.

    The documents are sent when the result is written or counted, so write it once
    (``write_in_batches``). A lost executor re-runs its partition, so a batch may be sent
    twice: ``send`` must write by document id (an upsert), as an index keyed by id does."""

    def request(docs: list[dict]) -> list[tuple[str, str]]:
        for attempt in range(1, attempts + 1):
            try:
                return [x if isinstance(x, tuple) else (x, "failed") for x in send(docs) or ()]
            except Exception as e:  # noqa: BLE001 - any error of the index is a reason
                if attempt == attempts:
                    return [(d["id"], f"{type(e).__name__}: {e}") for d in docs]
        return []

    def run(batches):
        import pyarrow as pa

        held: list[dict] = []
        for part in batches:
            held += part.to_pylist()
            while len(held) >= batch:
                yield pa.RecordBatch.from_pylist(failed(held[:batch]), schema)
                held = held[batch:]
        if held:
            yield pa.RecordBatch.from_pylist(failed(held), schema)

    def failed(docs: list[dict]) -> list[dict]:
        return [{"id": str(i), "reason": reason} for i, reason in request(docs)]

    import pyarrow as pa

    schema = pa.schema([("id", pa.string()), ("reason", pa.string())])
    return df.mapInArrow(run, "id string, reason string")


def write_in_batches(df: DataFrame, send: Callable[[list[dict]], Failures | None], failures: str | None = None,
                     batch: int = INDEX_BULK, attempts: int = 1) -> int:
    """K7: send all documents in bulk requests and return the number that failed. Their ids
    and reasons are written as a Parquet table at ``failures``, through Spark's commit
    protocol: a re-run partition gives its rows once."""
    out = send_in_batches(df, send, batch, attempts)
    if failures is None:
        return out.count()
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(failures)
    return seen.get["n"]


def to_index_docs(
    runs: DataFrame,
    id_col: str,
    pkg_col: str,
    itime: int | Column,
    send: Callable[[list[dict]], Failures | None],
    batch: int = INDEX_BULK,
    failures: str | None = None,
) -> int:
    """K7: index documents (id, pkg, itime), one per id, sent in bulk requests of at
    most ``batch`` documents by ``send`` on the executors; failed ids as a table."""
    return write_in_batches(index_docs(runs, id_col, pkg_col, itime), send, failures, batch)


def write_split(parsed: DataFrame, write_accepted: Callable[[DataFrame], None], write_rejected: Callable[[DataFrame], None]) -> None:
    """Write the accepted rows (without their reason column) and the rejected ones
    (with it) of one evaluation of ``parsed``: the parsed rows are written under the
    shared checkpoint folder and read back by the two writes, so the input is read and
    parsed once, also when an executor is lost in between."""
    from pushlake.operators.parse import REJECT, accepted

    spark = parsed.sparkSession
    path = scratch_path(spark, "split")
    try:
        parsed.write.options(**ORC_PLAIN).orc(path)
        kept = spark.read.schema(parsed.schema).orc(path)
        write_accepted(accepted(kept))
        write_rejected(kept.filter(F.col(REJECT).isNotNull()))
    finally:
        delete_path(spark, path)


def sorted_cells(df: DataFrame, n: int) -> DataFrame:
    """K8: cells in bulk-load order: range-partitioned into ``n`` parts and sorted
    inside each by (rowkey, family, qualifier, newest first). The range bounds use
    the whole sort key, so a row key with a huge number of cells is split across
    parts instead of filling one; part i still holds only keys before part i+1."""
    order = ["rowkey", "family", "qualifier", F.col("ts").desc()]
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def to_sorted_cells(df: DataFrame, n: int, path: str, mode: str = "overwrite") -> None:
    """K8: write the sorted cell files (Parquet)."""
    sorted_cells(df, n).write.mode(mode).parquet(path)


def to_day_partitions(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """``month=yyyyMM/day=dd`` partitions; a rerun replaces only the days it
    writes (dynamic partition overwrite, set per write)."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month", "day")
        .format(fmt)
        .save(path)
    )
