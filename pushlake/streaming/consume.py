"""Structured Streaming versions of the message consumers.

Batching is by wall clock and arrival only (no event time, no watermark: the
reference has none). Every micro-batch is committed with ``foreachBatch`` to an
output folder that keeps a log of its commits:

- ``query_id=<q>/batch_id=<b>/``: the rows of one micro-batch. ``q`` is the id that
  Spark gives the streaming query and keeps in its checkpoint, so a restart writes
  on under the same id and a new checkpoint under another one: neither overwrites the
  other's batches.
- ``_commits/query_id=<q>/batch_id=<b>/``: one row, written after the rows. Readers go by
  it (``read_committed``), so a batch that was cut off is not seen, and one that is
  replayed replaces its own rows.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pushlake.operators import parse as P
from pushlake.session import checkpoint_root, delete_path, path_exists
from pushlake.sources.readers import topic_values
from pushlake.sources.sinks import ctrl_a_lines

Commit = Callable[[DataFrame, int], None]


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """A checkpoint location for a stream under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "streams", name)


#: Columns of the commit log.
COMMIT_SCHEMA = "rows long, format string, covers array<string>, query_id string, batch_id long"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a streaming query's checkpoint (written when it starts)."""
    return spark.read.schema("id string").json(os.path.join(checkpoint, "metadata")).first().id


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The commit log of an output folder: one row per committed batch. ``covers`` names
    the batches that a compaction replaced."""
    return spark.read.schema(COMMIT_SCHEMA).json(os.path.join(path, "_commits"))


def _committed(spark: SparkSession, path: str) -> list:
    """Log rows that count: committed and not covered by a compaction (one small row
    per batch, as the log holds)."""
    if not path_exists(spark, os.path.join(path, "_commits")):
        return []
    log = commits(spark, path).collect()
    covered = {c for r in log for c in r.covers or ()}
    return [r for r in log if _batch_name(r.query_id, r.batch_id) not in covered]


def _batch_name(query: str, batch: int) -> str:
    return f"query_id={query}/batch_id={batch}"


def _commit(spark: SparkSession, path: str, query: str, batch: int, fmt: str, rows: int, covers=None) -> None:
    log = spark.createDataFrame([(rows, fmt, covers)], "rows long, format string, covers array<string>")
    log.coalesce(1).write.mode("overwrite").json(os.path.join(path, "_commits", _batch_name(query, batch)))


def committed_writer(path: str, checkpoint: str, fmt: str = "parquet", on_new_query: str = "append") -> Commit:
    """Commit function of the query of ``checkpoint``: writes the batch's rows under the
    query's id and the batch's number (a replay replaces them), then its log row.

    Where the log already holds another query's batches, ``on_new_query="append"`` adds
    to them and ``"refuse"`` raises before anything is written."""
    if on_new_query not in ("append", "refuse"):
        raise ValueError(f"on_new_query is append or refuse, not {on_new_query}")

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        if on_new_query == "refuse":
            others = {r.query_id for r in _committed(spark, path)} - {query, COMPACTED}
            if others:
                raise RuntimeError(f"{path} holds batches of another query: {sorted(others)[0]}")
        seen = Observation()
        rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").format(fmt).save(os.path.join(path, _batch_name(query, batch_id)))
        _commit(spark, path, query, batch_id, fmt, seen.get["rows"])

    return commit


def read_committed(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """All committed rows of an output folder, with their ``query_id`` and ``batch_id``.
    ``schema`` is that of the rows; it is needed when no batch had any."""
    log = _committed(spark, path)
    whole = [os.path.join(path, _batch_name(r.query_id, r.batch_id)) for r in log if r.rows]
    if not whole:
        if schema is None:
            raise ValueError(f"{path} has no committed rows and no schema was given")
        empty = spark.createDataFrame([], StructType.fromDDL(schema) if isinstance(schema, str) else schema)
        return empty.withColumn("query_id", F.lit(None).cast("string")).withColumn("batch_id", F.lit(None).cast("long"))
    reader = spark.read.format(log[0].format).option("basePath", path)
    if schema is not None:
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        reader = reader.schema(StructType([*kind.fields]).add("query_id", "string").add("batch_id", "long"))
    return reader.load(whole).withColumn("batch_id", F.col("batch_id").cast("long"))


#: Query id of batches that a compaction wrote.
COMPACTED = "compacted"


def compact(spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
    """Rewrite all committed batches as one, through ``combine``; returns the number
    replaced. The new batch's log row names those it covers, so readers change over at
    once; their folders are deleted afterwards. A batch that is replayed later stays
    covered. One compaction of a folder runs at a time."""
    old = _committed(spark, path)
    if len(old) < 2:
        return 0
    names = [_batch_name(r.query_id, r.batch_id) for r in old]
    number = 1 + max((r.batch_id for r in commits(spark, path).filter(F.col("query_id") == COMPACTED).collect()), default=-1)
    filled = [os.path.join(path, n) for n, r in zip(names, old) if r.rows]
    count = 0
    if filled:
        seen = Observation()
        rows = combine(spark.read.format(old[0].format).load(filled)).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").format(old[0].format).save(os.path.join(path, _batch_name(COMPACTED, number)))
        count = seen.get["rows"]
    _commit(spark, path, COMPACTED, number, old[0].format, count, names)
    for n in names:
        delete_path(spark, os.path.join(path, n))
    return len(names)


def consume(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    commit: Commit,
    seconds: float,
    checkpoint: str,
    query_name: str | None = None,
) -> StreamingQuery:
    """R1 + R3: each message -> 0..n records (``transform``), committed every
    ``seconds`` of wall clock (the trigger flushes by clock even when idle, D14); the
    checkpoint holds the offsets for a restart."""
    w = (
        transform(stream)
        .writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
    )
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def drain(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    commit: Commit,
    checkpoint: str,
) -> StreamingQuery:
    """R2: process everything available now in bounded micro-batches (cap them with
    the source's ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``), then stop. The
    same ``transform`` runs as in ``consume`` (D16)."""
    return (
        transform(stream)
        .writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def push_records(messages: DataFrame) -> DataFrame:
    """R4 transform: message payloads -> envelope rows (P2) -> projected push events
    (P3, F1-F3), accepted only. Works on batch and streaming DataFrames alike."""
    body = topic_values(messages)
    return P.accepted(P.project_push(P.explode_rows(body, "body", "obj"))).drop("obj")


def push_stream(messages: DataFrame) -> DataFrame:
    """Continuous JSON -> ``\\u0001`` rows (K3 layout), as column ``value``."""
    return ctrl_a_lines(push_records(messages), P.PUSH_COLUMNS)


#: Rows of the hour job's increments: how much a batch adds to a count of an hour or day.
INCREMENT_SCHEMA = "iday int, ihour int, grain string, metric string, added long"


def hour_increments(lines: DataFrame, count: str, distinct: dict[str, str], tz: str = "Asia/Shanghai") -> DataFrame:
    """R5 transform of a stream (or table) of lines (column ``line``): one row per accepted
    record for the count, and one for each value of a ``distinct`` entry (name -> column)
    the first time it is seen in its hour and in its day.

    First sightings are Spark's own keyed state (``dropDuplicates``), kept in the
    checkpoint: a batch looks up and adds the values of its own records, whatever the
    hours and days already hold. State is spread by hour and value, so a hot hour is
    no hot partition. It is never dropped, as records may arrive at any time; for state
    beyond memory set Spark's RocksDB state store."""
    recs = P.accepted(P.parse_http_api(lines, tz=tz))
    counted = recs.select("iday", "ihour", F.lit(count).alias("metric"), F.lit(None).cast("string").alias("value"))
    seen = [F.struct(F.lit(name).alias("metric"), F.col(c).cast("string").alias("value")) for name, c in distinct.items()]
    values = recs.select("iday", "ihour", F.inline(F.array(*seen))).filter(F.col("value").isNotNull())
    # the day's sighting is a row of its own, with no hour
    grains = F.explode(F.array(F.col("ihour"), F.lit(None).cast("int")))
    values = values.select("iday", grains.alias("ihour"), "metric", "value").dropDuplicates(["iday", "ihour", "metric", "value"])
    return counted.unionByName(values)


def summed_increments(rows: DataFrame, count: str) -> DataFrame:
    """Rows of ``hour_increments`` as counts to add, by hour and day (INCREMENT_SCHEMA)."""
    both = rows.withColumn("grain", F.explode(F.when(F.col("metric") == count, F.array(F.lit("hour"), F.lit("day")))
                                              .otherwise(F.array(F.when(F.col("ihour").isNull(), "day").otherwise("hour")))))
    hour = F.when(F.col("grain") == "hour", F.col("ihour"))
    return both.groupBy("iday", hour.alias("ihour"), "grain", "metric").agg(F.count(F.lit(1)).alias("added"))


def add_increments(rows: DataFrame) -> DataFrame:
    """Increments of several batches added up (also the ``combine`` of a compaction)."""
    return rows.groupBy("iday", "ihour", "grain", "metric").agg(F.sum("added").alias("added"))


def drain_hours(lines: DataFrame, path: str, checkpoint: str, count: str, distinct: dict[str, str], tz: str = "Asia/Shanghai") -> StreamingQuery:
    """The hourly stats job on a stream of lines: each micro-batch commits what it adds
    to the counts of its hours and days. Hours may spread over files and batches; read
    the whole counts with ``hour_counts``."""
    write = committed_writer(path, checkpoint)
    return drain(lines, lambda s: hour_increments(s, count, distinct, tz), lambda b, i: write(summed_increments(b, count), i), checkpoint)


def hour_counts(spark: SparkSession, path: str, count: str, distinct: dict[str, str]) -> DataFrame:
    """(iday, ihour, grain, counts...) from the committed increments."""
    names = [count, *distinct]
    rows = read_committed(spark, path, INCREMENT_SCHEMA)
    sums = [F.coalesce(F.sum(F.when(F.col("metric") == n, F.col("added"))), F.lit(0)).cast("long").alias(n) for n in names]
    return rows.groupBy("iday", "ihour", "grain").agg(*sums)
