"""Sources (S1-S9).

Every reader returns a DataFrame and leaves partitioning to the file source
(``spark.sql.files.maxPartitionBytes``), so reads scale with the cluster.
"""

from __future__ import annotations

import datetime as dt
import os
from typing import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.functions import text as X
from pushlake.functions._cols import pin
from pushlake.operators.parse import REJECT, accepted

# Fixed value: declared schema of the app-list ORC files (S3).
APPLIST_SCHEMA = "imei string, pkg string, name string, itime bigint"
# Fixed value: layout of hour-templated input directories.
HOUR_TEMPLATE = "{yyyy}/{MM}/{dd}/{yyyyMMddHH}"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per text line: ``line`` plus its order key (``_file``, ``_block``,
    ``_pos``). ``_pos`` comes from ``monotonically_increasing_id`` and grows with
    the line inside one file split; (file, block) is the natural segment for
    order-dependent operators (``ordered.group_runs``)."""
    df = spark.read.text(_path_list(paths))
    return df.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def _path_list(paths: str | Sequence[str]) -> list[str]:
    if isinstance(paths, str):
        return [p for p in (s.strip() for s in paths.split(",")) if p]
    return list(paths)


def read_many(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Several comma-separated input paths read as one DataFrame."""
    r = spark.read.format(fmt)
    if schema:
        r = r.schema(schema)
    return r.load(_path_list(paths))


def checked_applist_orc(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S3 + P11: app-list rows of ORC with the declared struct, with the reason for which
    the mapper skipped a row: the first field that is null."""
    rows = spark.read.schema(APPLIST_SCHEMA).orc(_path_list(paths))
    return rows.withColumn(REJECT, F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in rows.columns]))


def read_applist_orc(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S3: ORC with the declared app-list struct; rows with a null field are dropped
    (the mapper skipped them; ``checked_applist_orc`` gives them)."""
    return accepted(checked_applist_orc(spark, paths))


def hourly_paths(base: str, start: dt.datetime, end: dt.datetime, template: str = HOUR_TEMPLATE) -> list[str]:
    """One directory per hour in [start, end), by the path template."""
    out = []
    t = start.replace(minute=0, second=0, microsecond=0)
    while t < end:
        out.append(os.path.join(base, template.format(
            yyyy=f"{t:%Y}", MM=f"{t:%m}", dd=f"{t:%d}", HH=f"{t:%H}", yyyyMMddHH=f"{t:%Y%m%d%H}", yyyyMMdd=f"{t:%Y%m%d}")))
        t += dt.timedelta(hours=1)
    return out


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that exist (an existing hour directory counts as ready). Each
    parent directory is listed once (one call per day for hourly inputs)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = list(paths)
    children: dict[str, set[str]] = {}
    for parent in dict.fromkeys(os.path.dirname(p.rstrip("/")) for p in paths):
        hp = jvm.org.apache.hadoop.fs.Path(parent)
        fs = hp.getFileSystem(conf)
        children[parent] = {s.getPath().getName() for s in fs.listStatus(hp)} if fs.exists(hp) else set()
    return [p for p in paths if os.path.basename(p.rstrip("/")) in children[os.path.dirname(p.rstrip("/"))]]


def read_hours(spark: SparkSession, base: str, start: dt.datetime, end: dt.datetime, fmt: str = "text",
               template: str = HOUR_TEMPLATE, schema: str | None = None, absent: str = "raise") -> DataFrame:
    """Read the hour directories of [start, end). The instance is complete only when
    every hour is there, so an absent hour raises and is named; ``absent="skip"`` reads
    the hours that exist."""
    wanted = hourly_paths(base, start, end, template)
    paths = existing_paths(spark, wanted)
    missing = sorted(set(wanted) - set(paths))
    if missing and absent != "skip":
        raise FileNotFoundError(f"{len(missing)} of {len(wanted)} hour directories are absent: {', '.join(missing[:24])}")
    if not paths:
        raise FileNotFoundError(f"no hour directory under {base} in [{start}, {end})")
    if fmt == "text":
        return read_lines(spark, paths)
    return read_many(spark, paths, fmt, schema)


def scan_two_as_text(df: DataFrame) -> DataFrame:
    """The first two columns as text; null printed as ``null``."""
    cols = df.columns[:2]
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in cols])


def run_stats(
    spark: SparkSession,
    mk_sql: Callable[[], str | None],
    prepare: Callable[[], None] | None = None,
    query: Callable[[SparkSession, str], DataFrame] | None = None,
    save: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Job template: ``prepare`` -> ``mk_sql`` -> query -> ``save``. A null SQL
    text raises. Returns the result DataFrame (also when ``save`` is given)."""
    if prepare is not None:
        prepare()
    sql = mk_sql()
    if sql is None:
        raise ValueError("the SQL of the stats job is null")
    out = query(spark, sql) if query is not None else spark.sql(sql)
    if save is not None:
        save(out)
    return out


def topic_values(df: DataFrame) -> DataFrame:
    """Payloads of a message source as text (``body``); null payloads skipped.
    Accepts any DataFrame with a ``value`` column (Kafka rows, a file stream...)."""
    return df.select(F.col("value").cast("string").alias("body")).filter(F.col("body").isNotNull())


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka connector is on the session's classpath."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001 - py4j wraps ClassNotFoundException
        return False


def require_kafka(spark: SparkSession) -> None:
    if not kafka_available(spark):
        raise RuntimeError("the Kafka connector (spark-sql-kafka) is not on the classpath; "
                           "feed the same transforms from any DataFrame with a 'value' column")


# Fixed value: the reference drains a topic in batches of 500 messages (R2).
DRAIN_BATCH = 500


def read_topic(spark: SparkSession, servers: str, topic: str, group: str, starting: str = "latest",
               max_per_trigger: int | None = None) -> DataFrame:
    """A Structured Streaming source of one topic and consumer group, payload only.
    ``max_per_trigger`` caps the messages of one micro-batch (``DRAIN_BATCH`` for a
    drain, R2). Needs the Kafka connector on the classpath."""
    require_kafka(spark)
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", group)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_per_trigger)
    return topic_values(r.load())


def checked_cells_tsv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S8 + P11: five TAB fields per trimmed line: rowkey, itime (ms), val, family,
    qualifier -> cells beside their ``line``. A line without five fields (``fields``) or
    with a bad time (``ts``) is rejected on its own (the reference lost the whole batch)."""
    lines = spark.read.text(_path_list(paths)).select(F.col("value").alias("line"))
    parts = pin(lines, _a=X.java_split(X.java_trim(F.col("line")), "\t"))
    cells = parts.select(
        "line",
        F.get("_a", 0).alias("rowkey"),
        F.get("_a", 3).alias("family"),
        F.get("_a", 4).alias("qualifier"),
        F.get("_a", 1).try_cast("bigint").alias("ts"),
        F.get("_a", 2).alias("value"),
        F.size("_a").alias("_n"),
    )
    reason = F.when(F.col("_n") < 5, "fields").when(F.col("ts").isNull(), "ts")
    return cells.withColumn(REJECT, reason).drop("_n")


def read_cells_tsv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The cells of the accepted lines (``checked_cells_tsv`` gives all)."""
    return accepted(checked_cells_tsv(spark, paths)).drop("line")


def read_keys(spark: SparkSession, paths: str | Sequence[str], trim: bool = False) -> DataFrame:
    """One key per line, duplicates kept; Java-trimmed when ``trim``."""
    lines = spark.read.text(_path_list(paths))
    k = X.java_trim(F.col("value")) if trim else F.col("value")
    return lines.select(k.alias("key"))
