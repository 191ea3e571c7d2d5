"""End-to-end jobs: the reference's batch and stream programs as compositions of

Each job is a function of a SparkSession and paths; ``main`` exposes them to
``spark-submit pushlake/jobs.py <job> ...``. Jobs write through Spark's writers
(commit protocol, overwrite or dynamic partition overwrite), so a rerun after a
failure replaces its output instead of adding to it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
from typing import Callable

if __package__ in (None, ""):  # run as a script: spark-submit pushlake/jobs.py <job> ...
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pushlake.functions.timekeys import DEFAULT_TZ, day_to_ms
from pushlake.operators import alerts, cells, merge, ordered, parse, rollup
from pushlake.sources import readers, sinks
from pushlake.streaming import consume

# Cell family and qualifier of the app-list job's output.
APPLIST_FAMILY = "C"
APPLIST_QUALIFIER = "app"
#: About the most apps of one cell of that job.
APPLIST_MAX_ITEMS = 100_000


def http_api_to_orc(spark: SparkSession, inputs: str, output: str, tz: str = DEFAULT_TZ, rejects: str | None = None) -> dict:
    """Text HTTP-API log lines -> typed ORC records (P1 + K1); bad lines are counted
    and, with ``rejects``, written as (line, reason) text. Returns the counters."""
    obs = Observation("http_api")
    parsed = rollup.observe_counts(parse.parse_http_api(readers.read_lines(spark, inputs), tz=tz), obs)
    write = lambda rows: sinks.to_orc(rows.select(*parse.HTTP_API_COLUMNS), output)
    if rejects:
        text = F.concat_ws("\t", parse.REJECT, "line").alias("value")
        sinks.write_split(parsed, write, lambda rows: rows.select(text).write.mode("overwrite").text(rejects))
    else:
        write(parse.accepted(parsed))
    return obs.get


def lines_to_parquet(spark: SparkSession, inputs: str, output: str, parser: Callable[[DataFrame], DataFrame],
                     codec: str = sinks.PARQUET_DEFAULT_CODEC) -> None:
    """Text lines -> a user parser (``df -> df`` on column ``line``) -> typed Parquet
    (K2: required columns, byte/short widened, GZIP by default)."""
    sinks.to_parquet_typed(parser(readers.read_lines(spark, inputs)), output, codec)


def applist_orc_to_cells(spark: SparkSession, inputs: str, output: str, job_ts: int, max_items: int = APPLIST_MAX_ITEMS) -> None:
    """App-list ORC -> cells C:app per imei with the JSON list (S3 + A1 + A2 + K6).
    The cell time is the group's 10-digit itime in ms, else the job's time. A list of
    more than ``max_items`` apps is written as one cell per part, C:app.<part>."""
    lists = rollup.applist_by_imei(readers.read_applist_orc(spark, inputs), max_items=max_items)
    ts = F.coalesce(F.col("itime_ms"), F.lit(job_ts).cast("bigint"))
    qualifier = F.when(F.col("parts") == 1, F.lit(APPLIST_QUALIFIER)).otherwise(F.concat_ws(".", F.lit(APPLIST_QUALIFIER), F.col("part")))
    out = cells.to_cells(lists, F.col("imei"), APPLIST_FAMILY, qualifier, F.col("applist"), ts)
    out.write.mode("overwrite").parquet(output)


def profile_to_sorted_cells(spark: SparkSession, inputs: str, output: str, kind: str, day: str, n_files: int,
                            tz: str = DEFAULT_TZ) -> None:
    """Profile lines of one kind -> cells stamped with the day's local midnight ->
    range-partitioned, sorted bulk-load files (P4-P6 + T4 + K8)."""
    lines = readers.read_lines(spark, inputs)
    out = parse.accepted(parse.profile_cells(lines, kind, day_to_ms(F.lit(day), tz))).select(*cells.CELL_COLUMNS)
    sinks.to_sorted_cells(out, n_files, output)


def pairs_to_index(spark: SparkSession, inputs: str, send: Callable[[list[dict]], sinks.Failures | None], itime: int,
                   batch: int = sinks.INDEX_BULK, failures: str | None = None, pieces: bool = False) -> int:
    """``imei pkg`` lines in file order -> runs of equal imei (rejects do not break a
    run) -> the last run of each imei -> bulk index documents (P9 + W1 + W2 + K7). Returns
    the number of failed documents; their ids and reasons go to ``failures``.

    With ``pieces`` a run is one document for each segment of lines it touches (``imei``,
    then ``imei.1``, ...), so that no document holds a whole run of any length."""
    lines = readers.read_lines(spark, inputs)
    pairs = parse.accepted(parse.parse_pairs(lines, keep=["_file", "_block", "_pos"]))
    pairs, segment = ordered.line_segments(pairs)
    runs = ordered.group_runs(pairs, "imei", "pkg", ["_file", "_block", "_pos"], segment=segment, pieces=pieces)
    if pieces:
        parts = ordered.last_run_pieces(runs, "imei", "pkg")
        name = F.when(F.col("part") == 0, F.col("imei")).otherwise(F.concat_ws(".", "imei", F.col("part").cast("string")))
        last = parts.select(name.alias("imei"), "pkg")
    else:
        last = ordered.last_run(runs, "imei", "pkg")
    return sinks.to_index_docs(last, "imei", "pkg", itime, send, batch, failures)


def merge_versions(spark: SparkSession, docs: DataFrame, inputs: str, flag: str) -> DataFrame:
    """Version lines (``apkver`` or ``sdkver`` flag) merged into documents in line
    order (P7/P8 + W3 + U1); the caller writes the result (overwrite)."""
    lines = readers.read_lines(spark, inputs)
    ups = parse.accepted(parse.parse_versions(lines, flag, keep=["_file", "_block", "_pos"]))
    fields = ["appkey", "apkver"] if flag == "apkver" else ["channel", "sdkver"]
    return merge.merge_docs(docs, ups, "uid", fields, ["_file", "_block", "_pos"])


def send_time_values(spark: SparkSession, keys: str, report: DataFrame, offline: DataFrame, appkey: str, column: str) -> DataFrame:
    """Key file -> (msgid, send time s, summed offline value) per line (S9 + J4)."""
    return cells.send_time_value(readers.read_keys(spark, keys), "key", report, offline, appkey, column)


def user_dims(spark: SparkSession, uids: str, user_cells: DataFrame) -> DataFrame:
    """Uid file -> (uid, appkey, apkver, sdkver, channel) from reversed-key rows (S9 + J1)."""
    return cells.lookup_reversed(readers.read_keys(spark, uids, trim=True), "key", user_cells)


def cube_job_alert(jobs: DataFrame) -> str | None:
    """The alert text for a job list, or None when there is nothing to report (O1).
    The result is one short row, so it is fetched to the driver to be sent."""
    row = alerts.job_alerts(jobs).first()
    return row.message if row else None


def hourly_stats(spark: SparkSession, base: str, start: dt.datetime, end: dt.datetime, output: str,
                 template: str = readers.HOUR_TEMPLATE, tz: str = DEFAULT_TZ, absent: str = "raise") -> None:
    """Hour directories of [start, end) (all of them, unless ``absent="skip"``) -> HTTP-API records -> hour and day stats in
    one pass -> ``month=/day=`` partitions, replaced on rerun (S4 + P1 + A11 + K9)."""
    recs = parse.accepted(parse.parse_http_api(readers.read_hours(spark, base, start, end, template=template, absent=absent), tz=tz))
    stats = rollup.hour_day_counts(recs, "iday", "ihour", "n_msgs", {"n_appkeys": "appkey", "n_msgids": "msgid"})
    stats = stats.withColumn("month", (F.col("iday") / 100).cast("bigint").cast("string")).withColumn(
        "day", F.lpad((F.col("iday") % 100).cast("string"), 2, "0")
    )
    sinks.to_day_partitions(stats, output)


def push_events_stream(messages: DataFrame, output: str, checkpoint: str, seconds: float):
    """Message stream -> \\u0001 rows committed every ``seconds`` under the query's id and
    batch id (R1 + R4); read them with ``consume.read_committed``."""
    return consume.consume(messages, consume.push_stream, consume.committed_writer(output, checkpoint, "text"), seconds, checkpoint)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="pushlake.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("http-api-to-orc")
    a.add_argument("inputs")
    a.add_argument("output")
    a.add_argument("--rejects")
    a.add_argument("--tz", default=DEFAULT_TZ)
    b = sub.add_parser("applist-to-cells")
    b.add_argument("inputs")
    b.add_argument("output")
    b.add_argument("--job-ts", type=int, required=True)
    c = sub.add_parser("profile-to-cells")
    c.add_argument("inputs")
    c.add_argument("output")
    c.add_argument("--kind", required=True, choices=sorted(parse.PROFILE_KINDS))
    c.add_argument("--day", required=True)
    c.add_argument("--files", type=int, default=200)
    d = sub.add_parser("hourly-stats")
    d.add_argument("base")
    d.add_argument("output")
    d.add_argument("--start", required=True, help="yyyyMMddHH")
    d.add_argument("--end", required=True, help="yyyyMMddHH (exclusive)")
    m = sub.add_parser("merge-versions", help="merge version lines into a Parquet document table")
    m.add_argument("docs")
    m.add_argument("inputs")
    m.add_argument("output")
    m.add_argument("--flag", required=True, choices=["apkver", "sdkver"])
    s = sub.add_parser("send-time-values", help="key file -> (msgid, ts, value) as Parquet")
    s.add_argument("keys")
    s.add_argument("report_cells")
    s.add_argument("offline_cells")
    s.add_argument("output")
    s.add_argument("--appkey", required=True)
    s.add_argument("--column", required=True)
    u = sub.add_parser("user-dims", help="uid file -> user dimensions as Parquet")
    u.add_argument("uids")
    u.add_argument("user_cells")
    u.add_argument("output")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"pushlake-{args.job}").getOrCreate()
    if args.job == "http-api-to-orc":
        print(http_api_to_orc(spark, args.inputs, args.output, args.tz, args.rejects))
    elif args.job == "applist-to-cells":
        applist_orc_to_cells(spark, args.inputs, args.output, args.job_ts)
    elif args.job == "profile-to-cells":
        profile_to_sorted_cells(spark, args.inputs, args.output, args.kind, args.day, args.files)
    elif args.job == "hourly-stats":
        fmt = "%Y%m%d%H"
        hourly_stats(spark, args.base, dt.datetime.strptime(args.start, fmt), dt.datetime.strptime(args.end, fmt), args.output)
    elif args.job == "merge-versions":
        merge_versions(spark, spark.read.parquet(args.docs), args.inputs, args.flag).write.mode("overwrite").parquet(args.output)
    elif args.job == "send-time-values":
        out = send_time_values(spark, args.keys, spark.read.parquet(args.report_cells), spark.read.parquet(args.offline_cells),
                               args.appkey, args.column)
        out.write.mode("overwrite").parquet(args.output)
    elif args.job == "user-dims":
        user_dims(spark, args.uids, spark.read.parquet(args.user_cells)).write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
