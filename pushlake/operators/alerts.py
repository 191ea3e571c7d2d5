"""Job-log alerting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushlake.functions import text as X
from pushlake.operators.rollup import first_n_per_group

# Fixed values of the alert rule.
OVERTIME_MINUTES = 60
MAX_MESSAGE = 300
ERROR_PREFIX = "Error-Cube:"


def overtime_minutes(duration_s) -> "F.Column":
    """Whole minutes of a duration in seconds (integer division)."""
    return F.floor(F.col(duration_s) / 60).cast("bigint") if isinstance(duration_s, str) else F.floor(duration_s / 60).cast("bigint")


def _items(jobs: DataFrame) -> DataFrame:
    mins = overtime_minutes("duration")
    return jobs.select(
        "cube",
        "name",
        F.when(F.col("job_status") == "ERROR", F.lit("error"))
        .when((F.col("job_status") == "RUNNING") & (mins > OVERTIME_MINUTES), F.lit("overtime"))
        .alias("kind"),
        F.when(F.col("job_status") == "ERROR", F.col("name"))
        .otherwise(F.concat(X.name_tokens_0_2("name"), F.lit(" cost "), mins.cast("string"), F.lit(" min")))
        .alias("item"),
    ).filter(F.col("kind").isNotNull())


def alert_items(jobs: DataFrame, jobs_per_cube: int | None = None) -> DataFrame:
    """every job that is RUNNING over 60 whole minutes -> ``<tok0>_<tok2> cost N
    min``, or ERROR -> the job name; one scan, no shuffle. Jobs without such a text
    (a name of under three tokens) are in ``alert_rejects``. ``jobs_per_cube`` asks
    for a page of each cube's jobs by name instead (W7)."""
    paged = jobs if jobs_per_cube is None else first_n_per_group(jobs, ["cube"], "name", jobs_per_cube)
    return _items(paged).filter(F.col("item").isNotNull())


def alert_rejects(jobs: DataFrame) -> DataFrame:
    """Jobs that call for an alert but have no item text, with the reason."""
    return _items(jobs).filter(F.col("item").isNull()).select("cube", "name", "kind", F.lit("name").alias("reject_reason"))


def _py_text(s: "F.Column") -> "F.Column":
    """A string as Python prints it: in single quotes, or in double quotes when it has
    single ones only; backslashes, the quote and line breaks and tabs are escaped."""
    out = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    for char, text in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(char), F.lit(text))
    single = F.concat(F.lit("'"), F.replace(out, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"')), F.concat(F.lit('"'), out, F.lit('"'))).otherwise(single)


def _py_list(items) -> "F.Column":
    """Text of a list of strings as Python prints it: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, _py_text), ", "), F.lit("]"))


def job_alerts(jobs: DataFrame, jobs_per_cube: int | None = None, max_len: int = MAX_MESSAGE) -> DataFrame:
    """O1: one alert message (at most ``max_len`` chars), or no row when there is
    nothing to report. Items are sorted by (cube, name) so the text is
    deterministic. Every item is a text and adds at least 4 characters, so only the
    first ``max_len // 4 + 2`` items of each kind can reach the message: each kind is
    cut to that many per task and then overall (a window group limit, one scan)."""
    w = Window.partitionBy("kind").orderBy("cube", "name", "item")
    both = alert_items(jobs, jobs_per_cube).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_len // 4 + 2)
    agg = both.agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "error", F.struct("cube", "name", "item")))).alias("err"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "overtime", F.struct("cube", "name", "item")))).alias("over"),
    )
    err = F.transform("err", lambda s: s["item"])
    over = F.transform("over", lambda s: s["item"])
    msg = F.concat(
        F.when(F.size(err) > 0, F.concat(F.lit(ERROR_PREFIX), _py_list(err), F.lit("  "))).otherwise(F.lit("")),
        F.when(F.size(over) > 0, F.concat(F.lit(" "), _py_list(over))).otherwise(F.lit("")),
    )
    out = agg.select(X.truncate(msg, max_len).alias("message"))
    return out.filter(F.length("message") > 0)
