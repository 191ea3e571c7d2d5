"""Record parsers, projections and row filters.

Each parser maps a DataFrame of text (one record per row) to typed columns plus
``reject_reason``: null for an accepted row, otherwise the first rule the row
broke. ``accepted`` keeps the good rows, ``rejects`` the bad ones with their
line, so accepted + rejected = input (P11). Everything is a projection and a
filter: no shuffle, no Python.
"""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from pushlake.functions import text as X
from pushlake.functions._cols import ColumnOrName, as_col, pin
from pushlake.functions.timekeys import DEFAULT_TZ, epoch_ms_of_text, hour_key

REJECT = "reject_reason"

# The six push channels whose events are kept (F2).
TARGET_STEPS = ("seg-to-pushtask", "seg-to-apns", "seg-to-mpns", "seg-to-mipns", "seg-to-hpns", "seg-to-mzpns")
# Fixed value: message id 1 is a sentinel (F1).
SENTINEL_MSG_ID = 1
# Fixed value: the sdk version pattern, dots unescaped as in the reference (D3).
SDKVER_PATTERN = "^[0-9]+.[0-9]+.[0-9]+$"
# Profile kinds -> (JSON key, cell qualifier); all cells go to family C.
PROFILE_KINDS = {"app_tags": "apptag", "app_list": "applist", "device_info": "devinfo"}
PROFILE_FAMILY = "C"


def _first_reason(*checks: tuple[Column, str]) -> Column:
    """The reason of the first failing check (a check is a Column true when OK)."""
    out = None
    for ok, reason in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)).otherwise(out if out is not None else F.lit(None).cast("string"))
    return out


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows every rule accepted, without the reason column."""
    return parsed.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejects(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    """(line, reason) of every rejected row."""
    return parsed.filter(F.col(REJECT).isNotNull()).select(F.col(line_col).alias("line"), F.col(REJECT).alias("reason"))


HTTP_API_COLUMNS = ["appkey", "msgid", "itime", "msg_type", "receiver_type", "errno", "platform", "imon", "iday", "ihour"]


# ---- P1: HTTP-API log lines ---------------------------------------------------------------

def parse_http_api(lines: DataFrame, line_col: str = "line", tz: str = DEFAULT_TZ, keep: Iterable[str] = ()) -> DataFrame:
    """TAB line -> appkey, msgid, itime, msg_type, receiver_type, errno, platform,
    imon, iday, ihour. Extra fields are ignored; any failure rejects the row."""
    # The split array and the hour key are pinned: each is read by several fields
    # and by the reject rule, and must be computed once per line.
    split = pin(lines.select(*[F.col(c) for c in keep], F.col(line_col)), _arr=X.java_split(X.java_trim(F.col(line_col)), "\t"))
    arr = F.col("_arr")
    typed = split.select(
        *[F.col(c) for c in keep],
        F.col(line_col),
        X.java_trim(F.get(arr, 0)).alias("appkey"),
        F.get(arr, 1).try_cast("bigint").alias("msgid"),
        F.get(arr, 2).try_cast("bigint").alias("itime"),
        F.get(arr, 3).alias("msg_type"),
        F.get(arr, 4).alias("receiver_type"),
        F.get(arr, 5).alias("errno"),
        F.get(arr, 6).alias("platform"),
        F.size(arr).alias("_n"),
        F.get(arr, 2).alias("_itime_text"),
    )
    typed = pin(typed, _h=hour_key(epoch_ms_of_text(F.col("_itime_text")), tz))
    out = typed.select(
        *[F.col(c) for c in keep],
        F.col(line_col),
        *HTTP_API_COLUMNS[:7],
        F.substring("_h", 1, 6).try_cast("int").alias("imon"),
        F.substring("_h", 1, 8).try_cast("int").alias("iday"),
        F.col("_h").try_cast("int").alias("ihour"),
        "_n",
        "_h",
    )
    reason = _first_reason(
        (F.col("_n") >= 7, "fields"),
        (F.col("msgid").isNotNull(), "msgid"),
        (F.col("itime").isNotNull(), "itime"),
        (F.col("_h").try_cast("int").isNotNull(), "time_key"),
    )
    return out.withColumn(REJECT, reason).drop("_n", "_h")


# ---- P2 / P3 / F1-F3: push events -----------------------------------------------------------

def _bad_envelope(body_col: str) -> Column:
    rows = F.from_json(F.col(body_col), "rows array<string>")["rows"]
    return F.get_json_object(F.col(body_col), "$.rows").isNotNull() & rows.isNull()


def bad_envelopes(events: DataFrame, body_col: str = "body") -> DataFrame:
    """P11 for P2: messages whose ``rows`` is not an array, with the reason."""
    return events.filter(_bad_envelope(body_col)).withColumn(REJECT, F.lit("rows"))


def explode_rows(events: DataFrame, body_col: str = "body", out_col: str = "obj") -> DataFrame:
    """An envelope ``{"rows": [...]}`` gives one row per element; a body without
    ``rows`` (or with ``rows: null``) is the object itself; ``rows`` of any other JSON
    type fails the message (``bad_envelopes``). Elements stay JSON text, so
    a bad element is rejected later on its own and never loses its siblings (D1)."""
    rows = F.from_json(F.col(body_col), "rows array<string>")["rows"]
    return events.filter(~_bad_envelope(body_col)).select(
        *[c for c in events.columns if c != body_col],
        F.explode(F.coalesce(rows, F.array(F.col(body_col)))).alias(out_col),
    )


def is_not_sentinel(msg_id: ColumnOrName) -> Column:
    """message id 1 is a sentinel."""
    return as_col(msg_id) != F.lit(SENTINEL_MSG_ID)


def step_is_target(step: ColumnOrName) -> Column:
    """trimmed step is one of the six push channels."""
    return X.java_trim(as_col(step)).isin(*TARGET_STEPS)


def longs_present(*cols: ColumnOrName) -> Column:
    """every required long parsed."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & as_col(c).isNotNull()
    return ok


def project_push(objs: DataFrame, obj_col: str = "obj") -> DataFrame:
    """P3 + F1-F3: JSON event -> appkey, platform, msg_id, uid, itime.

    Missing appkey / platform become the text ``null``; a present but null appkey
    rejects the row, a null platform is the text ``null`` (D2). Numbers given as text
    are accepted. ``step`` and ``extra`` are dropped."""
    o = F.col(obj_col)
    # one JSON parse for the values (json_tuple) and one for key presence
    fields = objs.select(
        o.alias(obj_col),
        F.json_object_keys(o).alias("_keys"),
        F.json_tuple(o, "msg_id", "step", "appkey", "platform", "itime", "uid").alias(
            "_msg_id", "_step", "_appkey", "_platform", "_itime", "_uid"
        ),
    )
    keys = F.col("_keys")
    out = fields.select(
        obj_col,
        F.col("_msg_id").try_cast("bigint").alias("msg_id"),
        "_step",
        F.when(F.coalesce(F.array_contains(keys, "appkey"), F.lit(False)), X.java_trim(F.col("_appkey"))).otherwise(F.lit("null")).alias("appkey"),
        F.coalesce(F.col("_platform"), F.lit("null")).alias("platform"),
        F.col("_itime").try_cast("bigint").alias("itime"),
        F.col("_uid").try_cast("bigint").alias("uid"),
    )
    reason = _first_reason(
        (F.col("msg_id").isNotNull(), "msg_id"),
        (is_not_sentinel("msg_id"), "sentinel"),
        (F.col("_step").isNotNull(), "step"),
        (step_is_target("_step"), "step_not_target"),
        (F.col("appkey").isNotNull(), "appkey_null"),
        (longs_present("itime"), "itime"),
        (longs_present("uid"), "uid"),
    )
    return out.withColumn(REJECT, reason).select(obj_col, "appkey", "platform", "msg_id", "uid", "itime", REJECT)


PUSH_COLUMNS = ["appkey", "platform", "msg_id", "uid", "itime"]


# ---- P4-P6: user-profile lines -> cells ------------------------------------------------------

def profile_cells(lines: DataFrame, kind: str, ts: ColumnOrName, line_col: str = "line") -> DataFrame:
    """Profile line -> versioned cell (rowkey=imei, family C, qualifier, ts, value).

    ``app_tags``: ``imei TAB {"app_tags": ...}``, exactly two fields.
    ``app_list`` / ``device_info``: a JSON object with ``imei`` and the kind's key.
    A present key with a null value rejects the row (F5), so does a blank imei (F4).
    An unknown ``kind`` logs a warning and gives no rows, as the reference's job did."""
    if kind not in PROFILE_KINDS:
        import logging

        logging.getLogger("pushlake.parse").warning("unknown profile type: %s", kind)
        empty = lines.sparkSession.createDataFrame([], "rowkey string, family string, qualifier string, ts bigint, value string")
        return empty.withColumn(line_col, F.lit(None).cast("string")).withColumn(REJECT, F.lit(None).cast("string"))
    line = F.col(line_col)
    if kind == "app_tags":
        split = lines.select(F.col(line_col), X.java_split(line, "\t").alias("_arr"))
        docs = split.select(
            line_col,
            X.java_trim(F.get("_arr", 1)).alias("_doc"),
            X.java_trim(F.get("_arr", 0)).alias("_imei"),
            (F.size("_arr") == 2).alias("_shape"),
        )
        docs = docs.select(line_col, "_imei", "_shape", F.lit(True).alias("_imei_key"), F.json_object_keys("_doc").alias("_keys"),
                           F.json_tuple("_doc", kind).alias("_value"))
    else:
        docs = lines.select(
            F.col(line_col), F.json_object_keys(line).alias("_keys"),
            F.json_tuple(line, "imei", kind).alias("_imei_raw", "_value"),
        )
        docs = docs.select(
            line_col, "_keys", "_value", X.java_trim(F.col("_imei_raw")).alias("_imei"), F.lit(True).alias("_shape"),
            (F.coalesce(F.array_contains("_keys", "imei"), F.lit(False)) & F.col("_imei_raw").isNotNull()).alias("_imei_key"),
        )
    out = docs.select(
        F.col(line_col),
        F.col("_imei").alias("rowkey"),
        F.lit(PROFILE_FAMILY).alias("family"),
        F.lit(PROFILE_KINDS[kind]).alias("qualifier"),
        as_col(ts).cast("bigint").alias("ts"),
        X.java_trim(F.col("_value")).alias("value"),
        "_shape",
        "_imei_key",
        F.coalesce(F.array_contains("_keys", kind), F.lit(False)).alias("_has"),
    )
    reason = _first_reason(
        (F.col("_shape"), "fields"),
        (F.col("_imei_key"), "imei_key"),
        (F.length("rowkey") > 0, "imei_blank"),
        (F.col("_has"), "key_missing"),
        (F.col("value").isNotNull(), "value_null"),
    )
    return out.withColumn(REJECT, reason).drop("_shape", "_imei_key", "_has")


def imei_present(imei: ColumnOrName, trim: bool = True) -> Column:
    """imei non-empty (after a Java trim unless ``trim`` is False)."""
    c = X.java_trim(as_col(imei)) if trim else as_col(imei)
    return F.length(c) > 0


def json_keys_present(doc: ColumnOrName, *keys: str) -> Column:
    """every key is present in the JSON object."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & X.has_json_key(doc, k)
    return ok


# ---- P7 / P8: version lines -----------------------------------------------------------------

def parse_versions(lines: DataFrame, flag: str, line_col: str = "line", keep: Iterable[str] = ()) -> DataFrame:
    """``uid [TAB a] [TAB b]`` -> (uid, two fields); one field is skipped.

    ``apkver``: two fields -> apkver when the second contains a dot, else appkey;
    three or more -> appkey, apkver. ``sdkver``: two fields -> sdkver when it matches
    the version pattern, else channel; three or more -> channel, sdkver. The field
    not given is null (it overwrites on merge)."""
    split = pin(lines.select(*[F.col(c) for c in keep], F.col(line_col)), _arr=X.java_split(X.java_trim(F.col(line_col)), "\t"))
    arr = F.col("_arr")
    split = split.select(
        *[F.col(c) for c in keep], F.col(line_col), F.size(arr).alias("_n"),
        X.java_trim(F.get(arr, 0)).alias("_first"), X.java_trim(F.get(arr, 1)).alias("_second"), X.java_trim(F.get(arr, 2)).alias("_third"),
    )
    n, second, third = F.col("_n"), F.col("_second"), F.col("_third")
    if flag == "apkver":
        two_is_b = second.contains(".")
        names = ("appkey", "apkver")
    elif flag == "sdkver":
        two_is_b = second.rlike(SDKVER_PATTERN)
        names = ("channel", "sdkver")
    else:
        raise ValueError(f"unknown flag: {flag}")
    a = F.when(n == 2, F.when(~two_is_b, second)).otherwise(second)
    b = F.when(n == 2, F.when(two_is_b, second)).otherwise(third)
    out = split.select(
        *[F.col(c) for c in keep],
        F.col(line_col),
        F.col("_first").alias("uid"),
        a.alias(names[0]),
        b.alias(names[1]),
        n.alias("_n"),
    )
    return out.withColumn(REJECT, _first_reason((F.col("_n") > 1, "one_field"))).drop("_n")


# ---- P9: pair lines -------------------------------------------------------------------------

def parse_pairs(lines: DataFrame, line_col: str = "line", keep: Iterable[str] = ()) -> DataFrame:
    """Trimmed line of exactly two single-space fields -> (imei, pkg)."""
    split = pin(lines.select(*[F.col(c) for c in keep], F.col(line_col)), _arr=X.java_split(X.java_trim(F.col(line_col)), " "))
    arr = F.col("_arr")
    out = split.select(
        *[F.col(c) for c in keep],
        F.col(line_col),
        X.java_trim(F.get(arr, 0)).alias("imei"),
        X.java_trim(F.get(arr, 1)).alias("pkg"),
        F.size(arr).alias("_n"),
    )
    return out.withColumn(REJECT, _first_reason((F.col("_n") == 2, "fields"))).drop("_n")


# ---- P12: user parser hooks -----------------------------------------------------------------

def with_parser(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user parser written with DataFrame functions (``df.transform``)."""
    return df.transform(fn)


def with_table_function(df: DataFrame, parser: type, schema: str, arg: str, keep: Iterable[str] = ()) -> DataFrame:
    """P12 fallback: a user parser in Python as a table function: a class whose
    ``eval(value)`` yields 0..n rows of ``schema`` for the value of column ``arg``. Each
    input's rows come beside the columns of ``keep``. A parser that tells rejects from
    records yields them with a reason (``accepted``, ``rejects``).

    A table function answers every call with an Arrow batch of its own, so a task spends
    its time on batches of one row. The rows of a call are therefore one array value, sent
    in batches of many calls and taken apart by ``inline``. A parser with ``terminate`` or
    ``cleanup`` is called as a table function, since Spark calls these after the inputs."""
    # names of its own: the parser may return columns that the input has as well
    inputs = df.select(F.col(arg).alias("_arg"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    if hasattr(parser, "terminate") or hasattr(parser, "cleanup"):
        table = F.udtf(parser, returnType=schema, useArrow=True)
        out = inputs.lateralJoin(table(F.col("_arg").outer()))
    else:
        kind = StructType.fromDDL(schema)
        calls = F.udf(_calls_of(parser, len(kind)), ArrayType(kind), useArrow=True).asNondeterministic()
        # a nondeterministic column is evaluated once for an input, in a step of its own
        out = inputs.withColumn("_rows", calls("_arg")).select("*", F.inline("_rows")).drop("_rows")
    kept = [F.col(f"_keep_{c}").alias(c) for c in keep]
    return out.select(*kept, *[c for c in out.columns if c != "_arg" and not c.startswith("_keep_")])


def _calls_of(parser: type, width: int) -> Callable:
    """The rows of one call of ``eval`` as a list; a task makes one parser."""
    made = []

    def call(value):
        if not made:
            made.append(parser())
        rows = made[0].eval(value)
        # a row of one column may come without its tuple
        return [(r,) if width == 1 and not isinstance(r, tuple) else r for r in (() if rows is None else rows)]

    return call
