"""Time-key functions.

The session time zone belongs to whoever runs the job, so nothing here reads
it: epoch values are turned into wall-clock ``timestamp_ntz`` values of an
explicit zone with ``timestampadd`` + ``convert_timezone``, and NTZ values are
read back with field extractors (year, month, day, hour, minute, second).
``date_format`` and ``timestampdiff`` are avoided on NTZ values: both cast to a
session-zone timestamp first, which shifts wall-clock hours in DST gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pushlake.functions._cols import ColumnOrName, as_col

# Fixed value: the zone the reference's scheduler runs in.
DEFAULT_TZ = "Asia/Shanghai"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# epoch ms of 0001-01-01 and 9999-12-31 23:59:59.999 UTC: outside, a value has no key
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999

GRAIN_FORMATS = {"month": "yyyyMM", "day": "yyyyMMdd", "hour": "yyyyMMddHH"}


def epoch_ms_of_text(itime: ColumnOrName) -> Column:
    """Epoch ms of an epoch text: 10 characters are seconds, anything else ms.
    Null when the text is not a long."""
    t = as_col(itime).cast("string")
    v = t.try_cast("bigint")
    return F.when(F.length(t) == 10, F.try_multiply(v, F.lit(1000))).otherwise(v)


def local_wall_clock(epoch_ms: ColumnOrName, tz: str = DEFAULT_TZ) -> Column:
    """``timestamp_ntz`` wall clock of an epoch-ms instant in ``tz``."""
    ms = as_col(epoch_ms)
    utc = F.when(ms.between(_MIN_MS, _MAX_MS), F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ)))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def _2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def ntz_parts(ts_ntz: ColumnOrName) -> dict[str, Column]:
    """Zone-free text fields of a ``timestamp_ntz`` (or date): yyyy, MM, dd, HH."""
    t = as_col(ts_ntz)
    return {
        "yyyy": F.lpad(F.year(t).cast("string"), 4, "0"),
        "MM": _2(F.month(t)),
        "dd": _2(F.dayofmonth(t)),
        "HH": _2(F.hour(t)),
    }


def ntz_key(ts_ntz: ColumnOrName, grain: str = "hour") -> Column:
    """``yyyyMM`` / ``yyyyMMdd`` / ``yyyyMMddHH`` text of a ``timestamp_ntz``, zone-free."""
    p = ntz_parts(ts_ntz)
    parts = {"month": ["yyyy", "MM"], "day": ["yyyy", "MM", "dd"], "hour": ["yyyy", "MM", "dd", "HH"]}[grain]
    return F.concat(*[p[k] for k in parts])


def hour_key(epoch_ms: ColumnOrName, tz: str = DEFAULT_TZ) -> Column:
    """``yyyyMMddHH`` text of an epoch-ms instant in ``tz``."""
    return ntz_key(local_wall_clock(epoch_ms, tz), "hour")


def time_keys(itime: ColumnOrName, tz: str = DEFAULT_TZ) -> Column:
    """struct(imon, iday, ihour) ints of an epoch text (10 chars = seconds, else ms).
    A key that does not fit an int is null, and the caller drops the row."""
    h = hour_key(epoch_ms_of_text(itime), tz)
    return F.struct(
        F.substring(h, 1, 6).try_cast("int").alias("imon"),
        F.substring(h, 1, 8).try_cast("int").alias("iday"),
        h.try_cast("int").alias("ihour"),
    )


def grain_of(key: ColumnOrName, strict: bool = False) -> Column:
    """Grain from the key length: 6 month, 8 day, 10 hour; else null, or an error
    when ``strict``."""
    n = F.length(as_col(key))
    out = F.when(n == 6, "month").when(n == 8, "day").when(n == 10, "hour")
    if strict:
        return F.coalesce(out, F.raise_error(F.concat(F.lit("invalid date:"), as_col(key))).cast("string"))
    return out


def key_is_valid(key: ColumnOrName, grain: ColumnOrName | str) -> Column:
    """Strict calendar check of a time key for its grain; trailing text is not
    accepted (D12)."""
    k = as_col(key)
    g = F.lit(grain) if isinstance(grain, str) and grain in GRAIN_FORMATS else as_col(grain)
    ok_month = (F.length(k) == 6) & F.try_to_date(F.concat(k, F.lit("01")), "yyyyMMdd").isNotNull()
    ok_day = (F.length(k) == 8) & F.try_to_date(k, "yyyyMMdd").isNotNull()
    ok_hour = (
        (F.length(k) == 10)
        & F.try_to_date(F.substring(k, 1, 8), "yyyyMMdd").isNotNull()
        & F.substring(k, 9, 2).rlike("^([01][0-9]|2[0-3])$")
    )
    return F.coalesce(
        F.when(g == "month", ok_month).when(g == "day", ok_day).when(g == "hour", ok_hour),
        F.lit(False),
    )


def day_to_ms(day: ColumnOrName, tz: str = DEFAULT_TZ) -> Column:
    """T4: epoch ms of local midnight of a yyyyMMdd day in ``tz``; a bad day gives 0
    (no lenient roll-over, D13)."""
    d = as_col(day).cast("string")
    parsed = F.when(F.length(d) == 8, F.try_to_date(d, "yyyyMMdd"))
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), parsed.cast("timestamp_ntz"))
    return F.coalesce(ms_of_ntz(utc), F.lit(0).cast("bigint"))


def nominal_parts(ts_ntz: ColumnOrName) -> Column:
    """T5: struct(ym_dh, yyyy, MM, dd, HH, hour_HH) of a nominal time."""
    p = ntz_parts(ts_ntz)
    return F.struct(
        F.concat(p["yyyy"], p["MM"], p["dd"], p["HH"]).alias("yyyymmddhh"),
        p["yyyy"].alias("yyyy"),
        p["MM"].alias("mm"),
        p["dd"].alias("dd"),
        p["HH"].alias("hh"),
        F.concat(F.lit("hour_"), p["HH"]).alias("hour_hh"),
    )


def add_interval(d: ColumnOrName, n: ColumnOrName, unit: str) -> Column:
    """date/timestamp plus ``floor(n)`` whole units (second .. year)."""
    base = as_col(d)
    k = F.floor(as_col(n)).try_cast("int")
    unit = unit.lower()
    if unit == "day":
        return F.date_add(base, k)
    if unit == "month":
        return F.add_months(base, k)
    if unit == "year":
        return F.add_months(base, k * 12)
    if unit in ("hour", "minute", "second"):
        return F.timestamp_add(unit.upper(), k, base.cast("timestamp_ntz"))
    raise ValueError(f"unsupported unit: {unit}")


def ms_of_ntz(ts_ntz: ColumnOrName) -> Column:
    """Epoch ms (floor) of a ``timestamp_ntz`` read as UTC wall clock, from its date
    and time fields, so no session zone is involved."""
    t = as_col(ts_ntz)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    sec_ms = F.floor(F.date_part(F.lit("SECOND"), t) * 1000).cast("bigint")
    return days * 86400000 + F.hour(t).cast("bigint") * 3600000 + F.minute(t).cast("bigint") * 60000 + sec_ms


def secs_of_ntz(ts_ntz: ColumnOrName) -> Column:
    """Epoch seconds (floor) of a ``timestamp_ntz`` read as UTC wall clock."""
    return F.floor(ms_of_ntz(ts_ntz) / 1000).cast("bigint")
