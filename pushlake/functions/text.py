"""String functions with the semantics of the Java / Python helpers.

Every function takes and returns Columns and is built from Spark's own
expressions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pushlake.functions._cols import ColumnOrName, as_col

# Fixed value: Java String.trim() removes every char from U+0000 to U+0020.
JAVA_BLANKS = "".join(chr(i) for i in range(0x21))
_REGEX_META = set(".$|()[]{}^?*+\\")


def java_trim(s: ColumnOrName) -> Column:
    """Java ``String.trim``: strips every char <= U+0020 (tabs, CR, NUL...).
    Spark's ``trim`` with an explicit character set (no regex)."""
    return F.trim(as_col(s), F.lit(JAVA_BLANKS))


def java_split(s: ColumnOrName, sep: str) -> Column:
    """Java ``String.split(sep)``: like Spark ``split`` but trailing empty fields
    are dropped (so a text of separators only gives no field, an empty text one
    empty field). ``sep`` is a regular expression, as in Java; a one-character
    literal separator takes the fast path (``rtrim`` of it, no regex scan)."""
    c = as_col(s)
    if len(sep) == 1 and sep not in _REGEX_META:
        r = F.rtrim(c, F.lit(sep))
        return F.when((F.length(r) == 0) & (F.length(c) > 0), F.array().cast("array<string>")).otherwise(F.split(r, sep))
    return F.split(F.regexp_replace(c, f"(?:{sep})+$", ""), sep)


def reverse_key(s: ColumnOrName) -> Column:
    """Reversed string (row keys stored reversed)."""
    return F.reverse(as_col(s))


def md5_key(s: ColumnOrName) -> Column:
    """MD5 of the UTF-8 text as lower-case hex."""
    return F.md5(as_col(s).cast("string"))


def concat_key(*parts: ColumnOrName) -> Column:
    """Plain concatenation of the text of each part."""
    return F.concat(*[as_col(p).cast("string") for p in parts])


def split_time_key(key: ColumnOrName) -> Column:
    """struct(year, month, day) of a yyyyMM / yyyyMMdd / yyyyMMddHH key.
    A month key leaves ``day`` null."""
    k = as_col(key)
    return F.struct(
        F.substring(k, 1, 4).alias("year"),
        F.substring(k, 5, 2).alias("month"),
        F.when(F.length(k) >= 8, F.substring(k, 7, 2)).alias("day"),
    )


def day_of_hour(key: ColumnOrName) -> Column:
    """The yyyyMMdd part of an hour key."""
    return F.substring(as_col(key), 1, 8)


def qualifier_of(family_col: ColumnOrName) -> Column:
    """The qualifier of ``family:qualifier``."""
    return F.get(F.split(as_col(family_col), ":"), 1)


def form_encode(m: ColumnOrName) -> Column:
    """``k=v&k=v&`` from a map: values URL-encoded, keys raw, trailing ``&``; a
    null value is the text ``null`` (Java's ``String.valueOf``). Keys are sorted so
    the text is deterministic."""
    entries = F.array_sort(F.map_entries(as_col(m)))
    value = lambda e: F.url_encode(F.coalesce(e["value"].cast("string"), F.lit("null")))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), value(e), F.lit("&"))), "")


def form_decode(s: ColumnOrName) -> Column:
    """URL-decoded text, for logs."""
    return F.url_decode(as_col(s))


# ---- property values (X9-X13) --------------------------------------------------------

def int_or(s: ColumnOrName, default: int | None) -> Column:
    """Int with a default when absent or not an int (surrounding blanks accepted, D10)."""
    return F.coalesce(as_col(s).try_cast("int"), F.lit(default))


def bool_or(s: ColumnOrName, default: bool) -> Column:
    """Only ``true`` in any case is true; absent -> default."""
    return F.coalesce(F.lower(as_col(s)) == F.lit("true"), F.lit(default))


def _csv(s: Column) -> Column:
    return java_split(s, ",")


def int_array_or(s: ColumnOrName, default: list[int]) -> Column:
    """X11: CSV -> int array; one bad element (or absent text) gives the default."""
    c = as_col(s)
    parts = F.transform(_csv(c), lambda x: x.try_cast("int"))
    dflt = F.array(*[F.lit(int(v)) for v in default]).cast("array<int>")
    return F.when(c.isNull() | F.exists(parts, lambda x: x.isNull()), dflt).otherwise(parts)


def bool_array(s: ColumnOrName, default: list[bool] | None = None) -> Column:
    """CSV -> boolean array (only ``true``, any case, is true); absent text gives
    ``default``."""
    out = F.transform(_csv(as_col(s)), lambda x: F.lower(x) == F.lit("true"))
    return out if default is None else F.coalesce(out, F.array(*[F.lit(bool(v)) for v in default]).cast("array<boolean>"))


def string_array(s: ColumnOrName, default: list[str] | None = None) -> Column:
    """CSV -> string array (trailing empty entries dropped); absent text gives
    ``default``."""
    out = _csv(as_col(s))
    return out if default is None else F.coalesce(out, F.array(*[F.lit(str(v)) for v in default]).cast("array<string>"))


def kv_map(s: ColumnOrName) -> Column:
    """``k:v,k:v`` -> map sorted by key; entries without a colon dropped, a third
    part ignored, the last duplicate wins."""
    entries = F.filter(F.transform(_csv(as_col(s)), lambda e: java_split(e, ":")), lambda p: F.size(p) > 1)
    pairs = F.transform(entries, lambda p: F.struct(p[0].alias("key"), p[1].alias("value")))
    # last duplicate wins: keep an entry only when no later entry has its key
    indexed = F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), p["value"].alias("value"), i.alias("i")))
    kept = F.filter(
        indexed,
        lambda e: ~F.exists(indexed, lambda o: (o["key"] == e["key"]) & (o["i"] > e["i"])),
    )
    m = F.map_from_entries(F.array_sort(F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))))
    # absent text: an empty map, as the reference's caught NPE leaves it
    return F.coalesce(m, F.create_map().cast("map<string,string>"))


def truncate(s: ColumnOrName, n: int = 300) -> Column:
    """The first ``n`` characters."""
    return F.substring(as_col(s), 1, n)


def name_tokens_0_2(s: ColumnOrName) -> Column:
    """Tokens 0 and 2 of a split on one space, joined by ``_``."""
    t = F.split(as_col(s), " ")
    return F.concat(F.get(t, 0), F.lit("_"), F.get(t, 2))


def json_text(doc: ColumnOrName, key: str) -> Column:
    """The text of a JSON member: strings as is, nested values as compact JSON."""
    return F.get_json_object(as_col(doc), f"$.{key}")


def has_json_key(doc: ColumnOrName, key: str) -> Column:
    """True when the JSON object has the key (also when its value is null)."""
    return F.coalesce(F.array_contains(F.json_object_keys(as_col(doc)), key), F.lit(False))


def to_json_list(items: ColumnOrName) -> Column:
    """JSON text of an array of structs (null fields omitted)."""
    return F.to_json(as_col(items))
