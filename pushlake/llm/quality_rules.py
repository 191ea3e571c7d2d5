"""Operator 3 (native): quality rules as a short-circuit cascade.

A rule is a named Column that is true where a text fails. ``order_rules`` measures
every rule on a sample (by a hash of whole rows, so equal tables have equal samples): its
cost is the mean of its ``work`` there, the characters it reads, or without one the time
of evaluating it; its selectivity comes from one grouped count of fail patterns. Rules are
then ordered greedily by rejections among the texts still left, per cost, ties by name. ``cascade`` turns the
order into one CASE expression, which Spark evaluates branch by branch, so a text
that one rule rejects never reaches the later ones. The order changes only the
speed: a text is kept when no rule rejects it, and ``failed_rule`` names the first
rule in that order.

Everything is a DataFrame expression; repeated windows and lines are found inside
the row (hash, sort, neighbours), so there is no shuffle and no hot key.

Edge cases: null and empty texts have no words, all measures 0, and fail
``few_words``; long texts are handled whole in one row; an empty table gives an
empty result and the order in which the rules were given; repeated rows are
measured one by one; other columns pass through untouched, but an input column named as
a result (``_quality``, ``base_failed``, ``failed_rule``, ``kept``) gives way to it.
"""

from __future__ import annotations

import time
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import WORD_SEPARATORS, let

#: Code points that separate words.
BLANKS = " \t\n\x0b\x0c\r"
WINDOW_WORDS = 5
#: Rows that the planning sample holds on average. It decides the order of the rules only.
SAMPLE_ROWS = 1000
RESULTS = ["_quality", "base_failed", "failed_rule", "kept"]

#: Name and "fails" test over the struct of ``measures``.
Rule = tuple[str, Callable[[Column], Column]]


def words_of(text: Column) -> Column:
    """Words of a text; null: none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_SEPARATORS))


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))


def symbols(text: Column) -> Column:
    return (F.size(F.split(F.coalesce(text, F.lit("")), "[#*$%&|<>]", -1)) - 1).cast("long")


def repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more. Windows are compared by
    a 64-bit hash within one text; equal hashes meet by sorting (hash, position)."""
    n, w = F.size(words), WINDOW_WORDS

    def covered(hashes: Column) -> Column:
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda x, k: F.coalesce((F.get(s, k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce((F.get(s, k + 1)["h"] == x["h"]), F.lit(False)))
        places = F.sort_array(F.transform(let(tagged, twice), lambda x: x["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")),
            lambda a, i: F.struct((i + w).alias("end"), (a["sum"] + w - F.greatest(F.lit(0), a["end"] - i)).cast("long").alias("sum")),
            lambda a: a["sum"],
        )

    def windows(hs: Column) -> Column:
        return F.transform(F.slice(hs, F.lit(1), n - (w - 1)), lambda x, i: F.xxhash64(x, *[F.get(hs, i + k) for k in range(1, w)]))

    hashes = let(F.transform(words, lambda x: F.xxhash64(x)), windows)
    return F.when(n < w + 1, F.lit(0).cast("long")).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    )


def upper_share(text: Column) -> Column:
    """Share of A-Z among the A-Z and a-z of a text."""
    up = F.size(F.split(text, "[A-Z]", -1)) - 1
    low = F.size(F.split(text, "[a-z]", -1)) - 1
    return let(F.struct(up.alias("u"), low.alias("l")), lambda x: x["u"] / F.greatest(x["u"] + x["l"], F.lit(1)))


def measures(text: Column) -> Column:
    """Struct of the base measures of a text; the words are split once."""
    text = F.coalesce(text, F.lit(""))
    return let(
        words_of(text),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            symbols(text).alias("n_symbols"),
            dup_lines(text).alias("n_dup_lines"),
            repeat_words(ws).alias("n_repeat_words"),
        ),
    )


def base_rules() -> list[Rule]:
    """Rules of the base verdict."""
    return [
        ("few_words", lambda m: m["n_words"] < 10),
        ("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    ]


def extra_rules(text: Column) -> list[tuple[str, Callable[[Column], Column], Column]]:
    """Rules that the cascade adds, with the characters that each one reads besides the
    base measures; thresholds leave ordinary prose and tables alone."""
    text = F.coalesce(text, F.lit(""))
    none, once = F.lit(1), F.length(text) + 1
    return [
        ("symbol_noise", lambda m: m["n_symbols"] > 1.5 * m["n_words"], none),
        ("separator_list", lambda m: let(F.size(F.split(text, "\\|", -1)) - 1, lambda n: n > 0.3 * m["n_words"]), once),
        ("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"]), none),
        ("repeated_lines", lambda m: 2 * m["n_dup_lines"] > F.size(F.split(text, "\n")), once),
        ("shouting", lambda m: upper_share(text) > 0.7, 2 * once),
    ]


def order_rules(sample: DataFrame, rules: Sequence[tuple]) -> list[str]:
    """Rule names by rejections among the rows still left per cost, both measured on
    ``sample`` (a bounded DataFrame). A rule is (name, test) or (name, test, work)."""
    def seconds(expr: Column) -> float:
        t0 = time.perf_counter()
        sample.agg(F.max(expr)).collect()  # one row
        return time.perf_counter() - t0

    names = [r[0] for r in rules]
    patterns = sample.groupBy(*[F.coalesce(r[1], F.lit(False)).alias(r[0]) for r in rules]).count().collect()  # at most 2^rules rows
    if all(len(r) == 3 for r in rules):
        cost = sample.agg(*[F.avg(r[2]).alias(r[0]) for r in rules]).first().asDict()
        cost = {n: c or 1.0 for n, c in cost.items()}
    else:
        idle = min(seconds(F.lit(True)) for _ in range(2))
        cost = {r[0]: max(min(seconds(r[1]) for _ in range(2)) - idle, 1e-4) for r in rules}
    left, order = list(patterns), []
    while len(order) < len(names):
        rest = [n for n in names if n not in order]
        best = min(rest, key=lambda n: (-sum(p["count"] for p in left if p[n]) / cost[n], cost[n], n))
        order.append(best)
        left = [p for p in left if not p[best]]
    return order


def cascade(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first failing rule; null when none fails."""
    (name, test), *rest = rules
    out = F.when(test, F.lit(name))
    for name, test in rest:
        out = out.when(test, F.lit(name))
    return out


def _measured(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the struct ``_quality``; the one-element inline pins it, so it is
    computed once per row and not substituted into every rule."""
    return docs.select("*", F.inline(F.array(F.struct(measures(text).alias("_quality")))))


def planning_sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows over the whole table, by a hash of their columns (maps and
    other columns without a hash do not count)."""
    share = rows / max(1, docs.count())
    if share >= 1:
        return docs
    hashed = [f.name for f in docs.schema.fields if not f.dataType.simpleString().startswith(("map", "variant", "array<map", "struct"))]
    draw = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(1 << 40))
    return docs.filter(draw < int(share * (1 << 40)))


def apply_rules(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with columns ``_quality`` (the base measures), ``base_failed``,
    ``failed_rule`` and ``kept``. Base rules come first, since their measures are
    returned in any case; the cascade orders the added rules."""
    drawn = planning_sample(docs, sample_rows)
    docs = docs.drop(*[c for c in RESULTS if c != text_col])
    text = F.col(text_col).cast("string")
    m = F.col("_quality")
    rules = [(n, f(m), work) for n, f, work in extra_rules(text)]
    sample = _measured(drawn.select(text_col), text).persist()
    try:
        order = order_rules(sample, rules)
    finally:
        sample.unpersist()
    tests = {n: test for n, test, _ in rules}
    base = [(n, f(m)) for n, f in base_rules()]
    out = _measured(docs, text).withColumn("failed_rule", cascade(base + [(n, tests[n]) for n in order]))
    return out.withColumns({"base_failed": base[0][1] | base[1][1], "kept": F.col("failed_rule").isNull()})
