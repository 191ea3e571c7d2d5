"""Operator 6 (native): chat formatting in budgeted windows.

Prefix sums of turn tokens place every turn of a conversation on a token axis that
is cut into cells of the budget left for new turns. Turns that lie inside one cell
share a window; the one turn that crosses a cell border gets a window of its own.
The cell is the budget less the system turn and the history, and the history shrinks to
half of what the system turn leaves: a window exceeds the budget only where a single
turn that does not fit, or the system turn, is kept whole.
Every later window repeats the system turn and the turns of the last
``history`` tokens; the loss mask covers assistant texts of new turns only, so a
repeated target is masked and each one is learned once.

The prefix sums are two-level (chunks of a conversation, then turns of a chunk) and
windows are assembled per (conversation, window), so a conversation with a third of
all rows is spread over tasks.

The template writes ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts
every backslash becomes ``\\b``, ``<|`` becomes ``<\\p`` and, in roles, a newline
``\\n``: control strings cannot be forged, and ``unescape`` restores the original.

Edge cases: null texts and roles count as empty; null turns sort first; a null
conv_id is a conversation of its own; equal (conv_id, turn) rows are kept and
ordered by role and text; a conversation without system turn repeats none; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pushlake.llm._util import materialize
from pushlake.llm.quality_rules import words_of

START, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
TURN_OVERHEAD = 4
CHUNK_TURNS = 256


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\p"), F.lit("|"))
    out = F.replace(out, F.lit("\\n"), F.lit("\n")) if role else out
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def _placed(turns: DataFrame) -> DataFrame:
    """Every turn with ``idx`` (0-based) and ``at`` (tokens before it)."""
    chunks = turns.groupBy("conv_id", "chunk").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        F.col("conv_id").alias("c_conv"), F.col("chunk").alias("c_chunk"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0")
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    return (
        turns.withColumn("t1", F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n1", F.row_number().over(inside) - 1)
        .join(chunks, F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk")))
        .select("conv_id", "role", "text", "tokens", (F.col("n0") + F.col("n1")).alias("idx"), (F.col("t0") + F.col("t1")).alias("at"))
    )


def format_windows(conversations: DataFrame, budget: int = 1024, history: int = 256, tokens_col: str | None = None) -> DataFrame:
    """One row per window: (conv_id, window, formatted, new: array<boolean> per turn,
    loss: array<struct<start, end>> in code points, n_tokens). A turn's tokens are the
    column ``tokens_col`` (counts of a tokenizer, say), by default its words and
    TURN_OVERHEAD for its marks."""
    if history < 1 or budget < 1:
        raise ValueError("budget and history are at least one token")
    tokens = F.size(words_of(F.col("text"))) + TURN_OVERHEAD if tokens_col is None else F.greatest(F.coalesce(F.col("_tokens"), F.lit(1)), F.lit(1))
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([] if tokens_col is None else [F.col(tokens_col).cast("long").alias("_tokens")]),
    ).withColumns({"tokens": tokens.cast("long"), "chunk": F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-(1 << 62)))})
    # written once: what follows reads it four times, mostly without the texts
    placed = materialize(_placed(turns), "turns")
    system = (
        placed.filter(F.col("role") == SYSTEM_ROLE)
        .groupBy(F.col("conv_id").alias("s_conv"))
        .agg(F.min_by(F.struct("idx", "role", "text", "tokens"), "idx").alias("sys"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("s_conv"))
    left = F.greatest(F.lit(budget) - F.coalesce(F.col("sys.tokens"), F.lit(0)), F.lit(0))
    repeat = F.least(F.lit(history), F.floor(left / 2))
    cell = F.greatest(left - repeat, F.lit(1))
    placed = placed.join(system, same, "left").select(
        "conv_id", "role", "text", "tokens", "idx", "at", F.col("sys.idx").alias("sys_idx"), repeat.alias("repeat"), F.floor(F.col("at") / cell).alias("first"), F.floor((F.col("at") + F.col("tokens") - 1) / cell).alias("last")
    )
    placed = placed.withColumn("window", 2 * F.col("first") + (F.col("last") > F.col("first")).cast("long"))
    row = lambda new: F.struct("idx", F.lit(new).alias("new"), "role", "text", "tokens").alias("row")
    windows = placed.groupBy(F.col("conv_id").alias("w_conv"), F.col("window").alias("w")).agg(F.min("at").alias("w_at"), F.min("idx").alias("w_idx"))
    # the turns of the last ``history`` tokens before a window's first: its start
    # falls in a turn's own bucket of the token axis or in the next one
    bucket = F.floor(F.col("at") / history)
    near = placed.select("conv_id", "idx", "at", "sys_idx", "repeat", F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    starts = windows.withColumn("w_bucket", F.floor(F.col("w_at") / history))
    again = near.join(starts, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("bucket") == F.col("w_bucket"))).filter(
        (F.col("at") < F.col("w_at")) & (F.col("w_at") - F.col("at") <= F.col("repeat")) & ~F.col("idx").eqNullSafe(F.col("sys_idx"))
    )
    # found without the texts, which join what is repeated
    again = again.select(F.col("conv_id").alias("r_conv"), F.col("idx").alias("r_idx"), F.col("w").alias("r_w"))
    repeated = placed.join(again, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("idx") == F.col("r_idx")))
    head = windows.join(system, F.col("w_conv").eqNullSafe(F.col("s_conv"))).filter(F.col("sys.idx") < F.col("w_idx"))
    rows = (
        placed.select("conv_id", "window", row(True))
        .unionByName(repeated.select("conv_id", F.col("r_w").alias("window"), row(False)))
        .unionByName(head.select(F.col("w_conv").alias("conv_id"), F.col("w").alias("window"), F.struct("sys.idx", F.lit(False).alias("new"), "sys.role", "sys.text", "sys.tokens").alias("row")))
    )
    # bounded by the token budget (one oversized turn apart)
    out = rows.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    lead = lambda r: F.concat(F.lit(START), escape(r["role"], role=True), F.lit("\n"))
    parts = F.transform("rows", lambda r: F.struct(lead(r).alias("lead"), escape(r["text"]).alias("body"), (r["new"] & (r["role"] == TARGET_ROLE)).alias("target")))
    out = out.select("conv_id", "window", "rows", F.inline(F.array(F.struct(parts.alias("parts")))))
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["lead"]) + F.length(p["body"]) + len(END)).alias("at"),
            F.when(
                p["target"],
                F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(p["lead"])).alias("start"), (a["at"] + F.length(p["lead"]) + F.length(p["body"])).alias("end")))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return out.select(
        "conv_id",
        "window",
        F.array_join(F.transform("parts", lambda p: F.concat(p["lead"], p["body"], F.lit(END))), "").alias("formatted"),
        F.transform("rows", lambda r: r["new"]).alias("new"),
        spans.alias("loss"),
        F.aggregate("rows", F.lit(0).cast("long"), lambda a, r: a + r["tokens"]).alias("n_tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per window, read from its text and mask alone: ``turns`` (role, text of the new
    turns, unescaped) and ``targets`` (unescaped text under the loss mask)."""
    pieces = F.filter(F.split("formatted", "<\\|im_end\\|>\n", -1), lambda x: x != "")
    turns = F.transform(
        F.filter(pieces, lambda x, i: F.get(F.col("new"), i)),
        lambda x: let_turn(x),
    )
    return windows.select(
        "conv_id",
        "window",
        turns.alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))).alias("targets"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def let_turn(piece: Column) -> Column:
    role = F.substring_index(piece, "\n", 1)
    body = F.substring(piece, F.length(role) + 2, F.length(piece))
    return F.struct(unescape(F.substring(role, len(START) + 1, F.length(role)), role=True).alias("role"), unescape(body).alias("text"))


def digest(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. The digests are of one string per
    conversation, so its text meets in one row here (and only here)."""
    back = read_back(windows).select(
        "conv_id",
        "formatted_chars",
        F.size("turns").cast("long").alias("n"),
        F.struct(
            "window",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join("targets", "").alias("loss"),
        ).alias("part"),
    )
    whole = back.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts"))
    text = lambda f: F.array_join(F.transform("parts", lambda p: p[f]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
