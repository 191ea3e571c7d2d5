"""Operator 13: cheapest repair of the turn structure of conversations, by path ranking
with prefix doubling.

Rows of a conversation are in order of turn (nulls first), then role and text. The first
fault of a row counts: blank (only separators), duplicate (role and text seen earlier in
the conversation), truncated (the last character that is no separator is not . ! ?).
Edits: Keep (0), Rerole to user or assistant (1), Delete (2; the only one for blank
and duplicate rows), Insert an empty user or assistant turn anywhere (5); a truncated
row that is not deleted adds 5. The first letters of the roles that remain must
be ``(s?(ua)+)?``. Among the cheapest edits the ASCII-least string of their initials wins.

Four states follow the roles (none yet, after s, after u, after a). Rows become one
symbol each and are cut into blocks of ``BLOCK`` rows, so no task holds a whole long
conversation:

1. Cost DP: a block is a 4 x 4 matrix of least costs; matrices are combined by groups of
   ``FAN`` blocks, level by level, and costs to the end are handed down again.
2. Path ranking inside a block: nodes are (row, state), and only arcs on cheapest paths
   stay. Each node gets the rank of its least next letter, then ranks of twice the
   length from the pair of its rank and the least rank among the nodes where its least
   paths of the present length end. With ranks for whole paths, every node takes the arc
   of least letter and then least rank, and doubled pointers give the nodes of a path.
3. Each block now maps the state before it to the state after it; these maps are combined
   and handed down as the costs were.

A state and a letter have one next state, so two least paths with the same letters end in
the same state: ranks need not be compared beyond the end of a block.

Edge cases: null role or text is one space; null turns come first; an empty role has no
initial, so it can be kept anywhere; rows of a null conversation id are one conversation;
texts of any length are only read for their fault; an empty table gives an empty result;
extra columns are ignored. The digest of a repaired conversation is of one string, so its
text meets in one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import materialize, measured
from pushlake.operators.ordered import dense_index

#: Rows of a block, and blocks that are combined at a time.
BLOCK = 1024
FAN = 1024
SEPARATORS = " \t\n\x0b\x0c\r"

_INF = 1 << 40
#: State after a role by the state before it: user and assistant.
_NEXT = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
_ROLE = {2: "user", 3: "assistant"}
#: Symbols: role initial (e: empty, o: other; upper case: truncated), x: must go, $: end.
_SYMBOLS = "suaeoSUAEOx$"
_LETTERS = "DIKR"


def _arcs():
    """(cost, target) by letter, symbol and state; a negative target is no arc."""
    cost = np.full((len(_LETTERS) + 1, len(_SYMBOLS), 4), _INF, np.int64)
    target = np.full(cost.shape, -1, np.int64)

    def arc(letter, symbol, q, to, c):
        cost[letter, symbol, q], target[letter, symbol, q] = c, to

    for s, name in enumerate(_SYMBOLS):
        more = 5 if name.isupper() else 0
        for q in range(4):
            for to in [*_NEXT["u"].items(), *_NEXT["a"].items()]:
                if to[0] == q:
                    arc(1, s, q, to[1], 5)
            if name == "$":
                if q in (0, 3):
                    arc(4, s, q, q, 0)
                continue
            arc(0, s, q, q, 2)
            if name == "x":
                continue
            initial = name.lower()
            if initial == "e":
                arc(2, s, q, q, more)
            elif q in _NEXT.get(initial, {}):
                arc(2, s, q, _NEXT[initial][q], more)
            for role in "ua":
                if q in _NEXT[role]:
                    arc(3, s, q, _NEXT[role][q], 1 + more)
    return cost, target


_COST, _TARGET = _arcs()
_INSERTS = 1  # the letter that consumes no row


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices (..., 4, 4)."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), _INF)


def _steps() -> np.ndarray:
    """Least costs of insertions and then one symbol, by symbol."""
    one = np.full((4, 4), _INF, np.int64)
    for q in range(4):
        one[q, q] = 0
        if _TARGET[_INSERTS, 0, q] >= 0:
            one[q, _TARGET[_INSERTS, 0, q]] = 5
    inserts = _product(_product(one, one), _product(one, one))
    rows = np.full((len(_SYMBOLS), 4, 4), _INF, np.int64)
    for letter in (0, 2, 3, 4):
        for s in range(len(_SYMBOLS)):
            for q in range(4):
                if (to := _TARGET[letter, s, q]) >= 0:
                    rows[s, q, to] = min(rows[s, q, to], _COST[letter, s, q])
    return _product(inserts[None], rows)


_STEP = _steps()
_CODE = np.full(128, -1, np.int64)
for _i, _c in enumerate(_SYMBOLS):
    _CODE[ord(_c)] = _i


def _codes(symbols: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in symbols])
    return _CODE[np.frombuffer("".join(symbols).encode(), np.uint8)], sizes


def _costs_after(codes: np.ndarray, sizes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least cost to the end of the conversation at every node, (rows + 1 of each block)
    x 4 states; ``after`` are the costs behind each block."""
    ends = np.cumsum(sizes + 1) - 1
    out = np.empty((ends[-1] + 1, 4), np.int64)
    out[ends] = after
    row_ends = np.cumsum(sizes)
    for back in range(1, sizes.max(initial=0) + 1):
        on = np.flatnonzero(sizes >= back)
        step = _STEP[codes[row_ends[on] - back]]
        out[ends[on] - back] = np.minimum((step + out[ends[on] - back + 1][:, None, :]).min(-1), _INF)
    return out


def _matrices(symbols: list[str]) -> np.ndarray:
    codes, sizes = _codes(symbols)
    rows = [_costs_after(codes, sizes, np.where(np.arange(4) == q, 0, _INF)[None].repeat(len(sizes), 0)) for q in range(4)]
    starts = np.cumsum(sizes + 1) - sizes - 1
    return np.stack([r[starts] for r in rows], -1)


def _ranked_paths(symbols: list[str], after: np.ndarray):
    """For every block and state before it: letters, states after each letter, cost in
    the block and state behind it (-1: no way)."""
    codes, sizes = _codes(symbols)
    costs = _costs_after(codes, sizes, after)
    nodes = len(costs)
    ends = np.cumsum(sizes + 1) - 1
    is_end = np.zeros(nodes, bool)
    is_end[ends] = True
    symbol = np.zeros(nodes, np.int64)
    symbol[~is_end] = codes
    # arcs on cheapest paths: targets by letter, node x state; node and state are one number
    to = np.full((5, nodes, 4), -1, np.int64)
    for letter in range(5):
        place = np.arange(nodes) + (letter != _INSERTS)
        target = _TARGET[letter][symbol]
        reach = costs[np.minimum(place, nodes - 1)[:, None], np.maximum(target, 0)]
        best = (target >= 0) & ~is_end[:, None] & (costs < _INF) & (_COST[letter][symbol] + reach == costs)
        to[letter] = np.where(best, place[:, None] * 4 + target, -1)
    to = to.reshape(5, -1)
    value = np.array([ord(c) for c in _LETTERS] + [1])  # the end sorts before any letter
    letter = np.where(to >= 0, value[:, None], 1 << 20)
    # ranks of least audits of length 1, and the states where these end
    rank = letter.min(0)
    stays = rank == 1 << 20
    rank[stays] = 0
    least = (letter == rank) & ~stays
    own = np.arange(nodes * 4)
    place = np.where(stays, own // 4, np.where(least, to, -1).max(0) // 4)
    state = np.zeros((nodes * 4, 4), bool)
    for l in range(5):
        state[own[least[l]], to[l][least[l]] % 4] = True
    state[own[stays], own[stays] % 4] = True
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    length, longest = 1, 2 * sizes.max(initial=0) + 8
    while length < longest:
        there = np.where(state, rank.reshape(-1, 4)[place], 1 << 40)
        second = there.min(1)
        attained = state & (there == second[:, None])
        fresh, where = np.zeros_like(state), np.zeros(len(own), np.int64)
        for q in range(4):
            on = np.flatnonzero(attained[:, q])
            at = place[on] * 4 + q
            fresh[on] |= state[at]
            where[on] = place[at]
        rank = np.unique(rank * (rank.max() + 1) + second, return_inverse=True)[1].astype(np.int64)
        place, state, length = where, fresh, length * 2
    # the arc of least letter, then least rank
    order = np.where(to >= 0, letter * (rank.max() + 1) + rank[np.maximum(to, 0)], 1 << 60)
    choice = order.argmin(0)
    follow = np.where(stays, own, to[choice, own])
    audits, paths, spent, behind = [], [], [], []
    pointers, reach = [follow], 1
    while reach < longest:
        pointers.append(pointers[-1][pointers[-1]])
        reach *= 2
    names = np.array(list(_LETTERS + "$"))
    for start in np.cumsum(sizes + 1) - sizes - 1:
        block = [[], [], [], []]
        for q in range(4):
            v = start * 4 + q
            if costs[start, q] >= _INF:
                for x, y in zip(block, ("", "", 0, -1)):
                    x.append(y)
                continue
            path = np.array([v])
            for p in pointers:
                path = np.concatenate([path, p[path]])
                if stays[path[-1]]:
                    break
            path = path[: int(np.argmax(stays[path])) + 1]
            word = names[choice[path[:-1]]]
            edits = word != "$"
            last = path[-1]
            for x, y in zip(block, ("".join(word[edits]), "".join(map(str, (path[1:] % 4)[edits])), int(costs[start, q] - costs[last // 4, last % 4]), int(last % 4))):
                x.append(y)
        for x, y in zip((audits, paths, spent, behind), block):
            x.append(y)
    return audits, paths, spent, behind


# Hand-over of costs and states along the blocks of a conversation ----------------


def _matrix_column(m: np.ndarray) -> pa.Array:
    return pa.array(list(m.reshape(-1, 16)), pa.list_(pa.int64()))


def _as_matrices(column) -> np.ndarray:
    return np.array([v.values.to_numpy() for v in column], np.int64).reshape(-1, 4, 4)


def _handed(nodes: DataFrame, seed: list[int], backward: bool) -> DataFrame:
    """(key, b, vec): for every block the vector that reaches it from the end of its
    conversation (``backward``: costs behind it) or from the start (states before it).
    ``nodes`` (key, b, m) are combined by groups until one group holds all blocks."""

    def combine(batches):
        for batch in batches:
            out = []
            for group in batch.column(2):
                m = _as_matrices(group.values.field("m"))
                total = m[0]
                for x in m[1:]:
                    total = _product(total, x)
                out.append(total)
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _matrix_column(np.stack(out))], names=["key", "b", "m"])

    def hand(batches):
        for batch in batches:
            keys, bs, vecs = [], [], []
            for key, group, vec in zip(batch.column(0), batch.column(2), batch.column(3)):
                m, v = _as_matrices(group.values.field("m")), np.array(vec.as_py(), np.int64)
                b = group.values.field("b").to_pylist()
                for i in range(len(m) - 1, -1, -1) if backward else range(len(m)):
                    keys.append(key.as_py())
                    bs.append(b[i])
                    vecs.append(v)
                    v = np.minimum((m[i] + v[None, :]).min(1) if backward else (v[:, None] + m[i]).min(0), _INF)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(bs, pa.int64()), pa.array(vecs, pa.list_(pa.int64()))], names=["key", "b", "vec"])

    levels = []
    while True:
        nodes, size = measured(nodes, "blocks", top=F.max("b"))
        if not size["top"]:  # the one group of each conversation, or no rows
            break
        groups = nodes.groupBy("key", F.floor(F.col("b") / FAN).cast("long").alias("up")).agg(F.sort_array(F.collect_list(F.struct("b", "m"))).alias("nodes"))
        groups = materialize(groups, "groups")
        levels.append(groups)
        nodes = groups.select("key", F.col("up").alias("b"), "nodes").mapInArrow(combine, "key string, b long, m array<long>")
    vecs = nodes.select("key", "b", F.array(*[F.lit(x).cast("long") for x in seed]).alias("vec"))
    for groups in reversed(levels):
        both = groups.join(vecs.withColumnRenamed("b", "up"), ["key", "up"])
        vecs = materialize(both.select("key", "up", "nodes", "vec").mapInArrow(hand, "key string, b long, vec array<long>"), "handed")
    return vecs


# The operator ---------------------------------------------------------------------


def faults(rows: DataFrame) -> DataFrame:
    """(key, idx, turn, role, text, initial, fault): rows (conv_id, turn, role, text) in
    their order, ``idx`` counting through all conversations."""
    conv = F.col("conv_id")
    rows = rows.select(
        F.when(conv.isNull(), "null").otherwise(F.concat(F.lit("="), conv.cast("string"))).alias("key"),
        "turn",
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    rows = dense_index(rows, ["key", "turn", "role", "text"])
    bare = F.rtrim(F.col("text"), F.lit(SEPARATORS))
    rows = rows.withColumn("digest", F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text"))))
    first = rows.groupBy("key", "digest").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    rows = rows.join(first, ["key", "digest"], "left")
    fault = F.when(bare == "", "blank").when(F.col("idx") > F.col("first"), "duplicate").when(~F.substring(bare, -1, 1).isin(*".!?"), "truncated")
    initial = F.substring("role", 1, 1)
    return rows.select("key", "idx", "turn", "role", "text", initial.alias("initial"), fault.alias("fault"))


def _blocks(rows: DataFrame) -> DataFrame:
    """(key, b, first, symbols, initials) of the blocks; the last block of a conversation
    ends with the end symbol."""
    kind = F.when(F.col("initial").isin(*"sua"), F.col("initial")).when(F.col("initial") == "", "e").otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind)
    rows = rows.select("key", "idx", F.lit(0).alias("last"), symbol.alias("symbol"), kind.alias("kind"))
    ends = rows.groupBy("key").agg(F.max("idx").alias("idx")).select("key", "idx", F.lit(1).alias("last"), F.lit("$").alias("symbol"), F.lit("").alias("kind"))
    rows = rows.unionByName(ends).withColumn("b", F.floor(F.col("idx") / BLOCK).cast("long"))
    told = F.sort_array(F.collect_list(F.struct("idx", "last", "symbol", "kind")))
    rows = rows.groupBy("key", "b").agg(told.alias("rows"))
    joined = [F.array_join(F.col(f"rows.{c}"), "").alias(n) for c, n in (("symbol", "symbols"), ("kind", "initials"))]
    return rows.select("key", "b", F.col("rows")[0]["idx"].alias("first"), *joined)


def _illegal(blocks: DataFrame) -> DataFrame:
    """(key, illegal): adjacent initials that are not su, ua or au, over block borders."""
    before = blocks.select("key", (F.col("b") + 1).alias("b"), F.right("initials", F.lit(1)).alias("prior"))
    whole = blocks.join(before, ["key", "b"], "left").select("key", F.concat(F.coalesce("prior", F.lit("")), "initials").alias("w"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2)))
    bad = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    return whole.groupBy("key").agg(F.sum(F.when(F.length("w") > 1, bad).otherwise(0)).alias("illegal"))


def _paths(blocks: DataFrame) -> DataFrame:
    """(key, b, first, audit, states, cost) of the chosen edits of every block."""

    def matrices(batches):
        for batch in batches:
            if batch.num_rows:
                m = _matrices(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _matrix_column(m)], names=["key", "b", "m"])

    def rank(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                after = np.array(part.column(4).to_pylist(), np.int64)
                audits, paths, spent, behind = _ranked_paths(part.column(3).to_pylist(), after)
                maps = np.full((len(behind), 4, 4), _INF, np.int64)
                for i, states in enumerate(behind):
                    for q, to in enumerate(states):
                        if to >= 0:
                            maps[i, q, to] = 0
                columns = [*(part.column(c) for c in range(3)), pa.array(audits), pa.array(paths), pa.array(spent, pa.list_(pa.int64())), _matrix_column(maps)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "b", "first", "audits", "paths", "spent", "m"])

    costs = _handed(blocks.select("key", "b", "symbols").mapInArrow(matrices, "key string, b long, m array<long>"), [0] * 4, True)
    known = blocks.join(costs, ["key", "b"]).select("key", "b", "first", "symbols", "vec")
    schema = "key string, b long, first long, audits array<string>, paths array<string>, spent array<long>, m array<long>"
    ranked = materialize(known.mapInArrow(rank, schema), "ranked")
    states = _handed(ranked.select("key", "b", "m"), [0, _INF, _INF, _INF], False)
    entry = F.array_position("vec", F.lit(0).cast("long")).cast("int")
    both = ranked.join(states, ["key", "b"])
    return both.select("key", "b", "first", *[F.element_at(c, entry).alias(n) for c, n in (("audits", "audit"), ("paths", "states"), ("spent", "cost"))])


def _edits(paths: DataFrame) -> DataFrame:
    """(key, b, seq, idx, letter, role) of every edit; ``idx`` is the row's (null for an
    insertion), ``role`` that of an inserted or reroled turn."""

    def steps(batches):
        for batch in batches:
            for key, b, first, audit, states in zip(*(batch.column(c).to_pylist() for c in range(5))):
                letters = np.array(list(audit))
                if not len(letters):
                    continue
                row = letters != "I"
                idx = first + np.cumsum(row) - 1
                role = [_ROLE[int(q)] if l in "IR" else None for l, q in zip(audit, states)]
                columns = [pa.array([key] * len(letters)), pa.array([b] * len(letters), pa.int64()), pa.array(np.arange(len(letters), dtype=np.int32))]
                columns += [pa.array(idx, pa.int64(), mask=~row), pa.array(list(audit)), pa.array(role, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "b", "seq", "idx", "letter", "role"])

    return paths.select("key", "b", "first", "audit", "states").mapInArrow(steps, "key string, b long, seq int, idx long, letter string, role string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, turns) of conversations (conv_id, turn, role, text). ``report`` has per key
    of ``conversation_key`` the faults, cost and audit; ``turns`` (key, b, seq, role, text)
    are the repaired turns in order of (b, seq)."""
    known = materialize(faults(rows), "faults")
    blocks = materialize(_blocks(known), "symbols")
    paths = materialize(_paths(blocks), "paths")
    counts = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    report = known.groupBy("key").agg(gaps.alias("gaps"), *counts)
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", "audit"))), lambda x: x["audit"]), "")
    report = report.join(_illegal(blocks), "key").join(paths.groupBy("key").agg(F.sum("cost").alias("cost"), audit.alias("audit")), "key")
    edits = _edits(paths).filter("letter <> 'D'")
    kept = known.select("idx", F.col("role").alias("own"), "text")
    turns = edits.join(kept, "idx", "left")
    return report, turns.select("key", "b", "seq", F.coalesce("role", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with the faults of the query's contract: by crc32 of
    ``conv_id:turn`` modulo 20, a row is dropped (0), emptied (1), loses its sentence ends
    (2), comes twice (3) or becomes a user turn (4). Nulls are one space."""
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(named.cast("binary")) % 20).alias("m"))
    m, text = F.col("m"), F.col("text")
    rows = rows.filter("m <> 0").withColumn("n", F.explode(F.when(m == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select("conv_id", "turn", F.when(m == 4, "user").otherwise(F.col("role")).alias("role"), F.when(m == 1, "").when(m == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))


def repair_report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """The report for every conv_id of ``original``, repaired from ``rows``, with the digest
    of its repaired turns (role:text, newline-joined)."""
    report, turns = repair(rows)
    line = F.transform(F.sort_array(F.collect_list(F.struct("b", "seq", F.concat("role", F.lit(":"), "text").alias("line")))), lambda x: x["line"])
    digests = turns.groupBy("key").agg(F.sha2(F.array_join(line, "\n"), 256).alias("digest"))
    conv = F.col("conv_id")
    ids = original.select("conv_id").distinct().withColumn("key", F.when(conv.isNull(), "null").otherwise(F.concat(F.lit("="), conv.cast("string"))))
    out = ids.join(report, "key", "left").join(digests, "key", "left")
    numbers = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", empty).alias("repaired_sha256"))
