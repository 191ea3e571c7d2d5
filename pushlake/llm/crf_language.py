"""Operator 9: language identification by a linear-chain conditional random field.

Every word of a text is labelled: affix, character n-gram, lexicon and shape
features give its scores per language, learned transitions tie neighbours, and
forward-backward gives the probability of each language at each word, so
code-switched texts get a language per word. A text's language is the one with the
largest mean probability.

The field is fitted on the driver to a bounded sample: ``PIECES_PER_LANGUAGE`` pieces of
``PIECE_CHARS`` characters a language, drawn by a hash of id, text and place from all of
every text, by gradient steps on the conditional likelihood; training sequences join
stretches of different pieces, so the transitions are learned from real word sequences
with known switch points. Scoring is one pass over the texts without a shuffle. Long
texts are cut into segments that advance together: a product of small matrices carries
the messages over each segment, so the result is that of the whole chain.

Edge cases: null texts, and texts without a letter, are ``und`` with score 0; with
no labelled row all texts are ``und``; with one language all texts with a letter get
it; equal rows get equal labels; null and repeated ids draw by their texts; very long
texts are labelled whole, and a run of more than ``WORD_CHARS`` letters as consecutive
words of that length; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pushlake.llm._util import crc_remainder, only_cache, slices
from pushlake.llm._words import mix

#: Bound of the fit: pieces a language, and characters of a piece.
PIECES_PER_LANGUAGE = 2000
PIECE_CHARS = 600
WORD_CHARS = 64
BUCKETS = 1 << 16
LEXICON_COUNT = 3
STRETCH = (3, 20)
SEQUENCE = 32
BATCH = 64
EPOCHS = 2
LEARNING_RATE = 0.5
BLOCK_WORDS = 200_000
#: Words of a text that advance one by one; longer texts are segments.
SEGMENT = 256
#: Rows of a batch that advance together.
SLICE_ROWS = 3000
CACHED_WORDS = 250_000
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 5, 0
UNDETERMINED = "und"
_WORDS = regex.compile(r"\p{L}{1,%d}" % WORD_CHARS)
_FIXED = 8  # features that every word has
_LEXICON = 6


def words(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def _bucket(tag: int, *codes: np.ndarray) -> np.ndarray:
    h = np.full(len(codes[0]), tag, np.uint64)
    for c in codes:
        h = h * np.uint64(0x100000001B3) + c
    return (mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_features(ws: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets of words: (words x 8) prefixes and suffixes of one to three letters,
    the word itself (lexicon) and its length; and its 2- and 3-grams with border marks,
    end to end, with their number for each word."""
    marked = "".join([f"^{w}$" for w in ws])
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, ws), np.int64, len(ws))
    ends = np.cumsum(sizes + 2)
    begin = ends - sizes - 2
    at = lambda i, k: np.where(k < sizes, codes[np.minimum(i, len(codes) - 1)], np.uint64(0))
    fixed = np.empty((len(ws), _FIXED), np.int64)
    head = [at(begin + 1 + k, k) for k in range(3)]
    tail = [at(np.maximum(ends - 2 - k, 0), k) for k in range(3)]
    for k in range(3):
        fixed[:, k] = _bucket(1 + k, *head[: k + 1])
        fixed[:, 3 + k] = _bucket(4 + k, *tail[: k + 1])
    own = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in ws), np.uint64, len(ws))
    fixed[:, _LEXICON] = _bucket(7, own)
    fixed[:, 7] = _bucket(8, np.minimum(sizes, 20).astype(np.uint64))
    # 2-grams start everywhere but at the last mark, 3-grams also not before it
    two, three = np.ones(len(codes), bool), np.ones(len(codes), bool)
    two[ends - 1] = three[ends - 1] = three[ends - 2] = False
    i, j = np.flatnonzero(two), np.flatnonzero(three)
    grams = np.empty(len(i) + len(j), np.int64)
    counts = 2 * sizes + 1  # sizes + 1 and sizes
    first = np.cumsum(counts) - counts
    of = np.searchsorted(ends, i, side="right")
    grams[first[of] + i - begin[of]] = _bucket(9, codes[i], codes[i + 1])
    of = np.searchsorted(ends, j, side="right")
    grams[first[of] + sizes[of] + 1 + j - begin[of]] = _bucket(10, codes[j], codes[j + 1], codes[j + 2])
    return fixed, grams, counts


class Field:
    """Languages, feature weights and transitions."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        n = len(languages)
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.moves = np.zeros((n, n))
        self.start = np.zeros(n)
        self.clear()

    def clear(self) -> None:
        self._at: dict[str, int] = {}
        self._scores = np.zeros((1024, len(self.languages)), np.float32)

    def __getstate__(self):
        return self.languages, self.weights, self.moves, self.start

    def __setstate__(self, state):
        self.languages, self.weights, self.moves, self.start = state
        self.clear()

    def _score(self, new: list[str]) -> None:
        have = len(self._at)
        while have + len(new) > len(self._scores):
            self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
        fixed, grams, counts = word_features(new)
        z = self.weights[fixed].sum(axis=1) + np.add.reduceat(self.weights[grams], np.cumsum(counts) - counts, axis=0)
        z /= np.sqrt(counts + _FIXED)[:, None].astype(np.float32)
        self._scores[have : have + len(new)] = np.exp(z - z.max(axis=1, keepdims=True))
        self._at.update(zip(new, range(have, have + len(new))))

    def potentials(self, ws: list[str]) -> np.ndarray:
        """Scaled emission potentials (words x languages)."""
        if len(self._at) > CACHED_WORDS:
            self.clear()
        known = self._at
        new = [w for w in dict.fromkeys(ws) if w not in known]
        for i in range(0, len(new), 20_000):
            self._score(new[i : i + 20_000])
        return self._scores[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))]


def forward_backward(emit: np.ndarray, lengths: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of sequences laid end to end in ``emit`` (positive potentials)."""
    ends = np.cumsum(lengths)
    parts = -(-lengths // SEGMENT)
    of = np.repeat(np.arange(len(lengths)), parts)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = (ends - lengths)[of] + nth * SEGMENT
    size = np.minimum(ends[of] - begin, SEGMENT)
    before = np.tile(start.astype(emit.dtype), (len(begin), 1))
    after = np.ones((len(begin), emit.shape[1]), emit.dtype)
    _carry(emit, begin, size, np.cumsum(parts) - parts, parts, move, before, after)
    order = np.argsort(-size, kind="stable")
    return _marginals(emit, begin[order], size[order], move, before[order], after[order])


def _carry(emit, begin, size, first, parts, move, before, after) -> None:
    """Fill in the messages before and after each segment of the sequences of several
    ``parts``: a segment is a product of matrices, and these are taken in turn."""
    long = np.flatnonzero(parts > 1)
    if not len(long):
        return
    own = np.concatenate([np.arange(first[i], first[i] + parts[i]) for i in long])
    # diag(e1) move diag(e2) ... diag(ek), scaled; all segments but a last one are full
    product = emit[begin[own]][:, None, :] * np.eye(emit.shape[1], dtype=emit.dtype)
    for t in range(1, SEGMENT):
        on = np.flatnonzero(size[own] > t)
        if not len(on):
            break
        x = (product[on] @ move) * emit[begin[own[on]] + t][:, None, :]
        product[on] = x / x.max(axis=(1, 2), keepdims=True)
    at = 0
    for i in long:
        n, s = parts[i], first[i]
        for k in range(1, n):
            v = before[s + k - 1] @ product[at + k - 1] @ move
            before[s + k] = v / v.sum()
        for k in range(n - 1, 0, -1):
            v = move @ (product[at + k] @ after[s + k])
            after[s + k - 1] = v / v.sum()
        at += n


def _marginals(emit, begin, size, move, before, after) -> np.ndarray:
    """Marginals of segments (``size`` falling) with their messages; all advance one word
    at a time together."""
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left") if longest else []  # segments longer than t
    forward = np.empty_like(emit)
    a = before
    for t in range(longest):
        at = begin[: active[t]] + t
        a = (a[: active[t]] if t == 0 else a[: active[t]] @ move) * emit[at]
        a /= a.sum(axis=1, keepdims=True)
        forward[at] = a
    back = after.copy()
    for t in range(longest - 1, -1, -1):
        live = active[t]
        at = begin[:live] + t
        going = active[t + 1] if t + 1 < longest else 0
        if going:
            b = (back[:going] * emit[begin[:going] + t + 1]) @ move.T
            back[:going] = b / b.sum(axis=1, keepdims=True)
        m = forward[at] * back[:live]
        forward[at] = m / m.sum(axis=1, keepdims=True)
    return forward


def fit(rows: list[tuple[str, str]]) -> Field | None:
    """Fit on (text, language) rows; fixed seed, so equal rows give an equal field."""
    rows = sorted((lang, text) for text, lang in rows if words(text))
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    field = Field(languages)
    n = len(languages)
    rng = np.random.default_rng(5)
    texts = [(languages.index(lang), words(text)) for lang, text in rows]
    flat_words, flat_labels = [], []
    cursor = [0] * len(texts)
    live = list(range(len(texts)))
    # stretches of documents in random order, until the sample is used up
    while live:
        k = int(rng.integers(len(live)))
        i = live[k]
        lang, ws = texts[i]
        size = int(rng.integers(*STRETCH)) * (1 if rng.random() < 0.5 else 4)
        flat_words += ws[cursor[i] : cursor[i] + size]
        flat_labels += [lang] * len(ws[cursor[i] : cursor[i] + size])
        cursor[i] += size
        if cursor[i] >= len(ws):
            live[k] = live[-1]
            live.pop()
    names = {}
    index = np.array([names.setdefault(w, len(names)) for w in flat_words])
    counts = np.bincount(index)
    fixed, grams, sizes = word_features(list(names))
    plain = np.delete(fixed, _LEXICON, axis=1)
    feats = [np.concatenate([fixed[i] if counts[i] >= LEXICON_COUNT else plain[i], g]) for i, g in enumerate(np.split(grams, np.cumsum(sizes)[:-1]))]
    labels = np.array(flat_labels)
    usable = len(index) // SEQUENCE * SEQUENCE
    if not usable:  # a tiny sample: one short sequence
        seqs, seq_labels = index[None, :], labels[None, :]
    else:
        seqs, seq_labels = index[:usable].reshape(-1, SEQUENCE), labels[:usable].reshape(-1, SEQUENCE)
    gw = np.full((BUCKETS, n), 1e-3, np.float32)
    gm, gs = np.full((n, n), 1e-3), np.full(n, 1e-3)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(seqs)), max(1, len(seqs) // BATCH)):
            s, y = seqs[part], seq_labels[part]
            used, back = np.unique(s, return_inverse=True)
            back = back.reshape(s.shape)
            size = np.array([len(feats[u]) for u in used])
            flat = np.concatenate([feats[u] for u in used])
            scale = 1 / np.sqrt(size)
            z = np.add.reduceat(field.weights[flat], np.cumsum(size) - size, axis=0) * scale[:, None]
            emit = np.exp(z - z.max(axis=1, keepdims=True))[back]
            move, start = np.exp(field.moves), np.exp(field.start)
            b, t = s.shape
            fwd = np.empty((t, b, n))
            a = start * emit[:, 0]
            for k in range(t):
                a = a if k == 0 else (a @ move) * emit[:, k]
                a = a / a.sum(axis=1, keepdims=True)
                fwd[k] = a
            beta = np.ones((b, n))
            seen_moves = np.zeros((n, n))
            np.add.at(seen_moves, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            error = np.zeros((b, t, n))
            for k in range(t - 1, -1, -1):
                m = fwd[k] * beta
                error[:, k] = m / m.sum(axis=1, keepdims=True)
                if k:
                    right = beta * emit[:, k]
                    pair = fwd[k - 1][:, :, None] * move[None] * right[:, None, :]
                    seen_moves -= (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                    beta = right @ move.T
                    beta /= beta.sum(axis=1, keepdims=True)
            error[np.arange(b)[:, None], np.arange(t)[None, :], y] -= 1
            per_word = np.zeros((len(used), n))
            np.add.at(per_word, back.ravel(), error.reshape(-1, n))
            rows_, inverse = np.unique(flat, return_inverse=True)
            g = np.zeros((len(rows_), n))
            np.add.at(g, inverse, np.repeat(per_word * scale[:, None], size, axis=0))
            gw[rows_] += g * g
            field.weights[rows_] -= LEARNING_RATE * g / np.sqrt(gw[rows_])
            gm += seen_moves * seen_moves
            field.moves += LEARNING_RATE * seen_moves / np.sqrt(gm)
            g = error[:, 0].sum(axis=0)
            gs += g * g
            field.start -= LEARNING_RATE * g / np.sqrt(gs)
    field.clear()
    return field


def sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """(text, lang): the drawn pieces of the rows with a language. Every piece of every text
    has a draw, a hash of id, text and place; those of the PIECES_PER_LANGUAGE least
    draws of a language are taken, so equal tables give equal samples."""
    known = docs.select(F.xxhash64(docs[id_col], docs[text_col]).alias("h"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    known = known.filter("lang is not null and length(text) > 0")
    pieces = F.ceil(F.length("text") / PIECE_CHARS).cast("long")
    totals = known.groupBy("lang").agg(F.sum(pieces).alias("total"))  # one row per language
    draw = lambda k: F.pmod(F.xxhash64("h", k), F.lit(1 << 40))
    # twice as many as needed are drawn, then the least of them are ranked
    bound = F.when(F.col("total") <= 2 * PIECES_PER_LANGUAGE, F.lit(1 << 40)).otherwise(F.lit((1 << 40) * 2 * PIECES_PER_LANGUAGE) / F.col("total"))
    drawn = known.join(F.broadcast(totals), "lang").withColumn("bound", bound)
    drawn = drawn.select("lang", "text", "h", F.explode(F.filter(F.sequence(F.lit(0).cast("long"), pieces - 1), lambda k: draw(k) < F.col("bound"))).alias("k"))
    drawn = drawn.select("lang", draw(F.col("k")).alias("draw"), "h", "k", F.expr(f"substring(text, cast(k * {PIECE_CHARS} as int) + 1, {PIECE_CHARS})").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "h", "k", "text"))
    return drawn.withColumn("rank", rank).filter(F.col("rank") <= PIECES_PER_LANGUAGE).select("text", "lang")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Field | None:
    """Fit on the sample, of bounded size in bytes."""
    return fit([(r["text"], r["lang"]) for r in sample(docs, text_col, lang_col, id_col).collect()])


def label_texts(field: Field | None, texts: list) -> list[tuple[str, float, np.ndarray, list[str]]]:
    """(language, score, marginals, words) of each text."""
    out: list = [(UNDETERMINED, 0.0, np.empty((0, 0)), [])] * len(texts)
    if field is None:
        return out
    tokens = [words(x) for x in texts]
    order = sorted((i for i in range(len(texts)) if tokens[i]), key=lambda i: -len(tokens[i]))
    move, start = np.exp(field.moves).astype(np.float32), np.exp(field.start).astype(np.float32)
    at = 0
    while at < len(order):
        part, n = [], 0
        while at < len(order) and (not part or n + len(tokens[order[at]]) <= BLOCK_WORDS):
            part.append(order[at])
            n += len(tokens[order[at]])
            at += 1
        lengths = np.array([len(tokens[i]) for i in part])
        emit = field.potentials([w for i in part for w in tokens[i]]) + np.float32(1e-12)
        marginals = forward_backward(emit, lengths, move, start)
        begin = np.cumsum(lengths) - lengths
        mean = np.add.reduceat(marginals, begin, axis=0) / lengths[:, None]
        best = mean.argmax(axis=1)
        for k, i in enumerate(part):
            score = float(min(max(mean[k, best[k]], 0.0), 1.0))
            out[i] = (field.languages[best[k]], score, marginals[begin[k] : begin[k] + lengths[k]], tokens[i])
    return out


def identify(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_words, n_switches) of every text; reads the text only."""

    def run(batches):
        if field is not None:
            only_cache("word potentials", field)
        for batch in slices(batches, SLICE_ROWS):
            got = label_texts(field, batch.column(1).to_pylist())
            best = [m.argmax(axis=1) if len(m) else np.empty(0, int) for _, _, m, _ in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([len(g[3]) for g in got], pa.int64()), pa.array([int((b[1:] != b[:-1]).sum()) for b in best], pa.int64())],
                names=["id", "lang_pred", "score", "n_words", "n_switches"],
            )

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, n_words long, n_switches long").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(crc_remainder(id_col, HELD_OUT_MODULUS) == HELD_OUT_REMAINDER, F.lit(False))


def train_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict all rows."""
    field = train(docs.filter(~held_out(id_col)), text_col, lang_col, id_col)
    return identify(docs, field, id_col, text_col).withColumn("held_out", held_out(id_col))
