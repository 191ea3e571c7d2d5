"""Operator 8: quality classifier with hierarchical empirical Bayes over sites.

1. A logistic model of word features and text statistics is fitted on the driver to
   a bounded sample of labelled rows (``LABELLED_ROWS`` at most, drawn by id hash);
   a document is good when its quality is 1 and it is not toxic.
2. Every document gets that model's probability (one pass, no shuffle of texts).
3. Grouped aggregates give the mean probability per host and per path of a host.
   The spread of host means around the global mean, and of path means around their
   host's, beyond what their sizes explain, gives the prior strengths (moments).
4. A path's rate is shrunk to its host's, which is shrunk to the global rate, so a
   sparse site counts as the prior. A document's own probability is taken out of its
   site's sums before they judge it.
5. The posterior log odds are the document's evidence plus the log odds of its path.

Edge cases: null texts are scored as empty; null hosts or paths are a site of their
own; with no labelled row, or labels of one kind only, every document keeps the
neutral evidence and stays; equal rows are judged alike; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import materialize, only_cache, slices

#: Bound of the labelled sample.
LABELLED_ROWS = 5000
BUCKETS = 1 << 18
PREFIXES = (4, 5)
#: A bucket is a feature when its share differs between good and other documents by
#: this many standard errors.
SIGNIFICANT = 4.5
#: Steps of the text statistics that are shares.
SHARE_EDGES = (0.05, 0.2, 0.4, 0.7)
STATISTICS = 4 + 8 * (1 + len(SHARE_EDGES))
EPOCHS = 12
LEARNING_RATE = 0.1
DECAY = 1e-3
#: A document goes when its posterior probability of being good is below this.
THRESHOLD = 0.5
CACHED_WORDS = 300_000
_WORDS = regex.compile(r"\p{L}+")
_SYMBOLS = regex.compile(r"[#*$%&<>|]")


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) & (BUCKETS - 1)


class _Buckets(dict):
    """Buckets of a word and of its prefixes of 4 and 5 letters."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        names = [word, *[f"{word[:k]}-" for k in PREFIXES if len(word) >= k]]
        b = self[word] = tuple(map(_bucket, names))
        return b


_BUCKETS = _Buckets()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets and text statistics of a whole text."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    letters = _WORDS.findall(text.lower())
    lines = [x for x in text.split("\n") if x.strip()]
    symbols = len(_SYMBOLS.findall(text))
    pipes = text.count("|")
    upper = sum(map(str.isupper, words))
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    shares = [
        min((symbols - pipes) / n, 1.0),
        min(pipes / n, 1.0),
        min(text.count("!") / n, 1.0),
        upper / n,
        1 - len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        again,
        sum(1 for w in words if w[0].isdigit()) / n,
    ]
    # a share counts as it is and by the steps it passes
    steps = [float(x > edge) for x in shares for edge in SHARE_EDGES]
    stats = np.array([1.0, min(np.log1p(len(words)) / 8, 2.0), float(len(words) < 10), min(sum(map(len, words)) / n / 10, 3.0), *shares, *steps])
    buckets = set()
    for word in set(letters):
        buckets.update(_BUCKETS[word])
    found = np.fromiter(buckets, np.int32, len(buckets))
    return found, stats


def fit(rows: list[tuple[str | None, int]]) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Weights of word buckets and statistics, and the share of good rows, by
    adaptive gradient steps over shuffled mini-batches (fixed seed)."""
    good = sum(y for _, y in rows)
    if not rows or good in (0, len(rows)):
        return None
    feats = [features(t) for t, _ in rows]
    _BUCKETS.clear()  # the driver keeps no word cache
    y = np.array([v for _, v in rows], float)
    in_good, in_rest = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for (f, _), v in zip(feats, y):
        (in_good if v else in_rest)[f] += 1
    rest = len(rows) - good
    share = (in_good + in_rest) / len(rows)
    error = np.sqrt(np.maximum(share * (1 - share), 1 / len(rows)) * (1 / good + 1 / rest))
    rare = np.abs(in_good / good - in_rest / rest) < SIGNIFICANT * error
    words = np.zeros(BUCKETS)
    stats = np.zeros(STATISTICS)
    gw, gs = np.full(BUCKETS, 1e-2), np.full(STATISTICS, 1e-2)
    dense = np.array([s for _, s in feats])
    kept = [f[~rare[f]] for f, _ in feats]
    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            flat = np.concatenate([kept[i] for i in part])
            size = np.array([len(kept[i]) for i in part])
            owner = np.repeat(np.arange(len(part)), size)
            z = np.bincount(owner, words[flat], len(part)) + dense[part] @ stats
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]
            flat_buckets = np.unique(flat)
            g = np.bincount(flat, error[owner], BUCKETS)[flat_buckets] + DECAY * words[flat_buckets]
            gw[flat_buckets] += g * g
            words[flat_buckets] -= LEARNING_RATE * g / np.sqrt(gw[flat_buckets])
            g = error @ dense[part] + DECAY * stats
            gs += g * g
            stats -= LEARNING_RATE * g / np.sqrt(gs)
    words[rare] = 0
    return words, stats, good / len(rows)


def probability(model, text: str | None) -> float:
    if model is None:
        return 0.5
    words, stats, _ = model
    f, s = features(text)
    z = words[f].sum() + s @ stats
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED_ROWS):
    """Fit on at most ``rows`` labelled documents, the ones with the smallest id hash."""
    good = (F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    picked = labels.select(labels[id_col].alias("id"), good.cast("int").alias("y")).filter("id is not null").orderBy(F.xxhash64("id"), "y").limit(rows)
    # at most ``rows`` ids: a proven bound for the broadcast and the collect
    sample = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).join(F.broadcast(picked), "id").orderBy(F.xxhash64("id"), "text").limit(rows)
    return fit([(r["text"], r["y"]) for r in sample.collect()])


def evidence(docs: DataFrame, model, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, host, path, p): the classifier's probability of every document."""

    def run(batches):
        only_cache("word buckets", _BUCKETS)
        for batch in slices(batches):
            p = [probability(model, x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(p, pa.float64())], names=["id", "host", "path", "p"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(docs[id_col].alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, host string, path string, p double")


def _strength(pi: float, n: float, squares: float, between: float, groups: int) -> float:
    """Prior strength (pseudo documents) from the weighted spread of group means."""
    noise = pi * (1 - pi)
    spread = (between - max(0, groups - 1) * noise) / max(n - squares / max(n, 1), 1e-9)
    return min(max(noise / max(spread, 1e-9) - 1, 1.0), 1e6)


def posteriors(scored: DataFrame, prior: float) -> DataFrame:
    """``scored`` with host_rate, path_rate, posterior and kept."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy(F.col("host").alias("h_host")).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    top = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.sum(F.col("hn") * F.col("hn")).alias("sq"), F.count(F.lit(1)).alias("g"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("q")).first()
    if not top["n"]:
        return scored.select("*", *[F.lit(None).cast("double").alias(c) for c in ("host_rate", "path_rate", "posterior")], F.lit(True).alias("kept"))
    pi = min(max(top["s"] / top["n"], 1e-6), 1 - 1e-6)
    k_host = _strength(pi, top["n"], top["sq"], top["q"] - top["s"] ** 2 / top["n"], top["g"])
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("h_host")))
    low = sites.agg(F.sum(F.col("n") * F.col("n")).alias("sq"), F.count(F.lit(1)).alias("g"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("hs") / F.col("hn"), F.lit(2))).alias("q")).first()
    k_path = _strength(pi, top["n"], low["sq"], low["q"], low["g"] - top["g"] + 1)
    sites = sites.select(F.col("host").alias("s_host"), F.col("path").alias("s_path"), "n", "s", "hn", "hs")
    # the document's own probability leaves its site's sums
    host_rate = (F.lit(k_host * pi) + F.col("hs") - F.col("p")) / (F.lit(k_host) + F.col("hn") - 1)
    rates = scored.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path"))).withColumn("host_rate", host_rate)
    path_rate = (F.lit(k_path) * F.col("host_rate") + F.col("s") - F.col("p")) / (F.lit(k_path) + F.col("n") - 1)
    rates = rates.withColumn("path_rate", F.least(F.greatest(path_rate, F.lit(1e-6)), F.lit(1 - 1e-6)))
    odds = lambda c: F.log(c / (1 - c))
    p = F.least(F.greatest(F.col("p"), F.lit(1e-9)), F.lit(1 - 1e-9))
    z = odds(p) - F.lit(float(np.log(prior / (1 - prior)))) + odds(F.col("path_rate"))
    out = rates.withColumn("posterior", 1 / (1 + F.exp(-z)))
    return out.select("id", "host", "path", "p", "host_rate", "path_rate", "posterior", (F.col("posterior") >= THRESHOLD).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, host, path, p, host_rate, path_rate, posterior, kept) of every document."""
    model = train(docs, labels, id_col, text_col)
    scored = materialize(evidence(docs, model, host, path, id_col, text_col), "evidence")
    out = posteriors(scored, model[2] if model else 0.5)
    if model is None:
        out = out.withColumn("kept", F.lit(True))
    return out.withColumnRenamed("id", id_col)
