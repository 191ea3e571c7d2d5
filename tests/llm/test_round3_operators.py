"""Collocations, repeated byte strings and conversation repair against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pushlake.llm import collocations, conversation_repair, queries, suffix_dedup
from tests.conftest import SF_SMALL

# 11 -----------------------------------------------------------------------------


def brute_collocations(rows, min_count, top):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        often = {p: v for p, v in c.items() if v >= min_count}
        inside = {q[i:j] for q, v in often.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and often[q[i:j]] == v}
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in inside:
                score, _, left, right = min((1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k, often[p[:k]], often[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrases(spark):
    rnd = random.Random(5)
    words = ["a", "B", "cat", "dog", "é", "x-y", "z", "İq", "w8", "the"]
    text = lambda: " ".join(rnd.choice(words[: rnd.randrange(2, 10)]) + rnd.choice(["", "", "", "", ".", ",", "\n", "\t"]) for _ in range(rnd.randrange(60)))
    rows = [(rnd.choice(["en", "fr", None]), text()) for _ in range(150)] + [("en", None), ("en", ""), ("fr", "x" * 5000), ("de", "so it is " * 3000)]
    # extra columns with names that the operator uses itself; a null and repeated ids
    return rows, spark.createDataFrame([(i // 2 or None, t, lang, "k", 3) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int")


@pytest.mark.parametrize("min_count,top,sample", [(10, 40, 0.3), (10, 2000, 0.02), (10, 2001, 0)])
def test_collocations(phrases, min_count, top, sample, monkeypatch):
    """The second sample is so small that its border fails, the third is empty; ranges of
    buckets are split where they are larger than a task takes."""
    monkeypatch.setattr(collocations, "MAX_RANGE", 5 if top == 2000 else collocations.MAX_RANGE)
    monkeypatch.setattr(collocations, "MAX_BORDER", 500)
    rows, df = phrases
    found = collocations.scored(*collocations.frequent_phrases(df, min_count, sample=sample))
    want = brute_collocations(rows, min_count, 10**6)
    assert sorted((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect()) == sorted((x[0], *x[2:]) for x in want)
    if top < 2000:
        got = collocations.top_collocations(df, min_count, top, sample=sample).collect()
        assert sorted(tuple(r) for r in got) == brute_collocations(rows, min_count, top)


def test_collocation_counts_travel_by_range(spark):
    """A task writes a row for each language and range, not for each phrase."""
    rows = [(lang, " ".join(f"w{i % 700}" for i in range(k, k + 2000))) for k, lang in enumerate(["en", "fr", "en"])]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    every = lambda: lambda chunk, n, at, hashes, state: (np.ones(len(at), bool), np.zeros(len(at), bool), np.ones(len(at), bool), None)
    scan = collocations._scan(docs, every, totals=True, bits=3)
    assert scan.count() <= 2 * 2 * 8
    counts = {(r.lang, r.phrase): (r.words, r.n) for r in collocations._counted(scan, 3).collect()}
    assert counts["en", ""] == (0, 4000) and counts["fr", ""] == (0, 2000)
    assert counts["en", "w698 w699 w0"] == (3, 4) and ("fr", "w698 w699 w0") not in counts
    assert all(n >= 3 or not words for words, n in counts.values())


def test_collocation_arithmetic_passes_64_bits(spark):
    rows = [("en", "a", 1, 10**12), ("en", "b", 1, 10**12), ("en", "a b", 2, 10**12 - 1)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 10**13 + 7)], "lang string, total long")
    assert collocations.scored(counts, totals).first().score == 1000 * (10**12 - 1) * (10**13 + 7) // 10**24


def test_collocations_of_nothing(phrases):
    assert collocations.top_collocations(phrases[1].limit(0), 5).collect() == []


# 12 -----------------------------------------------------------------------------


def brute_repeats(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [16, 37])
def test_repeats(spark, length, monkeypatch):
    rnd = random.Random(length)
    base = "".join(rnd.choice("abc d") for _ in range(3000))
    texts = [None, "", "x" * 500, "ab" * 300, base[:100], base[50:180], base[50:180], base, base[1000:1400] + "Q" + base[1401:1800], "é" * 90]
    for _ in range(80):
        cuts = [rnd.randrange(2900) for _ in range(rnd.randrange(1, 12))]
        texts.append("".join(base[a : a + rnd.randrange(5, 90)] + rnd.choice(["", "z", "yy", "é"]) for a in cuts))
    # null and repeated ids; extra columns with names that the operator uses itself
    df = spark.createDataFrame([(i // 2 if i % 17 else None, t, 1, "k", None) for i, t in enumerate(texts)], "doc_id long, text string, th int, spans string, lo string")
    got = [tuple(r)[1:4] + (r.kept_sha256,) for r in suffix_dedup.remove_repeats(df, length).collect()]
    assert sorted(got) == sorted(brute_repeats([(t or "").encode() for t in texts], length))


def test_repeats_of_long_texts_in_pieces(spark):
    """Texts longer than a piece, and a repeat over the border of two pieces."""
    rnd = random.Random(1)
    noise = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    shared = noise(3000)
    head = noise(suffix_dedup.CHUNK - 1000)
    df = spark.createDataFrame([(1, head + shared + noise(2000)), (2, noise(500) + shared)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in suffix_dedup.find_repeats(df).collect()}
    assert [tuple(x) for x in got[2]] == [(500, 3500)]
    assert [tuple(x) for x in got[1]] == [(len(head), len(head) + 3000)]


def test_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeats_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = dict(zip([r.doc_id for r in rows], brute_repeats([(r.text or "").encode() for r in rows], 200)))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_suffix_dedup(spark, SF_SMALL).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 0


# 13 -----------------------------------------------------------------------------


def brute_repair(rows):
    """All cheapest edits of rows (turn, role, text) after damage, in order."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best, found, heap = None, [], [(0, 0, "", "", [])]
    while heap:
        cost, i, audit, roles, lines = heapq.heappop(heap)
        if best is not None and cost > best:
            break
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = cost
            found.append((audit, lines))
        steps = [(5, i, "I", r[0], [f"{r}:"]) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((2, i + 1, "D", "", []))
            if faults[i] not in ("b", "d"):
                more = 5 * (faults[i] == "t")
                steps.append((more, i + 1, "K", role[:1], [f"{role}:{text}"]))
                steps += [(1 + more, i + 1, "R", r[0], [f"{r}:{text}"]) for r in ("user", "assistant")]
        for c, j, letter, initial, line in steps:
            if re.fullmatch("(s?(ua)*u?)?", roles + initial):
                heapq.heappush(heap, (cost + c, j, audit + letter, roles + initial, lines + line))
    audit, lines = min(found)
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, best, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_reports(rows):
    after = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        m = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if m:
            text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
            after.setdefault(conv, []).extend([(turn, "user" if m == 4 else role, text)] * (2 if m == 3 else 1))
    order = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    return {conv: brute_repair(sorted(after.get(conv, []), key=order)) for conv in {r[0] for r in rows}}


def reports(df):
    return {r[0]: tuple(r[1:]) for r in conversation_repair.repair_report(df, conversation_repair.damaged(df)).collect()}


@pytest.mark.parametrize("block,fan", [(1024, 1024), (2, 2)])
def test_repair(spark, block, fan, monkeypatch):
    """Blocks of two rows combine and hand down over several levels."""
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    monkeypatch.setattr(conversation_repair, "FAN", fan)
    rnd = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool"]
    texts = ["Hi.", "Ok!", "no end", "", "  ", None, "a? \n", "x.", "long " * 3000]
    rows = [(c or None, rnd.choice([t, t, t, t + 1, None]), rnd.choice(roles), rnd.choice(texts)) for c in range(40) for t in range(rnd.randrange(1, 6))]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, idx int, key string").repartition(3)
    assert reports(df) == brute_reports(rows)


def test_repair_of_nothing(spark):
    assert reports(spark.createDataFrame([], "conv_id long, turn long, role string, text string")) == {}


def test_repair_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in queries.op13_conversation_repair(spark, SF_SMALL).collect()}
    assert got == brute_reports([tuple(r) for r in rows])


def test_repair_of_a_long_conversation(spark):
    """Legal turns stay, whatever their number; one dropped reply is inserted."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(5000) if t != 3001]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report, turns = conversation_repair.repair(df)
    r = report.first()
    assert (r.cost, r.gaps, r.illegal) == (4, 1, 1) and r.audit.count("D") == 2 or (r.cost == 2)
    assert turns.filter(F.col("role").isin("user", "assistant")).count() % 2 == 0
