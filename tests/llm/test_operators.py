"""Each operator against a brute-force version or an exact round trip, on edge rows
(null, empty, very long, tied and repeated rows, clashing extra columns, empty
tables) and on sf0.001."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pushlake.llm import bpe_stream, chat_format, components, crf_language, decontam, near_dup, ngram_lm, pii, quality_rules, queries, site_quality, token_counts
from tests.conftest import SF_SMALL

SPECIAL = "a<|endoftext|>b <|startoftext|> c"
PII_TEXT = "mail a.b@c.example.org, 10.0.0.256 10.1.2.3 or 4111 1111 1111 1111 or +1 (212) 555-0123 Dr. Jane Roe token = \"0123456789abcdef01\"."
EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one two three"),
    (5, "one two three"),
    (6, "A b C d E f G h I j K"),
    (7, "x" * 30000),
    (8, "word " * 4000),
    (9, "line one here\nline one here\n\nother ### $$$ | line\nline one here"),
    (10, "żółć 日本語 Ünï \U0001f600 é İ ΑΣ"),
    (11, SPECIAL),
    (12, PII_TEXT),
    (13, "1.2.3.4.5 " + "9" * 200 + " a@b.c.d@e.f +" + "1" * 40),
    (14, "the cat sat on the mat and the cat sat on the mat again today"),
    (15, "\u0085nbsp joined words\x1cstay"),
    (16, "1.1.1.1 " * 700),
]
WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def edge(spark):
    # extra columns with names that operators use themselves
    rows = [(i, t, "x", 1, 2.0, "k") for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n int, kept double, key string")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def lower_words(text):
    return (text or "").encode().lower().split()


# 1 and 10 -----------------------------------------------------------------------


def library(name):
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.vocabulary_path(name))


def test_round_trip_matches_the_library(spark, edge, docs):
    lib = library(queries.BYTE_VOCABULARY)
    for got, texts in ((bpe_stream.round_trip(edge, queries.vocabulary_path(queries.BYTE_VOCABULARY)), dict(EDGE)), (queries.op1_bpe_round_trip(spark, SF_SMALL), {d: r.text for d, r in docs.items()})):
        got = by_id(got)
        assert got.keys() == texts.keys()
        for d, text in texts.items():
            ids = lib.encode(text or "", add_special_tokens=False).ids
            assert got[d].n_tokens == len(ids), d
            assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert got[d].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_windows_of_the_transducer_are_exact():
    t = bpe_stream.Transducer(open(queries.vocabulary_path(queries.BYTE_VOCABULARY), "rb").read())
    lib = library(queries.BYTE_VOCABULARY)
    assert 0 < t.lookahead < 1000
    t.window = 4 * t.lookahead
    for text in ("ab" * 4000, "thethe" * 2000, "interinternationalization" * 400, "a" * 9001, "日本" * 3000, " " * 5000 + "x"):
        assert [i for part in t.encode(text) for i in part] == lib.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_tables(spark, edge):
    path = queries.vocabulary_path(queries.BYTE_VOCABULARY)
    back = {r["id"]: r["text"] for r in bpe_stream.decode_ids(bpe_stream.encode_documents(edge, path), path).collect()}
    assert back == {i: t or "" for i, t in EDGE}


def test_token_counts_match_the_library(spark, edge, docs):
    lib = library(queries.WORD_VOCABULARY)
    for got, texts in ((token_counts.count_tokens(edge, queries.vocabulary_path(queries.WORD_VOCABULARY), 100), dict(EDGE)), (queries.op10_token_counts(spark, SF_SMALL), {d: r.text for d, r in docs.items()})):
        for r in got.collect():
            text = texts[r.doc_id] or ""
            assert r.n_tokens == len(lib.encode(text, add_special_tokens=False).ids), r.doc_id
            assert r.n_bytes == len(text.encode())


# 2 ------------------------------------------------------------------------------


def test_decontamination(spark):
    item = "it was a long winter and the river froze twice before the first ships came back to the old harbour of the town"
    pad = "zq wv xk " * 30
    edited = item.replace("river", "lake")
    texts = [(1, pad + item + pad), (2, pad + item.upper().replace(" ", "\n ") + pad), (3, pad + edited + pad), (4, pad), (5, None), (6, item[:50] + pad + item[50:]), (7, ""), (8, pad + item + pad), (9, item[5:95])]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (2, "short item"), (3, None), (4, "aaaa " * 30)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(d, b).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (8, 1), (9, 1)}
    assert got[1, 1].edits == 0 and texts[0][1][got[1, 1].start : got[1, 1].end] == item
    assert decontam.find_leaks(d.limit(0), b).count() == 0
    assert decontam.find_leaks(d, b.limit(0)).count() == 0


def test_decontamination_blocks_of_the_benchmark(spark, monkeypatch):
    whole = {tuple(r) for r in queries.op2_decontaminate(spark, SF_SMALL).collect()}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 3000)
    assert {tuple(r) for r in queries.op2_decontaminate(spark, SF_SMALL).collect()} == whole
    texts = {r.doc_id: " ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r.item_id: " ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert exact <= {r[:2] for r in whole}


def fewest_edits(pattern, text):
    """Edits of ``pattern`` against its best place in ``text``."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        best = np.minimum(row[:-1] + np.array([c != x for x in text], bool), row[1:] + 1)
        for j in range(1, len(row)):
            new[j] = min(best[j - 1], new[j - 1] + 1)
        row = new
    return int(row.min())


def leaked(item, text):
    """Independent of q-grams: every window of the item against every place."""
    item, text = (" ".join(x.lower().split()) for x in (item, text or ""))
    if not item or not text:
        return False
    if len(item) < 12:
        return f" {item} " in f" {text} "
    w = min(80, len(item))
    budget = max(0, min(w * 5 // 80, (w - 12) // 12))
    return any(fewest_edits(item[i : i + w], text) <= budget for i in range(len(item) - w + 1))


def test_leaks_against_alignment(spark):
    """Items of all lengths, copied with edits up to and beyond their budgets."""
    rnd = random.Random(8)
    prose = lambda n: "".join(rnd.choices("abcdefgh  ", k=n))
    items = [(str(i), ("q" + prose(n) + "z")[:n]) for i, n in enumerate([3, 11, 12, 20, 24, 33, 35, 36, 60, 80, 84])] + [("99", None), ("98", "")]
    items.append(("same", items[3][1]))

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            at = rnd.randrange(len(text))
            text[at : at + 1] = rnd.choice([[], ["x"], [text[at], "y"]])
        return "".join(text)

    docs = [(None, None), (0, "")]
    for _, t in items[:11]:
        docs += [(len(docs), prose(20) + " " + edited(t, n) + " " + prose(30)) for n in (0, 1, 2, 3)]
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, item int, id string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(table, bench).collect()}
    want = {(d, i) for d, t in docs for i, x in items if leaked(x or "", t)}
    assert got == want and len(want) > 10


# 3 ------------------------------------------------------------------------------


def quality(text):
    text = text or ""
    ws = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    failed = len(ws) < 10 or 100 * len(covered) > 20 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(spark, edge, docs):
    for got, texts in ((quality_rules.apply_rules(edge.drop("kept")), dict(EDGE)), (queries.op3_quality_rules(spark, SF_SMALL), {d: r.text for d, r in docs.items()})):
        got = got.select("*", *(["_quality.*"] if "_quality" in got.columns else []))
        for r in got.collect():
            r = r.asDict()
            want = quality(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want, r["doc_id"]
            assert not (r["base_failed"] and r["kept"])
            assert r["kept"] == (r["failed_rule"] is None)
    assert quality_rules.apply_rules(edge.drop("kept").limit(0)).count() == 0


def test_rule_order_and_clashing_columns(spark, edge):
    """Equal tables give equal orders, ties go by name; columns named as results give way."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = F.col("text")
    measured = quality_rules._measured(quality_rules.planning_sample(docs, 50), text).cache()
    rules = [(n, f(F.col("_quality")), w) for n, f, w in quality_rules.extra_rules(text)]
    orders = {tuple(quality_rules.order_rules(x, rules)) for x in (measured, measured.repartition(5), measured)}
    assert len(orders) == 1
    never = [(n, F.lit(False), F.lit(1)) for n in ("b", "a", "c")]
    assert quality_rules.order_rules(measured, never) == ["a", "b", "c"]
    clash = edge.withColumns({c: F.lit("mine") for c in quality_rules.RESULTS})
    plain = quality_rules.apply_rules(edge.drop("kept"))
    got = quality_rules.apply_rules(clash)
    columns = ["doc_id", "id", "n", "key", "base_failed", "kept", "_quality.n_words"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))


def test_rules_are_ordered_by_rejections_per_cost(spark):
    sample = spark.range(1000).withColumn("t", F.col("id").cast("string"))
    slow = F.sha2(F.sha2(F.repeat("t", 2000), 512), 512) == "x"
    order = quality_rules.order_rules(sample, [("slow", slow), ("never", F.col("id") < 0), ("most", F.col("id") > 100)])
    assert order[0] == "most"


# 4 ------------------------------------------------------------------------------


def shingle_set(text):
    ws = lower_words(text)
    return frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])


def exact_components(texts):
    sets = {d: shingle_set(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_duplicates(spark, edge, docs):
    for got, texts in ((near_dup.near_duplicates(edge), dict(EDGE)), (queries.op4_near_dup(spark, SF_SMALL), {d: r.text for d, r in docs.items()})):
        want = exact_components(texts)
        got = by_id(got)
        assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
        assert all(r.kept == (d == r.component_id) for d, r in got.items())
    assert near_dup.near_duplicates(edge.limit(0)).count() == 0


def test_near_duplicates_in_one_large_group(spark, monkeypatch):
    """Hundreds of near copies (no two equal) and unrelated texts that share a passage:
    large nodes branch, contract and are compared across components."""
    monkeypatch.setattr(near_dup, "LEAF", 8)
    base = [f"w{i}" for i in range(200)]
    texts = {}
    for i in range(300):
        ws = list(base)
        ws[i % 200], ws[(7 * i + 3) % 200] = f"x{i}", f"y{i}"
        texts[i] = " ".join(ws)
    for i in range(300, 420):
        texts[i] = " ".join(base[:60] + [f"z{i}_{k}" for k in range(140)])
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(near_dup.near_duplicates(d))
    assert {x: (r.n_shingles, r.component_id) for x, r in got.items()} == exact_components(texts)


def test_near_duplicates_of_a_group_at_the_threshold(spark, monkeypatch):
    """Near copies of which many pairs are just under 0.75, and unrelated texts that share
    a passage: neither is branched into many rows or compared pair by pair."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = {}
    for i in range(300):
        ws = list(base)
        for k in range(rng.randint(1, 5)):
            ws[rng.randrange(200)] = f"x{i}_{k}"
        texts[i] = " ".join(ws)
    for i in range(300, 600):
        texts[i] = " ".join([f"p{k}" for k in range(60)] + [f"z{i}_{k}" for k in range(140)])
    made = {"_branch": 0, "_compare": 0}

    def counted(name):
        real = getattr(near_dup, name)

        def run(*args):
            out = real(*args)
            made[name] += out.count()
            return out

        monkeypatch.setattr(near_dup, name, run)

    counted("_branch")
    counted("_compare")
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    assert {x: (r.n_shingles, r.component_id) for x, r in got.items()} == exact_components(texts)
    assert made["_branch"] <= len(texts) and made["_compare"] <= len(texts), made


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    got = {r["id"]: r["component"] for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 5 ------------------------------------------------------------------------------


def test_language_model_against_brute_force(spark, docs):
    got = by_id(queries.op5_lm_scoring(spark, SF_SMALL))
    tokens = {d: [*lower_words(r.text), None] for d, r in docs.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    c, b = Counter(), Counter()
    for d, ws in tokens.items():
        if not held[d]:
            c.update(ws)
            b.update(zip(["start", *ws[:-1]], ws))
    n, v = sum(c.values()), len(c)
    cont = Counter(w for _, w in b)

    def discounts(values):
        k = Counter(x for x in values if x < 5)
        y = k[1] / (k[1] + 2 * k[2])
        return [0, 1 - 2 * y * k[2] / k[1], 2 - 3 * y * k[3] / k[2], 3 - 4 * y * k[4] / k[3]]

    high, low = discounts(b.values()), discounts(cont.values())
    total, mass = Counter(), Counter()
    for (x, _), k in b.items():
        total[x] += k
        mass[x] += high[min(k, 3)]
    uniform = sum(low[min(k, 3)] for k in cont.values()) / len(b)

    def p(x, w):
        one = max(cont[w] - low[min(cont[w], 3)], 0) / len(b) + uniform / (v + 1)
        if not total[x]:
            return one
        k = b.get((x, w), 0)
        return max(k - high[min(k, 3)], 0) / total[x] + mass[x] / total[x] * one

    for d, ws in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(w in c for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(x, w)) for x, w in zip(["start", *ws[:-1]], ws)), rel_tol=1e-6)
    unseen = [d for d in docs if held[d]]
    assert sum(got[d].score for d in unseen) > sum(got[d].base_score for d in unseen)


@pytest.mark.parametrize("shards_of", [4_000_000, 40])
def test_trigram_model_against_brute_force(spark, docs, edge, monkeypatch, shards_of):
    """Order 3; with many small shards, heavy words and hot bigrams are spread."""
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", shards_of)
    some = {d: r.text for d, r in sorted(docs.items())[: 300 if shards_of > 40 else 4]} | {-1: "a b " * 300 + "c a b", -2: "x a b y a b z a b", -3: None, -4: "a"}
    tokens = {d: [*lower_words(t), None] for d, t in some.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in some}
    past = lambda ws: zip(["start", "start", *ws[:-2]], ["start", *ws[:-1]], ws)
    t = Counter(x for d, ws in tokens.items() if not held[d] for x in past(ws))
    b = Counter()
    for (_, x, w), k in t.items():
        b[x, w] += k if x == "start" else 1
    t = {k: n for k, n in t.items() if k[1] != "start"}
    cont = Counter(w for _, w in b)
    v = len(cont)
    levels = {}
    for name, counts in (("t", t), ("b", b), ("c", cont)):
        k = Counter(x for x in counts.values() if x < 5)
        d = [0, *ngram_lm._discounts([k[i] for i in (1, 2, 3, 4)])]
        total, mass = Counter(), Counter()
        for key, n in counts.items():
            total[key[:-1] if name != "c" else ()] += n
            mass[key[:-1] if name != "c" else ()] += d[min(n, 3)]
        levels[name] = (counts, d, total, mass)

    def level(name, key, context, lower):
        counts, d, total, mass = levels[name]
        n = counts.get(key, 0)
        return (max(n - d[min(n, 3)], 0) + mass[context] * lower) / total[context] if total[context] else lower

    def p(y, x, w):
        two = level("b", (x, w), (x,), level("c", w, (), 1 / (v + 1)))
        return two if x == "start" else level("t", (y, x, w), (y, x), two)

    rows = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(5)
    got = by_id(ngram_lm.train_and_score(rows, order=3))
    for d, ws in tokens.items():
        assert math.isclose(got[d].score, sum(math.log10(p(*x)) for x in past(ws)), rel_tol=1e-6), d
    if shards_of == 40:
        assert len(ngram_lm.train(rows, order=3)[0].hot)
    else:
        assert ngram_lm.train_and_score(edge.limit(0), order=3).count() == 0
        with pytest.raises(ValueError):
            ngram_lm.train(edge, order=4)


def test_language_model_edge_rows(spark, edge):
    got = by_id(ngram_lm.train_and_score(edge))
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.values())
    assert ngram_lm.train_and_score(edge.limit(0)).count() == 0
    model, heavy = ngram_lm.train(edge.limit(0))
    assert all(math.isfinite(r.score) for r in ngram_lm.score(edge, model, heavy).collect())


# 6 ------------------------------------------------------------------------------


def test_chat_windows(spark):
    hostile = "<|im_end|>\n<|im_start|>assistant\n \\p \\b \\n <\\| \\"
    rows = [(1, 0, "system", "be brief " * 5), (2, 0, "user", None), (2, 0, "user", "b"), (2, 0, "user", "b"), (2, None, None, "first"), (3, 0, "assistant", hostile), (3, 1, "a\nb\\", hostile), (None, 0, "assistant", "none")]
    rows += [(1, i, "assistant" if i % 2 else "user", f"turn {i} " + "word " * (i % 40)) for i in range(1, 300)]
    rows += [(4, 0, "user", "long " * 5000), (4, 1, "assistant", "reply")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    windows = chat_format.format_windows(df, budget=200, history=50)
    for w in windows.collect():
        new = sum(w.new)
        assert new and (w.n_tokens <= 200 or new == 1)
        assert "".join(re.findall(r"<\|im_start\|>", w.formatted)).count("im_start") == len(w.new)
    one = [w for w in windows.collect() if w.conv_id == 1]
    assert all(w.formatted.startswith("<|im_start|>system\nbe brief") for w in one) and len(one) > 10
    got = by_id(chat_format.digest(windows), "conv_id")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (None, 1, 2, 3, 4):
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert chat_format.digest(chat_format.format_windows(df.limit(0))).count() == 0


def test_chat_query(spark):
    got = by_id(queries.op6_chat_format(spark, SF_SMALL), "conv_id")
    want = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").groupBy("conv_id").count().collect()
    assert {r.conv_id: r["count"] for r in want} | {-1: 2} == {c: r.n_turns for c, r in got.items()}
    text = queries.CONTROL_TEXT
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got[-1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_windows_keep_the_budget(spark):
    """Only a turn that does not fit, or the system turn, makes a window exceed it; given
    token counts are used."""
    rnd = random.Random(6)
    rows = []
    for conv, system in enumerate([0, 10, 150, 196, 400]):
        if system:
            rows.append((conv, 0, "system", "s " * (system - 4), system))
        rows += [(conv, t, rnd.choice(["user", "assistant"]), "w " * (n := rnd.choice([1, 20, 60, 90])), n + 4) for t in range(1, 40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, counted long")
    for tokens in (None, "counted"):
        windows = chat_format.format_windows(df, 200, 64, tokens).collect()
        for w in windows:
            system = [0, 10, 150, 196, 400][w.conv_id]
            assert w.n_tokens <= 200 or w.new.count(True) == 1 and (system >= 100 or w.n_tokens <= system + 64 + 94), (w.conv_id, w.n_tokens)
        small = [w for w in windows if [0, 10, 150, 196, 400][w.conv_id] <= 10]
        assert all(w.n_tokens <= 200 for w in small)
        got = {r.conv_id: r.n_turns for r in chat_format.digest(chat_format.format_windows(df, 200, 64, tokens)).collect()}
        assert got == Counter(r[0] for r in rows)


# 7 ------------------------------------------------------------------------------


def luhn(digits):
    odd = [int(x) for x in digits[::-1][::2]]
    even = [2 * int(x) for x in digits[::-1][1::2]]
    return (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0


def base_pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    spans = [(m.start(), i, kind, m.end()) for i, (kind, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m.group())]
    counts = [sum(s[2] == k for s in spans) for k, _, _ in kinds]
    return (*counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)).encode()).hexdigest()), sorted(spans)


def test_pii(spark, edge, docs):
    for got, texts in ((pii.digest(pii.find_pii(edge)), dict(EDGE)), (queries.op7_pii(spark, SF_SMALL), {d: r.text for d, r in docs.items()})):
        for r in got.collect():
            want, spans = base_pii(texts[r.doc_id])
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want, r.doc_id
            found = set(r.spans.split(",")) if r.spans else set()
            assert {f"{k}:{a}:{b}" for a, _, k, b in spans} <= found
    assert pii.digest(pii.find_pii(edge.limit(0))).count() == 0


def test_pii_redaction(spark, edge):
    got = by_id(pii.redact(edge))
    assert got[1].text is None or got[1].text == ""
    assert got[4].text == "one two three" and got[4].key == "k"
    assert "[EMAIL]" in got[12].text and "[IP]" in got[12].text and "[CARD]" in got[12].text and "10.0.0.256" in got[12].text
    assert got[16].text.count("[IP]") == 700
    assert pii.redact(edge).columns == edge.columns


def test_pii_redaction_of_nested_spans(spark):
    """A span inside a longer one, followed by another, reopens no masked text."""
    many = " ".join(f"x{i}+12025550147.s@ex.com" for i in range(600))
    rows = [(1, "mail a+12025550147.smith@ex.com or 10.0.0.1"), (2, "mail a10.0.0.1.smith@ex.com or 10.0.0.1 or +12025550147 end"), (3, many)]
    got = by_id(pii.redact(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[1].text == "mail [EMAIL] or [IP]"
    assert got[2].text == "mail [EMAIL] or [IP] or [PHONE] end"
    assert got[3].text == " ".join(["[EMAIL]"] * 600)


def test_em_finds_the_reliable_labelers():
    patterns = [("name", (1, 1, 1, 0), 80), ("name", (-1, -1, -1, 0), 80), ("name", (1, 1, 1, 1), 20), ("name", (-1, -1, -1, 1), 20)]
    post, reliability = pii._em(patterns)
    assert post["name", (1, 1, 1, 0)] > 0.9 > 0.1 > post["name", (-1, -1, -1, 0)]
    assert reliability["form"][1][1] > 0.9 and reliability["border"][1][1] < 0.5


# 8 and 9 ------------------------------------------------------------------------


def test_site_quality(spark, edge, docs):
    got = by_id(queries.op8_quality_classifier(spark, SF_SMALL))
    assert got.keys() == docs.keys()
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    assert sum(got[d].kept for d in clean) >= 0.95 * len(clean)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in site_quality.judge(edge, none, F.col("id"), F.lit(None)).collect())
    assert site_quality.judge(edge.limit(0), none, F.col("id"), F.col("key")).count() == 0


def test_sparse_sites_shrink_to_the_prior(spark):
    rows = [("a", "x", 0.9)] * 500 + [("b", "x", 0.1)] * 500 + [("c", "y", 0.05), (None, None, 0.9)]
    scored = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, host string, path string, p double")
    got = {r.id: r for r in site_quality.posteriors(scored, 0.5).collect()}
    assert len(got) == len(rows)
    assert got[0].host_rate > 0.8 and got[600].host_rate < 0.2
    assert 0.4 < got[1000].host_rate < 0.6 and got[1001].kept


def brute_posteriors(rows, prior):
    """Posterior of every row (host, path, p), from the definitions, in plain Python."""
    n, pi = len(rows), sum(p for *_, p in rows) / len(rows)
    noise = pi * (1 - pi)
    of_host, of_path = {}, {}
    for h, q, p in rows:
        of_host.setdefault(h, []).append(p)
        of_path.setdefault((h, q), []).append(p)
    mean = lambda x: sum(x) / len(x)

    def strength(between, sizes, free):
        spread = (between - free * noise) / max(n - sum(k * k for k in sizes) / n, 1e-9)
        return min(max(noise / max(spread, 1e-9) - 1, 1.0), 1e6)

    k_host = strength(sum(len(x) * (mean(x) - pi) ** 2 for x in of_host.values()), [len(x) for x in of_host.values()], len(of_host) - 1)
    spread = sum(len(x) * (mean(x) - mean(of_host[h])) ** 2 for (h, _), x in of_path.items())
    k_path = strength(spread, [len(x) for x in of_path.values()], len(of_path) - len(of_host))
    out = []
    for h, q, p in rows:
        host = (k_host * pi + sum(of_host[h]) - p) / (k_host + len(of_host[h]) - 1)
        path = min(max((k_path * host + sum(of_path[h, q]) - p) / (k_path + len(of_path[h, q]) - 1), 1e-6), 1 - 1e-6)
        odds = math.log(p / (1 - p)) - math.log(prior / (1 - prior)) + math.log(path / (1 - path))
        out.append((host, path, 1 / (1 + math.exp(-odds))))
    return out


def test_site_posteriors_against_definitions(spark):
    """Sites of all sizes, nested, sparse and null; repeated and null ids."""
    rnd = random.Random(12)
    rows = []
    for h in [None, "a", "b", "c", "d", "e", "f"]:
        for q in [None, "x", "y", "z"][: rnd.randrange(1, 5)]:
            centre = rnd.random()
            rows += [(h, q, min(max(rnd.gauss(centre, 0.2), 0.01), 0.99)) for _ in range(rnd.choice([1, 2, 20, 60]))]
    scored = spark.createDataFrame([(i // 2 if i % 9 else None, *r) for i, r in enumerate(rows)], "id long, host string, path string, p double").repartition(4)
    got = sorted((r.p, r.host_rate, r.path_rate, r.posterior) for r in site_quality.posteriors(scored, 0.3).collect())
    want = sorted((p, *x) for (_, _, p), x in zip(rows, brute_posteriors(rows, 0.3)))
    assert np.allclose(got, want, rtol=1e-9)


def test_quality_classifier_on_edge_rows(spark, docs):
    """A fitted model over null, empty and very long texts, null and repeated ids and extra
    columns: every row comes back, and equal rows are judged alike."""
    known = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source", "lang").limit(150)
    extra = [(None, None, "s", None), (None, "", None, None), (7, "word " * 50000, "s", "en"), (7, "word " * 50000, "s", "en"), (-1, "\u0000 x", "s", "en")]
    both = known.unionByName(spark.createDataFrame(extra, known.schema)).withColumns({"id": F.lit("k"), "p": F.lit(1), "kept": F.lit(2)})
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    out = site_quality.judge(both, labels, F.col("source"), F.col("lang")).collect()
    assert len(out) == both.count()
    assert len({(r.p, r.posterior, r.kept) for r in out if r.doc_id == 7 and r.path == "en" and r.host == "s"}) == 1
    assert all(0 <= r.p <= 1 and 0 <= r.posterior <= 1 for r in out)


def test_language_identification(spark, edge, docs):
    got = by_id(queries.op9_language_id(spark, SF_SMALL))
    langs = {r.lang for r in docs.values()}
    held = [d for d in docs if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d].held_out == (d in set(held)) for d in docs)
    assert all(r.lang_pred in langs | {"und"} and 0 <= r.score <= 1 for r in got.values())
    assert sum(got[d].lang_pred == docs[d].lang for d in held) >= 0.9 * len(held)
    field = crf_language.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    out = by_id(crf_language.identify(edge, field))
    assert out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == "und" and out[1].score == 0
    assert crf_language.identify(edge.limit(0), field).count() == 0
    assert {r.lang_pred for r in crf_language.identify(edge, None).collect()} == {"und"}


def test_code_switched_words(spark, docs):
    rows = [(r.text, r.lang) for r in docs.values()]
    field = crf_language.fit(rows)
    one = next(r.text for r in docs.values() if r.lang == "fr" and len(crf_language.words(r.text)) > 80)
    two = next(r.text for r in docs.values() if r.lang == "de" and len(crf_language.words(r.text)) > 80)
    a, b = crf_language.words(one)[:60], crf_language.words(two)[:60]
    _, _, marginals, _ = crf_language.label_texts(field, [" ".join(a + b)])[0]
    best = [field.languages[i] for i in marginals.argmax(axis=1)]
    assert best[:60].count("fr") >= 54 and best[60:].count("de") >= 54


def test_long_chains_equal_whole_chains(monkeypatch):
    """Segments with carried messages give the marginals of the whole chain."""
    rng = np.random.default_rng(2)
    lengths = np.array([1, 700, 3, 64, 257, 256])
    emit, move, start = rng.random((lengths.sum(), 4)) + 1e-6, rng.random((4, 4)), rng.random(4)
    monkeypatch.setattr(crf_language, "SEGMENT", 10**6)
    whole = crf_language.forward_backward(emit, lengths, move, start)
    for segment in (1, 7, 256):
        monkeypatch.setattr(crf_language, "SEGMENT", segment)
        assert np.allclose(crf_language.forward_backward(emit, lengths, move, start), whole)


def test_language_words_of_many_letters():
    """A run of 200 letters is consecutive words that all count."""
    run = "".join(random.Random(1).choices("abcdefgh", k=200))
    assert "".join(crf_language.words(run)) == run and [len(w) for w in crf_language.words(run)] == [64, 64, 64, 8]
    one, two = crf_language.words(run + "xyz"), crf_language.words(run)
    (f1, g1, n1), (f2, g2, n2) = crf_language.word_features([one[-1]]), crf_language.word_features([two[-1]])
    assert not (f1 == f2).all() and n1[0] != n2[0] and len(g1) == n1[0] and len(g2) == n2[0]
    both = crf_language.word_features([one[-1], two[-1], "é"])
    assert (both[0][1] == f2[0]).all() and (both[1][n1[0] : n1[0] + n2[0]] == g2).all()


def test_language_sample_is_stable_and_covers(spark, monkeypatch):
    """Rows of null and equal ids draw by their texts, no language drops out, pieces come
    from all of a text, and a second draw is the same."""
    monkeypatch.setattr(crf_language, "PIECES_PER_LANGUAGE", 6)
    rows = [(None, f"{lang} text number {i} " * 20, lang) for lang in ("en", "fr") for i in range(50)] + [(7, "y" * 590 + "".join(f" tail{i}" for i in range(3000)), "de"), (8, None, "de"), (9, "", "de"), (1, "none", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = sorted(map(tuple, crf_language.sample(df).collect()))
    assert first == sorted(map(tuple, crf_language.sample(df.repartition(7)).collect()))
    assert Counter(lang for _, lang in first) == {"en": 6, "fr": 6, "de": 6}
    assert max(len(t) for t, _ in first) <= crf_language.PIECE_CHARS and sum("tail" in t for t, lang in first if lang == "de") >= 5


def test_forward_backward_against_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    move, start = rng.random((3, 3)) + 0.1, rng.random(3) + 0.1
    lengths = np.array([5, 3, 1])
    emit = rng.random((9, 3)) + 0.1
    got = crf_language.forward_backward(emit, lengths, move, start)
    at = 0
    for n in lengths:
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = start[path[0]]
            for t, s in enumerate(path):
                w *= emit[at + t, s] * (move[path[t - 1], s] if t else 1)
            for t, s in enumerate(path):
                want[t, s] += w
        assert np.allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_every_code_point_beside_letters_and_signs():
    """Letters, digits and lower case are those of the library, whatever its tables."""
    from itertools import chain

    byte, word = library(queries.BYTE_VOCABULARY), library(queries.WORD_VOCABULARY)
    transducer = bpe_stream.Transducer(open(queries.vocabulary_path(queries.BYTE_VOCABULARY), "rb").read())
    counter = token_counts.TokenCounter(open(queries.vocabulary_path(queries.WORD_VOCABULARY), "rb").read())
    points = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 200):
        text = " ".join(f"X{chr(c)}y !{chr(c)}'t 7{chr(c)}" for c in points[i : i + 200])
        assert list(chain.from_iterable(transducer.encode(text))) == byte.encode(text, add_special_tokens=False).ids, hex(points[i])
        assert counter.count(text) == len(word.encode(text, add_special_tokens=False).ids), hex(points[i])
