"""The language model on many shards: its files grow with the corpus, and a process that
reads them holds no open file for each."""

import math
import os
import random

import numpy as np
import pytest

from pushlake.llm import arrays, ngram_lm


@pytest.mark.parametrize("order", [2, 3])
def test_files_of_many_heavy_words_grow_with_the_shards(spark, monkeypatch, order):
    """Twelve words are heavy; each was cut over all shards, with files for each."""
    rng = random.Random(5)
    common, rare = [f"w{i}" for i in range(12)], [f"rare{i}" for i in range(200)]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.7 else rng.choice(rare) for _ in range(50)) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)

    def fit():
        model, heavy = ngram_lm.train(rows, order=order)
        scores = {r.id: (r.n_known, r.base_score, r.score) for r in ngram_lm.score(rows, model, heavy).collect()}
        return model, heavy, scores

    whole, _, expected = fit()
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 100)
    n_shards = math.ceil(sum(map(len, texts)) / 6 / 100)
    model, heavy, got = fit()
    assert len(heavy) > 12 and n_shards > 50  # the common words and the start mark
    assert (model.tokens, model.types, model.bigram_types) == (whole.tokens, whole.types, whole.bigram_types)
    assert model.discounts == whole.discounts and model.uniform == whole.uniform
    assert got.keys() == expected.keys()
    for x in got:
        assert got[x] == pytest.approx(expected[x], rel=1e-12)
    # a share of the tokens a shard; a shard more for each heavy word, and those of the start mark
    assert len(model.bigrams.shards) <= n_shards + len(heavy) + math.ceil(len(texts) * n_shards / model.tokens)
    if order == 3:
        assert len(model.pasts.shards) <= n_shards + len(heavy)
        assert len(model.hot_trigrams.shards) <= 3 * n_shards


def test_mapped_arrays_hold_no_open_files(tmp_path, monkeypatch):
    """Neither the columns that are kept nor those mapped for one lookup."""
    monkeypatch.setattr(arrays, "MAX_MAPS", 7)
    keys = np.arange(0, 3000, 3, dtype=np.uint64)
    shards, split = [], []
    for base in range(0, 1000, 50):
        own = keys[base : base + 50]
        files = (("key", "<u8", arrays.write_array(str(tmp_path), "key", own)), ("count", "<i8", arrays.write_array(str(tmp_path), "count", own.astype(np.int64) * 2)))
        shards.append(arrays.Shard(base, 50, int(own[0]), int(own[-1]), files))
        compact = arrays.write_split(str(tmp_path), own, count=own * np.uint64(2))
        split.append(arrays.Shard(base, 50, int(own[0]), int(own[-1]), tuple((u.rpartition("/")[2].partition(".")[0], "", u) for u in compact)))
    opened = len(os.listdir("/proc/self/fd"))
    wanted = np.arange(3000, dtype=np.uint64)
    for table in (arrays.SortedArrays(shards), arrays.SplitArrays(split)):
        for _ in range(2):
            got = table.find(wanted, ["count", "position"])
            assert got["count"].tolist() == [2 * x if x % 3 == 0 else 0 for x in range(3000)]
            assert got["position"].tolist() == [x // 3 if x % 3 == 0 else -1 for x in range(3000)]
            assert len(table._maps) <= 7
            assert len(os.listdir("/proc/self/fd")) <= opened
