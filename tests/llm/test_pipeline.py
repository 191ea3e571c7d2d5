"""The pipeline, stage by stage, against brute force on sf0.001."""

from pyspark.sql import functions as F

import corpus_pipeline
from pushlake.llm import queries
from pushlake.llm._util import materialize
from tests.conftest import SF_SMALL
from tests.llm.test_operators import base_pii, exact_components, library


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids, kept = docs.columns, [], None
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, SF_SMALL), "test")
        after = {r.doc_id: r for r in docs.collect()}
        ids.append(set(after))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "quality classifier":
            judged = queries.op8_quality_classifier(spark, SF_SMALL).filter("kept").collect()
            assert set(after) == {r.doc_id for r in judged}
        if name == "near-duplicates":
            want = exact_components({d: r.text for d, r in before.items()})
            assert set(after) == {d for d, (_, c) in want.items() if c == d}
        if name == "benchmark decontamination":
            leaks = {r.doc_id for r in queries.op2_decontaminate(spark, SF_SMALL).collect()}
            assert set(after) == set(before) - leaks
        if name == "personal data":
            assert set(after) == set(before)
            assert all(base_pii(r.text)[1] == [] and r.n_chars == len(r.text) for r in after.values())
            kept = after
        if name == "bpe encoding and decoding":
            lib = library(queries.BYTE_VOCABULARY)
            assert all(r.round_trip and r.n_tokens == len(lib.encode(kept[d].text, add_special_tokens=False).ids) for d, r in after.items())
    assert all(b <= a for a, b in zip(ids, ids[1:]))


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() == out.select("doc_id").distinct().count() > 0


def test_stages_on_edge_rows(spark):
    """Null, empty and very long texts, null and repeated ids, null columns and extra
    columns pass every stage; rows without an id stay, rows that share one go together."""
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
    rows = [
        (None, None, None, None, None), (None, "", "en", "s", 0), (900001, "one two three four five six seven", None, None, 3),
        (900001, "quite another text of more than five words here", "en", "s", 9), (900002, "word " * 40000, "en", "s", 5), (None, "mail a.b@example.org now", "en", "s", 1),
    ]
    docs = given.unionByName(spark.createDataFrame(rows, given.schema)).withColumns({"id": F.lit("k"), "key": F.lit(1), "component_id": F.lit(2), "kept": F.lit("no")})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = materialize(stage(spark, docs, SF_SMALL), "edge")
        after = docs.collect()
        assert docs.columns == columns and len(after) <= len(before), name
        assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before), name
        assert sum(r.doc_id == 900001 for r in after) in (0, 2), name
    assert not any("a.b@example.org" in (r.text or "") for r in docs.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert last.count() == docs.count()


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "none")
        assert docs.count() == 0, name
