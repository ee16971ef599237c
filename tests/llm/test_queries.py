"""Registered queries: SQL twins on the smallest tables, the pipeline stage by
stage, and the whole set's names."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))
from oracle_check import compare, duck_connection  # noqa: E402

import corpus_pipeline  # noqa: E402
from tramline.llm import decontaminate, jaccard_join  # noqa: E402
from tramline.llm.common import held_out, stored, table  # noqa: E402
from tramline.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, name):
    report = compare(spark, duck_connection(SF), name, QUERIES[name], SQL[name], SF)
    assert report["ok"], report


def test_leaks_are_the_contaminated_documents(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    hits = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontaminate"](spark, SF).collect()}
    texts = [(r.item_id, r.text) for r in items.collect()]
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in texts if t in r.text}
    assert exact and exact <= hits
    flagged = decontaminate.decontaminate(docs, items).where("contaminated")
    assert {r.doc_id for r in flagged.collect()} == {d for d, _ in hits}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op2_decontaminate"}))
def test_whole_table(spark, name):
    docs = table(spark, SF, "documents")
    got = QUERIES[name](spark, SF)
    assert got.count() == docs.count()
    if "held_out" in got.columns:
        assert got.where("held_out").count() == docs.where(held_out()).count()


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "jaccard_join", "decontaminate", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), "pipeline-test")
        if name != "bpe":
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
        if name == "jaccard_join":
            linked = jaccard_join.jaccard_components(docs).where(
                "n_shingles > 0 AND component_id <> doc_id")
            assert linked.isEmpty()
        if name == "decontaminate":
            found = decontaminate.decontaminate(docs, table(spark, SF, "benchmark"))
            assert found.where("contaminated").isEmpty()
    assert docs.count() == before.count() and docs.where("NOT exact").isEmpty()


def test_pipeline_of_an_empty_table(spark, frame_of_documents):
    docs = frame_of_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "pipeline-empty")
    assert docs.count() == 0


@pytest.fixture
def frame_of_documents(spark):
    return table(spark, SF, "documents").limit(0)
