"""Registered queries next to their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from bazaar.llm import decontaminate, near_dedup, pii, queries
from tests.compare import compare


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    if name in queries.ORACLES:
        assert compare(spark, sf, queries.QUERIES[name], queries.ORACLES[name]) in ("", "both sides empty")
    else:
        assert queries.QUERIES[name](spark, sf).count() > 0


def test_entry_has_all():
    import __spark_entry__ as entry

    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())


def test_pipeline_stages(spark, sf):
    """Each stage does to its own input what its operator says, and keeps the columns."""
    docs = queries.table(spark, sf, "documents")
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0)], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontamination", "pii", "bpe"]
    for name in ("quality", "near_dedup", "decontamination", "pii"):
        assert stages[name](spark, docs, sf).schema == docs.schema
    kept = {r.doc_id for r in stages["near_dedup"](spark, docs, sf).select("doc_id").collect()}
    assert kept - {None} == {r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    dirty = {r.doc_id for r in decontaminate.contaminated(docs, queries.table(spark, sf, "benchmark")).collect()}
    clean = [r.doc_id for r in stages["decontamination"](spark, docs, sf).select("doc_id").collect()]
    assert not dirty & set(clean) and len(clean) == docs.where(~docs.doc_id.isin(list(dirty) or [-9]) | docs.doc_id.isNull()).count()
    new = {(r.doc_id, r.text) for r in stages["pii"](spark, docs, sf).select("doc_id", "text").collect()}
    assert new == {(r.doc_id, r.text and pii.rewrite(r.text, queries.KEY)[0]) for r in docs.select("doc_id", "text").collect()}
    assert stages["bpe"](spark, docs, sf).count() == docs.count()


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0
