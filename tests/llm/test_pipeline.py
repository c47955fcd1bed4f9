"""The pipeline against plain versions of its stages, and the registration of all queries."""

import pytest
from brute import lower_az, near_components

import __spark_entry__ as E
from odd_rows import no_docs, odd_docs  # noqa: F401
import corpus_pipeline
from conftest import SF_MID, SF_SMALL
from tallybook.llm import decontaminate
from tallybook.llm.common import table
from tallybook.plans import registry


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_MID, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    good = stages["quality"](spark, docs, SF_MID)
    rows = good.collect()
    assert good.columns == docs.columns and 0.7 * docs.count() < len(rows) < docs.count()
    labels = {r.doc_id: r.quality for r in table(spark, SF_MID, "labels").collect()}
    kept = {r.doc_id for r in rows}
    assert sum(i in kept for i, q in labels.items() if q == 1) > 0.95 * sum(q == 1 for q in labels.values())

    unique = stages["exact_dedup"](spark, spark.createDataFrame(rows, docs.schema), SF_MID).collect()
    best = {}
    for r in rows:
        best[lower_az(r.text)] = max(best.get(lower_az(r.text), -1), r.doc_id)
    assert {r.doc_id for r in unique} == set(best.values())

    frame = spark.createDataFrame(unique, docs.schema)
    apart = stages["near_dedup"](spark, frame, SF_MID).collect()
    top, _ = near_components([(r.doc_id, r.text) for r in unique], 5)
    assert {r.doc_id for r in apart} == set(top.values())

    frame = spark.createDataFrame(apart, docs.schema)
    clean = stages["decontamination"](spark, frame, SF_MID).collect()
    items = [" " + " ".join(decontaminate.words_of(r.text)) + " " for r in table(spark, SF_MID, "benchmark").collect()]
    leaked = {r.doc_id for r in apart if any(i in " " + " ".join(decontaminate.words_of(r.text)) + " " for i in items)}
    assert {r.doc_id for r in clean} == {r.doc_id for r in apart} - leaked

    packed = stages["packing"](spark, spark.createDataFrame(clean, docs.schema), SF_MID).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 0
    for start in (odd_docs, no_docs):
        docs = start
        for name, fn in corpus_pipeline.STAGES:
            docs = fn(spark, docs, SF_SMALL)
            if name != "packing":
                assert docs.columns == start.columns
        assert (docs.count() > 0) == (start is odd_docs)


def test_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(registry.queries()) <= set(names)


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op5_chat_format", "op11_merkle_manifest", "op12_vector_codes",
                                  "op13_embedding_near_dup"])
def test_matches_duckdb(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    want = con.execute(E.oracle_sql()[name]).df()
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert sorted(map(repr, want[cols].values.tolist())) == sorted(map(repr, got[cols].values.tolist()))
