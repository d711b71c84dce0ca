import re

import pytest

import corpus_pipeline
from tests.llm.test_exact_dedup import brute as exact_brute
from tests.llm.test_near_dedup import brute as near_brute
from wattloom.llm.queries import bad_quality, table
from wattloom.llm.quality_rules import learn, quality
from wattloom.sources.tables import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    docs = table(spark, SF, "documents")
    found = [docs]
    for name, function in corpus_pipeline.STAGES:
        found.append(stage(function(spark, found[-1], SF), name))
    return [frame.collect() for frame in found], found


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_columns_stay_until_the_last_stage(stages):
    _, frames = stages
    assert all(f.columns == frames[0].columns for f in frames[1:-1])


def test_every_stage_against_brute_force(spark, stages):
    rows, frames = stages
    words = lambda r: re.findall(r"[^\x20\x09-\x0D]+", r.text)
    rules = learn(frames[0], table(spark, SF, "labels"), bad_quality())
    kept = {r.doc_id for r in quality(frames[0], rules).where("kept").collect()}
    assert {r.doc_id for r in rows[1]} == kept and all(len(words(r)) >= 50 for r in rows[1])
    assert {r.doc_id for r in rows[2]} == {d[0] for d in exact_brute(pairs(rows[1])) if d[3]}
    assert {r.doc_id for r in rows[3]} == {d[0] for d in near_brute(pairs(rows[2]), 5, 80) if d[3]}
    assert {r.doc_id for r in rows[4]} <= {r.doc_id for r in rows[3]}
    assert sorted(r.doc_id for r in rows[5]) == sorted(r.doc_id for r in rows[4])


def test_clean_documents_stay_in_the_mixture(spark, stages):
    rows, _ = stages
    clean = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1 AND toxic = 0").collect()}
    assert clean & {r.doc_id for r in rows[3]} <= {r.doc_id for r in rows[4]}


def test_run_is_the_chain(spark, stages):
    rows, _ = stages
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, rows[5]))


def test_odd_rows_pass(spark):
    schema = "doc_id bigint, text string, kept string, n_words int, copies int"
    long = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(None, long, "a", 1, 1), (1, None, "b", 2, 2), (2, long, None, None, None), (2, long, None, None, None)], schema)
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), name)
        assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        if name == "near_dedup":  # no word, no quality; a row without an identifier is compared with nothing
            assert sorted((r.doc_id or 0, r.kept or "") for r in docs.collect()) == [(0, "a"), (2, ""), (2, "")]
    empty = docs.limit(0)
    for _, function in corpus_pipeline.STAGES:
        empty = stage(function(spark, empty, SF), "empty")
    assert empty.count() == 0
