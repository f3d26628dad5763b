"""Registered queries: against SQL on a small table, and the pipeline by its stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabflow.llm import mixing, toxicity
from tabflow.llm.decontaminate import Finder, normalised
from tabflow.llm.oracles import ORACLES
from tabflow.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.conftest import SF_DIR


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(names)
    got = sorted((tuple(r) for r in found.select(*names).collect()), key=repr)
    assert got == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_per_document(spark, given, name):
    found = QUERIES[name](spark, SF_DIR)
    ids = sorted(r[0] for r in found.select("doc_id").collect())
    if name != "op8_decontamination":
        assert ids == sorted(r[0] for r in given("documents").select("doc_id").collect())


def test_stages(spark, given):
    docs = given("documents")
    rows = {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, normalised(r.text)) for r in given("benchmark").collect()]
    model = toxicity.learn(docs, given("labels"))
    score = model.scorer()

    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    kept = {r.doc_id for r in clean.collect()}
    assert kept == {i for i, r in rows.items() if score(r.text)[0] < toxicity.THRESHOLD}

    single = stages["near_duplicates"](spark, docs, SF_DIR)
    assert single.columns == docs.columns
    groups = plain.near_duplicates([(i, r.text) for i, r in rows.items()], 5)
    assert {r.doc_id for r in single.collect()} == {i for i, g in groups.items() if g[2]}

    fresh = stages["decontamination"](spark, docs, SF_DIR)
    assert fresh.columns == docs.columns
    find = Finder(items).find
    assert {r.doc_id for r in fresh.collect()} == {i for i, r in rows.items() if not find(normalised(r.text))}

    mixed = stages["mixing"](spark, docs, SF_DIR)
    assert mixed.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    taken = mixing.mix(docs, F.array("source"), mixing.word_count(F.col("text"))).collect()
    assert times == {r.doc_id: r.repeats for r in taken if r.taken}


def test_mixing_decides_row_by_row(spark, given):
    """Null and repeated ids, and columns with the names of its own."""
    docs = given("documents").limit(120).select(
        F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 8).alias("doc_id"), "text", "lang", "source", "n_chars"
    ).withColumns({n: F.lit(7) for n in ("size", "repeats", "taken", "row", "__row", "__turn")})
    mixed = dict(corpus_pipeline.STAGES)["mixing"](spark, docs, SF_DIR)
    assert mixed.columns == docs.columns
    words = mixing.word_count(F.col("text"))
    written = mixed.select(F.sum(words)).first()[0]
    rows = docs.withColumn("n", F.monotonically_increasing_id())
    taken = mixing.mix(rows, F.array("source"), words, row_col="n")
    assert taken.count() == docs.count()
    assert written == taken.agg(F.sum("taken")).first()[0]
    assert mixed.select("size", "repeats", "taken").distinct().collect() == [(7, 7, 7)]
    copies = mixed.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0]
    assert copies >= 1
    assert dict(corpus_pipeline.STAGES)["mixing"](spark, docs.limit(0), SF_DIR).collect() == []


def test_run_ends_in_token_ids(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert rows and corpus_pipeline.ORACLE_SQL is None
