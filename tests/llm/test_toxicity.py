import pytest
from pyspark.sql import functions as F

from tabflow.llm import toxicity


def test_folding():
    assert toxicity.fold("M0R0N") == ["moron"]
    assert toxicity.fold("mоrоn") == ["moron"]
    assert toxicity.fold("Idiót i­diot") == ["idiot", "idiot"]
    assert toxicity.fold("") == toxicity.fold(" .,") == []


def test_matching():
    model = toxicity.Model({"moron": 5.0, "trash ": 3.0, "tra": 1.0})
    match = model.matcher()
    assert match("Moronic m0r0n oxymoron") == (2, 10.0, 3)
    assert match("trash trashy") == (2, 4.0, 2)
    assert match("the trash can, soap") == (0, 0, 4)
    assert match("trash. can't") == (0, 0, 3)
    assert match("") == (0, 0.0, 0)


def test_an_empty_model():
    assert toxicity.Model({}).scorer()("anything") == toxicity.Model({}).scorer()("")


@pytest.fixture
def labelled(spark, docs, words):
    bad = [(i, " ".join([*words(40), "moronic" if i % 2 else "m0r0n", *words(9)])) for i in range(60)]
    good = [(100 + i, " ".join(words(50))) for i in range(200)]
    labels = [(i, 1) for i, _ in bad] + [(i, 0) for i, _ in good] + [(None, 1), (100, None), (999, 1)]
    return docs(*bad, *good), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_rows_are_found(labelled):
    df, labels = labelled
    model = toxicity.learn(df, labels)
    assert any("moron".startswith(e) or e.startswith("moron") for e in model.entries)
    rows = toxicity.score_texts(df, model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    assert {r.out for r in rows} == {True, False}
    assert all(r.predicted == (r.doc_id < 100) and 0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_learned_from(labelled):
    df, labels = labelled
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.learn(df, flipped) == toxicity.learn(df, labels)


def test_ids_repeated_many_times_are_fitted_once(spark, labelled):
    """Any order of the rows gives the same model; each id is one row of the fit."""
    df, labels = labelled
    others = df.withColumn("text", F.concat("text", F.lit(" moronic and more"))).where("doc_id = 100")
    many = df.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(9)))).drop("n").union(others)
    models = [toxicity.learn(many.orderBy(F.rand(seed)).coalesce(n), labels) for seed, n in ((1, 1), (2, 3))]
    assert models[0] == models[1]
    few = [toxicity.learn(many.orderBy(by), labels, sample_rows=80) for by in ("text", F.desc("doc_id"))]
    assert few[0] == few[1] and few[0].entries


def test_accuracy_on_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score_texts(docs, toxicity.learn(docs, labels)).join(labels, "doc_id")
    r = scored.where(toxicity.held_out(F.col("doc_id"))).agg(
        F.sum(F.expr("predicted * toxic")).alias("hit"), F.sum("predicted").alias("said"), F.sum("toxic").alias("all")
    ).first()
    assert r.hit / r.said > 0.9 and r.hit / r["all"] > 0.85


def test_odd_rows(docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    df = docs((1, None), (None, "x"), (2, ""), (2, ""), (3, "w " * 20000))
    model = toxicity.learn(df, labels)
    assert toxicity.score_texts(df, model).count() == 5
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == 5
    none = spark.createDataFrame([], labels.schema)
    assert toxicity.learn(docs(), none).entries == {}
    assert toxicity.score_texts(docs(), model).collect() == []
