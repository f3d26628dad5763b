import pytest
from pyspark.sql import functions as F

from tabflow.llm import minhash
from tabflow.llm.sieve import may_match

JOINS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _sent(plan):
    """Rows that each exchange of an executed plan wrote, broadcasts not counted."""
    name, out = plan.getClass().getSimpleName(), []
    if name == "AdaptiveSparkPlanExec":
        return _sent(plan.executedPlan())
    if name == "ShuffleQueryStageExec":
        return _sent(plan.plan())
    if name == "ShuffleExchangeExec":
        out.append((plan.output().mkString(" "), plan.metrics().apply("shuffleRecordsWritten").value()))
    children = plan.children()
    for i in range(children.size()):
        out += _sent(children.apply(i))
    return out


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_no_id_is_missed_and_few_others_pass(spark, kind):
    rows = spark.range(-50_000, 50_000).select(F.col("id").cast(kind).alias("x"), F.lit(1).alias("y"))
    ids = spark.range(0, 2_000).select((F.col("id") * 7 - 5).alias("k"))
    found = may_match(rows, ids, "x", "may")
    assert found.columns == ["x", "y", "may"] and found.count() == 100_000
    found = found.join(ids, F.col("x").cast("bigint") == F.col("k"), "left")
    count = {(r[0], r[1]): r[2] for r in found.groupBy(F.col("k").isNull(), "may").count().collect()}
    assert count[False, True] == 2_000 and (False, False) not in count and count[True, True] < 4_000


def test_nothing_passes_without_ids_and_null_ids_stay(spark):
    rows = spark.createDataFrame([(None,), (1,), (1,)], "x bigint")
    assert [r.may for r in may_match(rows, rows.limit(0), "x", "may").collect()] == [False] * 3
    found = may_match(rows, rows.where("x = 1"), "x", "may")
    assert sorted((r.x, r.may) for r in found.where("x = 1").collect()) == [(1, True)] * 2
    assert found.where("x is null AND may IS NOT NULL").count() == 1


def test_texts_that_cannot_be_copies_are_not_shuffled(spark, docs, words, conf):
    for key, value in JOINS.items():
        conf(key, value)
    text = " ".join(words(30))
    rows = docs(*[(i, " ".join(words(30)) + f" {i}") for i in range(400)], (500, text), (501, text), (None, text))
    left = minhash.without_duplicates(rows, 2)
    assert len(left.collect()) == 402
    sent = [n for columns, n in _sent(left._jdf.queryExecution().executedPlan()) if "text" in columns]
    assert sum(sent) < 100
