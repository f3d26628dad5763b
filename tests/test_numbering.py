import pytest
from pyspark.sql import functions as F

from tabflow.operators.numbering import batch_numbers, dense_numbers
from tabflow.scratch import staged


def shuffled(spark, n):
    return spark.range(n).select(F.xxhash64("id").alias("k"), "id").repartition(7)


@pytest.mark.parametrize("unique", [True, False])
def test_numbers_follow_the_order(spark, unique):
    df = shuffled(spark, 5000)
    found = dense_numbers(df, "n", ["k"], unique=unique, start=10).collect()
    ordered = sorted(found, key=lambda r: r["k"])
    assert [r["n"] for r in ordered] == list(range(10, 5010))


def test_two_keys(spark):
    df = spark.range(600).select((F.col("id") % 7).alias("a"), (-F.col("id")).alias("b"))
    found = dense_numbers(df.repartition(5), "n", ["a", "b"], unique=True).collect()
    ordered = sorted(found, key=lambda r: (r["a"], r["b"]))
    assert [r["n"] for r in ordered] == list(range(600))


def test_hot_key_is_split_and_every_number_used_once(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    written = []

    def keep(df, name):
        written.append(staged(df, name))
        return written[-1]

    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"), "id"
    )
    found = dense_numbers(df, "n", ["k"], stage=keep).collect()
    assert sorted(r["n"] for r in found) == list(range(9000))
    ordered = sorted(found, key=lambda r: r["n"])
    assert [r["k"] for r in ordered] == sorted(r["k"] for r in found)
    assert written[0].where("k = 5").select("__part").distinct().count() > 1


def test_without_order_nothing_is_shuffled(spark):
    df = spark.range(0, 1000, 1, 5)
    found = dense_numbers(df, "n").collect()
    assert sorted(r["n"] for r in found) == list(range(1000))
    assert all(r["id"] == r["n"] for r in found)


def test_nothing_to_number(spark):
    empty = spark.range(0)
    assert dense_numbers(empty, "n", ["id"], unique=True).collect() == []
    assert dense_numbers(empty, "n").collect() == []


def test_batches_are_bounded(spark):
    df = shuffled(spark, 1501)
    sizes = {
        r["batch"]: r["count"]
        for r in batch_numbers(df, 500, order_by=["k"]).groupBy("batch").count().collect()
    }
    assert sizes == {0: 499, 1: 500, 2: 500, 3: 2}


def test_columns_are_kept(spark):
    df = spark.range(3).withColumn("v", F.array(F.lit(1)))
    assert batch_numbers(df, 2).columns == ["id", "v", "batch"]


def test_missing_keys_come_first(spark):
    df = spark.range(100).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("k"))
    found = dense_numbers(df.repartition(3), "n", ["k"]).collect()
    assert sorted(r["n"] for r in found) == list(range(100))
    assert {r["n"] for r in found if r["k"] is None} == set(range(25))
