from statistics import median

import pytest
from pyspark.sql import functions as F

from tabflow.operators.geo import city_locations
from tabflow.operators.graph import edge_dump
from tabflow.operators.skew import heavy_keys, join_salted
from tests.helpers import rows


@pytest.fixture
def shuffled(conf):
    """Sort-merge joins without adaptive execution, in 16 partitions."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")


def uneven(spark, n=48_000):
    """A third of the rows has one key, a tenth another, some none."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(8))
        .when(F.col("id") % 100 == 2, F.lit(None))
        .otherwise(F.col("id") % 5_000 + 100)
    )
    return spark.range(0, n, 1, 6).select(F.col("id").alias("n"), key.alias("k"))


def sizes(df):
    counted = df.groupBy(F.spark_partition_id()).count().collect()
    return sorted(r["count"] for r in counted)


def test_heavy_keys_are_found_with_their_shares(spark):
    found = heavy_keys(uneven(spark), "k", 64)
    hashes = spark.range(7, 9).select(F.xxhash64("id")).collect()
    assert set(found) == {r[0] for r in hashes}
    assert found[hashes[0][0]] in range(20, 24) and found[hashes[1][0]] in range(3, 7)


def test_no_heavy_keys(spark):
    empty = spark.createDataFrame([], "n bigint, k bigint")
    nulls = spark.range(10).select(F.col("id").alias("n"), F.lit(None).cast("bigint").alias("k"))
    others = spark.range(10).withColumnRenamed("id", "k")
    for df in (empty, nulls):
        assert heavy_keys(df, "k", 8) == {}
        assert join_salted(df, others, "k", F.col("n")).collect() == []


def test_salted_join_has_the_rows_of_a_plain_one_and_even_tasks(spark, shuffled):
    left = uneven(spark)
    # the second hot key twice, some keys missing
    right = spark.range(5, 4_000).select(F.explode(F.array("id", F.greatest("id", F.lit(8)))).alias("k"))
    right = right.distinct().union(spark.createDataFrame([(8,)], "k bigint"))
    right = right.withColumn("name", F.concat(F.lit("k"), "k"))
    plain = left.join(right, "k")
    salted = join_salted(left, right, "k", F.col("n"))
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)
    before, after = sizes(plain), sizes(salted)
    assert before[-1] > 4 * median(before)
    assert len(after) == 16 and after[-1] <= 2 * median(after)


def test_common_names_are_divided(spark, shuffled):
    """Copies of one line hold a third of the feed."""
    city = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 900))
    places = spark.range(0, 30_000, 1, 6).select(
        city.alias("city"),
        F.lit("r").alias("region"),
        F.lit("c").alias("country"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("latitude"),
        F.lit(0.0).alias("longitude"),
    )
    names = [(i, f"c{i}") for i in range(600)] + [(1_000, "hot"), (1_001, "hot"), (1_002, None)]
    cities = spark.createDataFrame(names, "city_id bigint, city string")
    salted = city_locations(places, cities, F.lit("t"), salted=True)
    assert rows(salted) == rows(city_locations(places, cities, F.lit("t")))
    with pytest.raises(ValueError, match="plain text"):
        city_locations(places, cities, collation="UTF8_LCASE_RTRIM", salted=True)


def test_edges_of_hot_users_are_divided(spark, shuffled):
    """One user follows a third of all, another is followed by a third."""
    n = 30_000
    edges = spark.range(0, n, 1, 6).select(
        F.col("id").alias("rel_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2_000).cast("bigint").alias("src"),
        F.when(F.col("id") % 3 == 1, 2).otherwise(F.col("id") % 2_100).cast("bigint").alias("dst"),
        F.lit("follows").alias("name"),
    )
    nodes = spark.range(2_100).select(F.col("id").alias("userid"), (F.col("id") + 9).alias("node_id"))
    plain, salted = edge_dump(edges, nodes), edge_dump(edges, nodes, salted=True)
    assert salted.count() == n and rows(salted) == rows(plain)
    before, after = sizes(plain), sizes(salted)
    assert before[-1] > 4 * median(before) and after[-1] <= 2 * median(after)
