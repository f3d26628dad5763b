import pytest
from pyspark.sql import functions as F

from tabflow.llm import urls


@pytest.mark.parametrize("shard_bytes", [1 << 20, 64])
def test_cascade_is_exact(spark, shard_bytes):
    keys = spark.range(3000).select(
        F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed")
    )
    cascade = urls.build_cascade(keys, bits_per_key=3, max_shard_bytes=shard_bytes)
    assert len(cascade.levels) > 1 and (cascade.levels[0][2] > 1) == (shard_bytes == 64)
    flagged = cascade.flag(keys, F.col("key"), "found")
    assert flagged.where("found <> listed").count() == 0 and flagged.count() == 3000


def test_few_listed_and_many_other_keys(spark):
    keys = spark.range(100_000).select(
        F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 5000 == 0).alias("listed")
    )
    cascade = urls.build_cascade(keys, bits_per_key=4, max_shard_bytes=256)
    shards = [s for _, _, s in cascade.levels]
    assert shards[0] == 1 and max(shards) > 1, "keys let through by the first level need shards"
    assert all(bits <= 8 * 256 for _, bits, _ in cascade.levels)
    flagged = cascade.flag(keys.union(keys.limit(0)), F.col("key"), "found")
    assert flagged.where("found <> listed").count() == 0 and flagged.count() == 100_000


def test_null_page_ids(spark):
    pages = spark.createDataFrame(
        [(None, "http://casino.b.c/"), (None, None), (None, "http://a.c/")], "page_id int, url string"
    )
    assert sorted(r.verdict for r in urls.judge_urls(pages).collect()) == ["allow", "allow", "block"]


def test_nothing_listed(spark):
    keys = spark.createDataFrame([("a", False), (None, True), ("b", None)], "key string, listed boolean")
    cascade = urls.build_cascade(keys)
    assert cascade.levels == [] and cascade.bytes() == 0
    assert [r.f for r in cascade.flag(keys, F.col("key"), "f").collect()] == [False] * 3


def test_rules_and_hosts(spark):
    rows = [
        (1, "https://www.Example.ORG/en/17?x#y", "www.example.org", "/en/17", "example.org/en/1", "block"),
        (2, "http://a.org/x", "a.org", "/x", "org/", "allow"),
        (3, "http://a.org", "a.org", "", None, "allow"),
        (4, "http://spam-farm.example.net?q=/x", "spam-farm.example.net", "", None, "block"),
        (5, None, "", "", None, "allow"),
        (6, "no scheme/fr/", "", "", None, "allow"),
        (7, "x://com/de/a://b", "com", "/de/a:", "com/de/", "block"),
        (8, "http://scom/de/", "scom", "/de/", None, "allow"),
        (9, "http://casino.example.org/es/1", "casino.example.org", "/es/1", "example.org/es/", "block"),
        (10, "http://casino.b.org/", "casino.b.org", "/", "org/", "allow"),
    ]
    pages = spark.createDataFrame([r[:2] + ("h", True) for r in rows], "page_id int, url string, host string, listed boolean")
    got = urls.judge_urls(pages).select("page_id", "url", "host", "path", "rule", "verdict")
    wanted = [tuple(r) for r in rows]
    wanted[6] = (7, rows[6][1], "com", "/de/a://b", "com/de/", "block")
    assert sorted(map(tuple, got.collect())) == wanted


def test_a_given_list_and_an_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.b/"), (2, "http://c.d/")], "page_id int, url string")
    listed = spark.createDataFrame([("c.d",), ("e.f",), (None,)], "host string")
    got = urls.judge_urls(pages, rules=(), listed=listed)
    assert {r.page_id: r.verdict for r in got.collect()} == {1: "allow", 2: "block"}
    assert urls.judge_urls(pages.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, plan):
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id int, url string")
    assert "Python" not in plan(urls.judge_urls(pages)) and "Arrow" not in plan(urls.judge_urls(pages))
