import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tabflow.llm import copies

TEXTS = [
    (3, "a b"),
    (1, "a\t\n b"),
    (2, "a b "),
    (9, "a  b"),
    (4, None),
    (5, ""),
    (6, " "),
    (7, " "),
    (8, "A b"),
    (None, "a b"),
    (None, "only null"),
    (None, "only  null"),
    (10, "same"),
    (10, "same"),
    (11, "same"),
    (12, "one"),
    (12, "two"),
    (13, "long " * 50_000),
    (14, "long\n" * 50_000),
]


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(found):
    """Groups, sizes and hashes; exactly one row of each group stays."""
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(plain(t), []).append(i)
    wanted = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        wanted += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    rows = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == sorted(
        wanted, key=repr
    )
    kept = [r for r in rows if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert len({r.text_sha256 for r in kept}) == len(kept) == len(groups)


def test_agrees_with_brute_force(docs):
    found = copies.find_copies(docs(*TEXTS))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    check(found)


@pytest.mark.parametrize("digits", [0, 1])
def test_collisions_are_told_apart(docs, digits):
    check(copies.find_copies(docs(*TEXTS), lambda sha: F.substring(sha, 1, digits)))


def test_a_hot_group_beside_small_ones(spark):
    rows = spark.range(6_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 2_000)).alias("text"),
    )
    found = copies.find_copies(rows)
    assert {(r.keep_id, r.group_size) for r in found.where("text_sha256 = sha2('hot', 256)").collect()} == {(0, 2_000)}
    assert found.where("kept").count() == rows.select("text").distinct().count()


def test_rows_that_stay_keep_their_columns(docs):
    given = docs(*TEXTS)
    left = copies.without_copies(given)
    assert left.columns == given.columns
    ids = sorted(((r.doc_id, plain(r.text)) for r in left.collect()), key=repr)
    keep = {}
    for i, t in TEXTS:
        keep[plain(t)] = min((x for x in (i, keep.get(plain(t))) if x is not None), default=None)
    assert ids == sorted(((i, t) for t, i in keep.items()), key=repr)
    assert left.select("lang", "size").distinct().collect() == [("en", 7)]


def test_empty_table(docs):
    assert copies.find_copies(docs()).collect() == []
    assert copies.without_copies(docs()).collect() == []
