"""Exact copies: grouped by a 128-bit hash, proven by comparing the texts of each group.

Hashes and ids alone find the groups. The texts of groups are then grouped by hash and text,
which compares their bytes. Groups with more than a thousandth of all rows, which are fewer
than a thousand, are known to every task: their copies are combined before the shuffle, so
one row leaves a task for each. The texts of all others meet the hashes of the smaller
groups in a shuffle. Two texts in a group would be a collision of hashes, and its rows
are then grouped by their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.operators.skew import join_hot
from tabflow.scratch import staged

_SPACES = r"[\x20\x09-\x0D]+"
#: A group with more than one row in so many is a hot one; there are fewer of those than this.
HOT_SHARE = 1_000


def normalised(text: Column) -> Column:
    """The text with one space for every run of U+0020 and U+0009 to U+000D; a null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACES, " ")


def hash_128(sha256: Column) -> Column:
    """128 bits of a hexadecimal SHA-256."""
    return F.unhex(F.substring(sha256, 1, 32))


def find_copies(
    docs: DataFrame,
    content_hash: Callable[[Column], Column] = hash_128,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: id, ``keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are after ``normalised``; a null text equals an empty one. Of
    each group of equal texts the smallest id stays, null ids after all others. If several
    rows have that id, one of them stays. ``content_hash`` makes the group key of a text's
    hexadecimal SHA-256; a weak one costs comparisons, never a wrong group.
    """
    hashed = _hashed(docs, content_hash, id_col, text_col)
    place = F.monotonically_increasing_id()
    rows = staged(hashed.select("id", "key", "sha", place.alias("row")), "hashes")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = rows.groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    groups = staged(groups.where("n > 1"), "groups")

    hot = F.col("n") > rows.count() / HOT_SHARE
    few = F.broadcast(groups.where(hot).select("key"))
    others = groups.where(~hot).select("key").hint("shuffle_hash")  # whatever their number
    hot_texts = hashed.join(few, "key", "left_semi").select("key", "text").distinct()
    cold = hashed.join(few, "key", "left_anti").join(others, "key", "left_semi")
    texts = hot_texts.union(cold.select("key", "text").distinct())
    collided = staged(texts.groupBy("key").count().where("count > 1").select("key"), "collided")
    if collided.isEmpty():
        marked = _first(join_hot(rows, groups, ["key"], hot, "left"))
    else:
        single = rows.join(collided, "key", "left_anti")
        marked = _first(join_hot(single, groups, ["key"], hot, "left")).union(_by_text(hashed, collided))
    return marked.withColumnsRenamed({"id": id_col, "sha": "text_sha256"})


def _hashed(docs: DataFrame, content_hash: Callable, id_col: str, text_col: str) -> DataFrame:
    text = normalised(F.col(f"`{text_col}`"))
    named = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    named = named.withColumn("sha", F.sha2("text", 256))
    return named.withColumn("key", content_hash(F.col("sha")))


def _first(every: DataFrame) -> DataFrame:
    """Rows with the first one of their group, which of a row without a group is itself."""
    first = F.coalesce("first", F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    return every.select(
        "id",
        first["id"].alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        (first["row"] == F.col("row")).alias("kept"),
        "sha",
    )


def _by_text(hashed: DataFrame, collided: DataFrame) -> DataFrame:
    """The same for rows whose hash several texts have; those are few, if any."""
    same = Window.partitionBy("key", "text")
    inside = same.orderBy(F.col("id").asc_nulls_last())
    return hashed.join(collided, "key", "left_semi").select(
        "id",
        F.min("id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
        (F.row_number().over(inside) == 1).alias("kept"),
        "sha",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows are told apart by id and hash. Only rows that share both with another one, where
    any of them may stay, are shuffled with their columns.
    """
    marked = find_copies(docs, id_col=id_col, text_col=text_col)
    marked = staged(marked.select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"), "kept"), "marked")
    named = marked.groupBy("__id", "__sha").agg(F.max("kept").alias("__kept"), F.count("*").alias("__rows"))
    named = staged(named.where("not __kept or __rows > 1"), "named")
    sha = F.sha2(normalised(F.col(f"`{text_col}`")), 256)
    rows = docs.withColumns({"__id": F.col(f"`{id_col}`"), "__sha": sha})

    def same(other: DataFrame) -> Column:
        return rows["__id"].eqNullSafe(other["__id"]) & (rows["__sha"] == other["__sha"])

    several = named.where("__kept and __rows > 1")
    one = rows.join(several, same(several), "left_semi").dropDuplicates(["__id", "__sha"])
    left = rows.join(named, same(named), "left_anti")
    return left.unionByName(one).drop("__id", "__sha")
