"""URL verdicts: path rules first, then exact membership in a Bloom filter cascade.

The cascade answers "is this key listed?" without a join and without error for
every key of the universe it was built over. Level 0 is a Bloom filter of the
listed keys; level 1 one of the unlisted keys that level 0 lets through; level 2
one of the listed keys that level 1 lets through, and so on until a level lets
nothing through. A key's answer is the parity of the first level that stops it.

Everything is DataFrame expressions: building explodes bit positions and ORs
them per 64-bit word, asking reads the words of one array. One level's array is
held by every task, so its size is bounded: beyond ``MAX_SHARD_BYTES`` the keys
are split into shards by hash, and rows then meet the filter of their shard in
an equi-join on the shard number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.scratch import staged

BITS_PER_KEY = 12
HASHES = 8
MAX_SHARD_BYTES = 4 << 20

# Rules of the registered query as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# A host is listed if a part of its name is one of these words.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.

    Empty for a null and for a text without ``://``.
    """
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))


def rule_for(
    host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES
) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of rules of one length the first in code point order wins.
    """
    rule = verdict = F.lit(None).cast("string")
    longest_last = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True)
    for name, start, says in longest_last:
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def has_listed_word(host: Column, words: Sequence[str] = LISTED_WORDS) -> Column:
    """Whether one of the host's parts, between dots and hyphens, is a listed word."""
    return F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, words)))


@dataclass
class Cascade:
    """A built cascade; ``levels`` holds (filter table, bits per shard) pairs.

    A filter table has one row per shard: ``shard int, bits array<bigint>``.
    """

    levels: list[tuple[DataFrame, int, int]]  # filter table, bits of a shard, shards

    def bytes(self) -> int:
        """Size of all levels over all shards."""
        return sum(bits // 8 * shards for _, bits, shards in self.levels)

    def flag(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """Add boolean ``name``: whether ``key`` is listed. A null key is not."""
        columns = [F.col(f"`{c}`") for c in rows.columns]
        if not self.levels:
            return rows.select(*columns, F.lit(False).alias(name))
        asked = rows.select(F.struct(*columns).alias("__row"), key.alias("__key"))
        bits = []
        for level, (table, _, shards) in enumerate(self.levels):
            if shards == 1:
                bits.append(table.select("bits").scalar())
            else:
                named = table.select(F.col("shard").alias("__shard"), F.col("bits").alias(f"__b{level}"))
                asked = asked.withColumn("__shard", _shard(F.col("__key"), shards))
                asked = asked.join(named, "__shard", "left").drop("__shard")
                bits.append(F.col(f"__b{level}"))
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            passed = _passes(F.col("__key"), bits[level], level, self.levels[level][1])
            answer = F.when(passed, answer).otherwise(F.lit(level % 2 == 1))
        asked = asked.withColumn("__flag", F.col("__key").isNotNull() & answer)
        return asked.select("__row.*", F.col("__flag").alias(name))


def build_cascade(
    universe: DataFrame,
    bits_per_key: int = BITS_PER_KEY,
    max_shard_bytes: int = MAX_SHARD_BYTES,
) -> Cascade:
    """A cascade over ``universe`` (``key string, listed boolean``).

    Null keys are left out; a key that is listed in any of its rows is listed.
    Without a listed key the cascade has no level and lists nothing. Each level
    is written to the scratch folder, and only counts come to the driver.
    """
    keys = staged(
        universe.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.bool_or(F.coalesce(F.col("listed"), F.lit(False))).alias("listed")),
        "universe",
    )
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    n = inside.count()
    levels: list[tuple[DataFrame, int, int]] = []
    while n:
        bits, shards = _shape(inside, n, bits_per_key, max_shard_bytes)
        table = staged(_filter(inside, len(levels), bits, shards), "bloom")
        levels.append((table, bits, shards))
        through = staged(_let_through(outside, table, len(levels) - 1, bits, shards), "through")
        inside, outside, n = through, inside, through.count()
    return Cascade(levels)


def _shape(keys: DataFrame, n: int, bits_per_key: int, max_shard_bytes: int) -> tuple[int, int]:
    """Bits of a shard and number of shards for ``n`` keys of a level.

    Every level has its own: the keys let through by a level of few listed keys can be many
    more than those. Shards are added until the largest one is within the bound, which is
    no less than a word or the bits of one key.
    """
    most = 64 * max(max_shard_bytes // 8, -(-bits_per_key // 64))
    shards = -(-n * bits_per_key // most)
    while True:
        size = _largest_shard(keys, shards) if shards > 1 else n
        bits = 64 * -(-size * bits_per_key // 64)
        if bits <= most or size == 1:
            return bits, shards
        shards = shards + -(-shards * (bits - most) // most)


def _let_through(
    keys: DataFrame, table: DataFrame, level: int, bits: int, shards: int
) -> DataFrame:
    """The keys that a level does not stop."""
    if shards == 1:
        return keys.where(_passes(F.col("key"), table.select("bits").scalar(), level, bits))
    met = keys.withColumn("shard", _shard(F.col("key"), shards)).join(table, "shard")
    return met.where(_passes(F.col("key"), F.col("bits"), level, bits)).select("key")


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    """Bit positions of a key on a level, by double hashing."""
    first, step = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    low = [F.pmod(h, F.lit(bits)) for h in (first, step)]
    return [F.pmod(low[0] + F.lit(i) * low[1] + F.lit(i * i), F.lit(bits)) for i in range(HASHES)]


def _passes(key: Column, words: Column, level: int, bits: int) -> Column:
    def is_set(at: Column) -> Column:
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        return F.getbit(word, (at % 64).cast("int")) == 1

    tests = [F.coalesce(is_set(at), F.lit(False)) for at in _positions(key, level, bits)]
    return reduce(lambda a, b: a & b, tests)


def _filter(keys: DataFrame, level: int, bits: int, shards: int) -> DataFrame:
    """One row per shard: the filter's words in order, words without a bit as 0."""
    spark = keys.sparkSession
    at = F.col("at")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))
    marks = (
        keys.select(
            _shard(F.col("key"), shards).alias("shard"),
            F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("at"),
        )
        .select("shard", F.shiftright(at, 6).alias("word"), one.alias("bit"))
    )
    words = bits // 64
    zeros = spark.range(shards * words).select(
        F.expr(f"cast(id div {words} as int)").alias("shard"),
        (F.col("id") % words).alias("word"),
        F.lit(0).cast("bigint").alias("bit"),
    )
    ored = marks.union(zeros).groupBy("shard", "word").agg(F.bit_or("bit").alias("bit"))
    listed = F.sort_array(F.collect_list(F.struct("word", "bit")))
    return ored.groupBy("shard").agg(F.transform(listed, lambda x: x["bit"]).alias("bits"))


def _largest_shard(keys: DataFrame, shards: int) -> int:
    sizes = keys.groupBy(_shard(F.col("key"), shards).alias("s")).count()
    return sizes.agg(F.max("count")).first()[0]


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    listed: DataFrame | None = None,
    url: str = "url",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` (allow or block).

    ``listed`` is a table of blocked hosts in a column ``host``; by default the
    hosts of ``pages`` that have a listed word. The universe of the cascade is
    every host of ``pages``. A url without a fitting rule is blocked if its host
    is listed. Null and broken urls have an empty host and path and are allowed.
    Input columns of those five names are replaced.
    """
    own = ("host", "path", "rule", "listed", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in own]
    column = F.col(f"`{url}`")
    hosts = pages.select(host_of(column).alias("key"))
    if listed is None:
        universe = hosts.distinct().select("key", has_listed_word(F.col("key")).alias("listed"))
    else:
        named = listed.select(F.col("host").alias("key"), F.lit(True).alias("listed"))
        universe = hosts.distinct().select("key", F.lit(False).alias("listed")).union(named)
    cascade = build_cascade(universe)
    rows = pages.select(*kept, host_of(column).alias("host"), path_of(column).alias("path"))
    rows = cascade.flag(rows, F.col("host"), "listed")
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("*", rule.alias("rule"), F.coalesce(says, method).alias("verdict"))
