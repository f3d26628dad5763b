"""Secrets in texts: three patterns, and strings that pass a battery of randomness tests.

Candidates are runs of letters, digits and ``+ / _ -`` of ``LEAST_LENGTH`` or more that
hold a letter and a digit. From its characters the encoding of a candidate is
inferred, and with it the alphabet a random string would use. Three tests ask whether
it is one: chi-squared for a uniform use of the alphabet, the number of runs above and
below its middle, and the correlation of neighbours. The least of the three p-values,
times three, is the candidate's.

Over the candidates of each length class (from a power of two to the next) a step-up
procedure (Benjamini and Hochberg) then rejects the ones that are not random. The
false discovery rate bounds the share of random strings among those rejected of a
class. What is left is reported. Within a class p-values have no weights, so a random
string is lost with a probability below that rate, whatever its length and whatever
the other classes hold; length only raises the power of the tests.

All of it is built-in functions; texts are read once and never shuffled. Only the
thresholds, one per length class, come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.scratch import staged

# Pattern, group whose length counts, and least length, by kind.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PATTERNS = (
    (ASSIGN, 2, 8),
    (r"AKIA[A-Z0-9]+", 0, 16),
    (r"[0-9a-f]{32,}", 0, 32),
)

#: Characters of a candidate for the tests, at least.
LEAST_LENGTH = 20
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{%d,}"
    % LEAST_LENGTH
)
#: Share of random strings among the rejected, at most.
FALSE_DISCOVERIES = 0.05

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
# Encodings, smallest first, as a pattern of all characters and an alphabet.
# Long strings of an encoding pass no test against the alphabet of a larger one.
ENCODINGS = (
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", _LOWER.upper() + "234567"),
    ("^[a-z2-7]+$", _LOWER + "234567"),
    ("^[0-9a-z]+$", _DIGITS + _LOWER),
    ("^[0-9A-Z]+$", _DIGITS + _LOWER.upper()),
    ("^[1-9A-HJ-NP-Za-km-z]+$", _BASE58),
    ("^[0-9A-Za-z]+$", _DIGITS + _LOWER.upper() + _LOWER),
    ("^[0-9A-Za-z_-]+$", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
    ("^[0-9A-Za-z+/]+$", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
    ("", _LOWER.upper() + _LOWER + _DIGITS + "+/-_"),
)

_BLOCK = 64  # elements of an array in a block of running sums
_BINS_PER_E = 100  # resolution of the histogram of -log(p)
_LOWEST = 1e-300


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, for z of any sign (Abramowitz and Stegun 26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + F.lit(0.2316419) * x)
    poly = F.lit(0.0)
    for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = (poly + F.lit(c)) * t
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _tested(tokens: str) -> Column:
    """Per element of an array of candidates: its length and combined p-value."""

    def values(t: Column) -> Column:
        return F.transform(
            F.split(t["text"], ""),
            lambda c: (F.call_function("locate", c, t["alphabet"]) - 1).cast("double"),
        )

    alphabet = lambda t: F.coalesce(
        *[F.when(t.rlike(p), F.lit(a)) for p, a in ENCODINGS if p], F.lit(ENCODINGS[-1][1])
    )
    named = F.transform(tokens, lambda t: F.struct(t.alias("text"), alphabet(t).alias("alphabet")))
    # each step is a struct of its own, so nothing is computed once per character
    read = F.transform(
        named,
        lambda t: F.struct(
            t["text"].alias("text"),
            t["alphabet"].alias("alphabet"),
            values(t).alias("x"),
            F.length(t["text"]).cast("double").alias("n"),
            F.length(t["alphabet"]).cast("double").alias("k"),
        ),
    )
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    summed = F.transform(
        read,
        lambda t: F.struct(
            t["n"].alias("n"),
            t["k"].alias("k"),
            t["x"].alias("x"),
            F.transform(t["x"], lambda v: (v >= t["k"] / 2).cast("double")).alias("high"),
            (total(t["x"]) / t["n"]).alias("mean"),
            total(
                F.transform(
                    F.split(t["alphabet"], ""),
                    lambda c: F.pow(t["n"] - F.length(F.replace(t["text"], c, F.lit(""))), F.lit(2.0)),
                )
            ).alias("squares"),
        ),
    )

    def neighbours(a: Column, f) -> Column:
        rest = F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))
        first = F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))
        return total(F.zip_with(first, rest, f))

    measured = F.transform(
        summed,
        lambda t: F.struct(
            t["n"].alias("n"),
            t["k"].alias("k"),
            (t["squares"] * t["k"] / t["n"] - t["n"]).alias("chi"),
            total(t["high"]).alias("high"),
            (neighbours(t["high"], lambda a, b: F.abs(a - b)) + 1).alias("runs"),
            neighbours(t["x"], lambda a, b: (a - t["mean"]) * (b - t["mean"])).alias("joint"),
            total(F.transform(t["x"], lambda v: F.pow(v - t["mean"], F.lit(2.0)))).alias("spread"),
        ),
    )

    def p_value(t: Column) -> Column:
        n, df, low = t["n"], t["k"] - 1, t["n"] - t["high"]
        cube = F.pow(t["chi"] / df, F.lit(1 / 3))  # Wilson and Hilferty
        chi = _upper_tail((cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        mean = 2 * t["high"] * low / n + 1
        spread = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
        runs = F.when(
            (t["high"] > 0) & (low > 0) & (spread > 0),
            2 * _upper_tail(F.abs(t["runs"] - mean) / spread),
        ).otherwise(F.pow(F.lit(2.0), 1 - n))
        joint = F.when(
            t["spread"] > 0, 2 * _upper_tail(F.abs(t["joint"] / t["spread"]) * F.sqrt(n))
        ).otherwise(F.lit(0.0))
        return F.least(F.lit(1.0), 3 * F.least(chi, runs, joint))

    return F.transform(
        measured, lambda t: F.struct(t["n"].cast("int").alias("n"), p_value(t).alias("p"))
    )


def _let(value: Column, body) -> Column:
    """The body over a value that is computed once, also where its lambdas use it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join, levels: int = 2) -> Column:
    """Running results of an associative function over an array of integers from 0 on.

    Each step copies what its block has so far, so blocks are short; the results of whole
    blocks are run over in the same way. The work stays in proportion to the array.
    """
    none = F.array().cast("array<int>")

    def plain(v: Column) -> Column:
        last = lambda acc: F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))
        return F.aggregate(v, none, lambda acc, x: F.concat(acc, F.array(join(last(acc), x))))

    if not levels:
        return plain(values)

    def added(blocks: Column, totals: Column) -> Column:
        before = lambda i: F.coalesce(F.get(totals, i - 1), F.lit(0))
        moved = lambda block, i: _let(before(i), lambda t: F.transform(block, lambda x: join(t, x)))
        return F.flatten(F.transform(blocks, moved))

    def blocked(v: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(v), F.lit(_BLOCK))
        whole = F.transform(firsts, lambda first: plain(F.slice(v, first, F.lit(_BLOCK))))
        total = lambda blocks: F.transform(blocks, lambda block: F.element_at(block, -1))
        return _let(
            whole,
            lambda blocks: _let(
                _running(total(blocks), join, levels - 1), lambda totals: added(blocks, totals)
            ),
        )

    return _let(values, lambda v: F.when(F.size(v) > _BLOCK, blocked(v)).otherwise(plain(v)))


def _placed(found: str, gaps: str, kept: str, kind: int) -> Column:
    """Spans (start, kind, end) of the matches kept, from their texts and those between them."""
    sizes = F.zip_with(
        found,
        gaps,
        lambda m, g: F.struct(
            F.coalesce(F.length(m), F.lit(0)).alias("size"), F.length(g).alias("gap")
        ),
    )

    def spans(sizes: Column) -> Column:
        ends = _running(F.transform(sizes, lambda s: s["gap"] + s["size"]), lambda a, b: a + b)
        return F.zip_with(
            sizes,
            ends,
            lambda s, end: F.struct(
                (end - s["size"]).alias("start"), F.lit(kind).alias("kind"), end.alias("end")
            ),
        )

    # behind the last gap comes no match, so nothing says that it is kept
    marked = F.zip_with(
        _let(sizes, spans), kept, lambda s, k: F.struct(s.alias("span"), F.coalesce(k, F.lit(False)).alias("kept"))
    )
    return F.transform(F.filter(marked, lambda m: m["kept"]), lambda m: m["span"])


def _apart(tests: str, base: str) -> Column:
    """The tests whose span touches none of the base.

    Base spans are put in order by their start and tests by their end: the largest end of
    the base spans before a test's end says whether one of them reaches past its start.
    """
    blank = F.lit(None).cast("struct<n:int,p:double>")
    events = F.concat(
        F.transform(
            tests,
            lambda t: F.struct(
                t["span"]["end"].alias("at"), F.lit(0).alias("reach"), t["span"].alias("span"), t["test"].alias("test")
            ),
        ),
        F.transform(
            base,
            lambda s: F.struct(
                s["start"].alias("at"), s["end"].alias("reach"), s.alias("span"), blank.alias("test")
            ),
        ),
    )

    def chosen(events: Column) -> Column:
        reaches = _running(F.transform(events, lambda e: e["reach"]), F.greatest)
        seen = F.zip_with(events, reaches, lambda e, r: F.struct(e.alias("event"), r.alias("reach")))
        alone = F.filter(
            seen, lambda s: s["event"]["test"].isNotNull() & (s["reach"] <= s["event"]["span"]["start"])
        )
        return F.transform(
            alone, lambda s: F.struct(s["event"]["span"].alias("span"), s["event"]["test"].alias("test"))
        )

    return _let(F.sort_array(events), chosen)


def _at_least(least: int):
    return lambda value: F.length(value) >= least


def _texts(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(shown, ",")


def scan_secrets(
    docs: DataFrame,
    false_discoveries: float = FALSE_DISCOVERIES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: id, ``n_assign, n_access, n_hex, n_random``, ``base``, ``spans``.

    Both are arrays of (start, kind, end) in code points, end exclusive, sorted;
    ``base`` has the kinds 0 to 2 of ``KINDS``, ``spans`` the random strings as well
    that touch none of those. Matches are leftmost and do not overlap within a kind.
    A null text is an empty one. Whole texts are searched, in time that grows with their
    length and matches (times a logarithm of the latter).
    """
    text = F.col("text")
    none = F.array().cast("array<string>")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    every = [*PATTERNS, (CANDIDATE, 0, LEAST_LENGTH)]
    found = [
        F.when(text.rlike(p), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none)
        for p, _, _ in every
    ]
    rows = rows.select("*", *[f.alias(f"found{i}") for i, f in enumerate(found)])
    parts = []
    for i, (p, group, least) in enumerate(every):
        some = F.size(f"found{i}") > 0
        parts.append(F.when(some, F.split(text, p, -1)).otherwise(none).alias(f"gaps{i}"))
        value = F.regexp_extract_all(text, F.lit(p), F.lit(group)) if group else F.col(f"found{i}")
        kept = F.transform(value, _at_least(least))
        parts.append(F.when(some, kept).otherwise(F.array().cast("array<boolean>")).alias(f"kept{i}"))
    rows = rows.select("*", *parts).drop("text")
    spans = [_placed(f"found{i}", f"gaps{i}", f"kept{i}", i) for i in range(len(every))]
    rows = rows.select(
        "id",
        F.sort_array(F.concat(*spans[:3])).alias("base"),
        F.zip_with(
            spans[3], _tested("found3"), lambda s, t: F.struct(s.alias("span"), t.alias("test"))
        ).alias("tests"),
    )
    rows = staged(
        rows.withColumn(
            "tests", F.when((F.size("base") > 0) & (F.size("tests") > 0), _apart("tests", "base")).otherwise(F.col("tests"))
        ),
        "secrets",
    )
    limits = _thresholds(rows, false_discoveries)
    limit = lambda n: F.coalesce(
        *[F.when(_length_class(n) == c, F.lit(edge)) for c, edge in sorted(limits.items())], F.lit(0.0)
    )
    is_random = lambda t: t["test"]["p"] > limit(t["test"]["n"])
    random = F.transform(F.filter("tests", is_random), lambda t: t["span"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(
        F.col("id").alias(id_col),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.size(random).cast("bigint").alias("n_random"),
        "base",
        F.sort_array(F.concat("base", random)).alias("spans"),
    )


def _length_class(n: Column) -> Column:
    """The power of two that a length reaches."""
    return F.length(F.bin(n)) - 1


def _thresholds(rows: DataFrame, rate: float) -> dict[int, float]:
    """Per length class with rejections, the largest p-value rejected.

    p-values are summed in a histogram of their logarithm, whose size does not
    depend on the input, and each counts as its bin's upper end.
    """
    tests = rows.select(F.explode("tests.test").alias("t")).select("t.n", "t.p")
    at = F.floor(-F.log(F.greatest(F.col("p"), F.lit(_LOWEST))) * _BINS_PER_E)
    bins = tests.groupBy(_length_class(F.col("n")).alias("class"), at.alias("bin")).count()
    of = Window.partitionBy("class")  # at most a few ten thousand bins
    edge = F.exp(-F.col("bin") / _BINS_PER_E)
    passed = bins.select(
        "class",
        edge.alias("edge"),
        F.sum("count").over(of.orderBy(F.desc("bin"))).alias("rank"),
        F.sum("count").over(of).alias("m"),
    ).where(F.col("edge") * F.col("m") <= F.lit(rate) * F.col("rank"))
    return dict(map(tuple, passed.groupBy("class").agg(F.max("edge")).collect()))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The scan as counts, a hash of the base spans and a text of all spans."""
    return found.select(
        id_col,
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_texts(F.col("base")), 256).alias("base_sha256"),
        _texts(F.col("spans")).alias("spans"),
    )
