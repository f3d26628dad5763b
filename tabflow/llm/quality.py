"""Quality rules: counts of each text, and a log-likelihood ratio of its n-grams.

Tokens are runs of letters and digits and runs of other characters; single tokens
and pairs of neighbours are hashed into ``BUCKETS``. Their counts over all documents
and over trusted ones make two multinomial models. A text's score is the mean over
its n-grams of the logarithm of the trusted model's probability over the raw one's;
texts below ``LEAST_SCORE`` are dropped. (The ratio is that of importance resampling
for data selection, with a fixed threshold for every text in place of a draw.)

All of it is built-in functions. The models are one array of ``BUCKETS`` numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000
#: Trusted documents that the target model is counted on, at most.
TRUSTED_ROWS = 20_000
#: n-grams added to the trusted counts, spread like the raw ones. With few trusted
#: documents all ratios stay near 0, so that unseen words do not drop clean texts.
PRIOR = 20_000
#: Mean log ratio per n-gram below which a text is dropped.
LEAST_SCORE = -0.25

BLANK = r"[\x20\x09-\x0D]+"
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
SYMBOL = r"[#*$%&|<>]"

_PLACE_BITS = 30  # a text of 2 GB has no more words


def words_of(text: Column) -> Column:
    """Runs of anything but U+0020 and U+0009 to U+000D; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (bigint).

    ``n_repeat_words`` counts the words in 3-word windows that the text has at least
    twice. Windows are told apart by 64-bit hashes. Sorting them brings equal ones
    together, so the work grows with ``n log n`` in the words of a text.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.select(
        *names,
        words_of(text).alias("__words"),
        with_word.alias("__lines"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
    )
    out = out.select(
        *names,
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    hashes = F.col("__hashes")
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0)))
    windows = F.transform(
        starts, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))
    )
    out = out.withColumn("__windows", windows).drop("__hashes")
    # The first sort is one of plain longs, of a part of the hash and the position; only
    # neighbours that agree in that part are compared in full. Each step is a column
    # of its own, as a lambda would compute what stands in it once per element.
    low = F.lit((1 << _PLACE_BITS) - 1)
    unique = F.size("__windows") == F.size(F.array_distinct("__windows"))
    packed = F.transform(
        "__windows", lambda w, i: w.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint"))
    )
    none = F.array().cast("array<bigint>")
    out = out.withColumn("__sorted", F.when(unique, none).otherwise(F.sort_array(packed)))
    likely = _with_equal_neighbour(F.col("__sorted"), lambda x: F.shiftright(x, _PLACE_BITS))
    found = F.transform(
        F.transform(likely, lambda x: x.bitwiseAND(low).cast("int")),
        lambda p: F.struct(F.get("__windows", p).alias("w"), p.alias("p")),
    )
    out = out.withColumn("__sorted", F.sort_array(found)).drop("__windows")
    same = _with_equal_neighbour(F.col("__sorted"), lambda s: s["w"])
    out = out.withColumn("__places", F.sort_array(F.transform(same, lambda s: s["p"])))
    places = F.col("__places")
    covered = F.transform(
        places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0), lambda a, b: a + b)
    return out.withColumn("n_repeat_words", total.cast("bigint")).drop("__sorted", "__places")


def _with_equal_neighbour(values: Column, key) -> Column:
    """The elements of a sorted array whose key is also that of an element beside them."""

    def equal(x: Column, i: Column) -> Column:
        before = F.when(i > 0, key(F.get(values, i - 1)) == key(x))
        after = key(F.get(values, i + 1)) == key(x)
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.filter(values, equal)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """The base rules: too short, or too many words in repeated windows."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _token_hashes(text: Column) -> Column:
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _ngrams(hashes: Column, buckets: int) -> Column:
    """Buckets of the tokens and of the pairs of neighbouring tokens."""
    pairs = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def log_ratios(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    trusted_rows: int = TRUSTED_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row with ``ratios``: per bucket, log of trusted over raw probability.

    Trusted are documents with a label above 0, at most ``trusted_rows`` of them, by
    a hash of the id. Raw counts cover every document. The trusted counts get
    ``PRIOR`` n-grams spread like the raw ones, which bounds the ratios below; without
    trusted documents all ratios are 0.
    """
    named = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
    trusted = (
        named.where(F.col("id").isNotNull() & (F.col("label") > 0))
        .select("id")
        .distinct()
        .orderBy(F.xxhash64("id"), "id")
        .limit(trusted_rows)
        .withColumn("trusted", F.lit(1))
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # at most trusted_rows ids
    marked = rows.join(F.broadcast(trusted), "id", "left").select(
        F.coalesce("trusted", F.lit(0)).alias("trusted"), _token_hashes(F.col("text")).alias("hashes")
    )
    grams = marked.select("trusted", F.explode(_ngrams(F.col("hashes"), buckets)).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("own"))
    every = docs.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("bucket"), F.lit(1).cast("bigint").alias("raw"), F.lit(0).cast("bigint").alias("own")
    )
    counts = counted.union(every).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("own").alias("own"))
    row = counts.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "own"))).alias("all"),
        F.sum("raw").alias("raw"),
        F.sum("own").alias("own"),
    )
    p = lambda c: c["raw"] / F.col("raw")
    ratio = lambda c: F.log((c["own"] + PRIOR * p(c)) / (F.col("own") + PRIOR) / p(c))
    return row.select(F.transform("all", ratio).alias("ratios"))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    least_score: float = LEAST_SCORE,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: id, the counts, ``base_failed``, ``score`` and ``kept``.

    ``kept`` is false if a base rule fails or the score is below ``least_score``. A
    text without tokens scores 0 (and is too short). Other columns are not read.
    """
    ratios = log_ratios(docs, labels, buckets, id_col=id_col, text_col=text_col)
    model = F.lit(np.array(ratios.first()["ratios"]))  # ``buckets`` numbers
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    counted = with_counts(rows, "__text")
    hashed = counted.withColumn("__hashes", _token_hashes(F.col("__text"))).drop("__text")
    grams = hashed.withColumn("__grams", _ngrams(F.col("__hashes"), buckets)).drop("__hashes")
    total = F.aggregate("__grams", F.lit(0.0), lambda a, b: a + F.get(model, b))
    score = F.when(F.size("__grams") > 0, total / F.size("__grams")).otherwise(F.lit(0.0))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (
        grams.withColumn("score", score)
        .withColumn("base_failed", failed)
        .select(
            F.col("__id").alias(id_col),
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "score",
            (~F.col("base_failed") & (F.col("score") >= least_score)).alias("kept"),
        )
    )
