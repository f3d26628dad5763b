"""From raw documents to packed token ids: five stages of the training-data operators.

Each stage gets ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``. A null text counts as an empty one throughout.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import decontaminate, minhash, mixing, tokens, toxicity
from tabflow.llm.queries import END_ID, TOKENIZER
from tabflow.scratch import scratch_path, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    The lexicon is learned from labelled rows of these documents that are not held
    out. Empty texts score low and stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 similarity of five-word shingles.

    The smallest id stays. Empty texts are linked with nothing and stay.
    """
    return minhash.without_duplicates(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found, row by row."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_rows(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice.

    A document without words is in no mix. Rows are decided on one by one, also where ids are
    null or repeated, and keep all their columns.
    """
    row = "__row"
    while row in docs.columns:
        row += "_"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    mixed = mixing.mix(rows, F.array("source"), mixing.word_count(F.col("text")), row_col=row)
    chosen = mixed.where("taken > 0").select(row, F.sequence(F.lit(1), F.col("repeats")).alias("__turns"))
    each = rows.join(chosen, row).withColumn("__turn", F.explode("__turns"))
    return each.select(*[F.col(f"`{c}`") for c in docs.columns])


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids in a new folder, and every document's place in them, read back."""
    folder = scratch_path(spark, "tokens")
    path = public_tokenizers.path(TOKENIZER)
    tokens.write_tokens(docs, folder, path, end_id=END_ID, by_word=True)
    return tokens.token_checksums(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_items),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


#: The learned lexicon, the hash of the mix and the tokenizer are beyond SQL.
ORACLE_SQL = None
