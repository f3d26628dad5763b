"""The registered queries of this subpackage; those that SQL can express have it in ``ORACLES``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import (
    copies,
    decontaminate,
    infill,
    licenses,
    minhash,
    mixing,
    phrases,
    quality,
    secrets,
    suffixes,
    tokens,
    toxicity,
    urls,
)
from tabflow.llm.oracles import ORACLES as ORACLES
from tabflow.scratch import scratch_path

# The tokenizer of the registered query and the end id after each text.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of two-word shingles."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the n-gram score of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.judge_quality(docs, labels)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then the cascade of hosts with a listed word, for every page."""
    judged = urls.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand earlier."""
    left = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model)
    out = toxicity.held_out(F.col("doc_id"))
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and notices with few errors in every document."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in every document, with its distance."""
    found = decontaminate.find_items(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "distance")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document a mix to target weights takes."""
    docs = _table(spark, sf_dir, "documents")
    size = mixing.word_count(F.col("text"))
    mixed = mixing.mix(docs, F.array("source"), size)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns and random strings in every document."""
    return secrets.digest(secrets.scan_secrets(_table(spark, sf_dir, "documents")))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the packed files, read back from them."""
    folder = scratch_path(spark, "tokens")
    path = public_tokenizers.path(TOKENIZER)
    docs = _table(spark, sf_dir, "documents")
    tokens.write_tokens(docs, folder, path, end_id=END_ID, by_word=True)
    return tokens.token_checksums(spark, folder)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document is cut, and hashes of what is made of it and of what that gives back."""
    made = infill.fill_in_middle(_table(spark, sf_dir, "documents"))
    restored = infill.original(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts, and which one stays."""
    return copies.find_copies(_table(spark, sf_dir, "documents"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filter": op3_url_filter,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_source_mixing": op6_source_mixing,
    "op7_license_scan": op7_license_scan,
    "op8_decontamination": op8_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_output": op10_token_output,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_phrase_mining": op13_phrase_mining,
}
