import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabflow.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " \t\n\x0b\x0c\r ", "Don't STOP... it's 2.5&& Écolé, ÉCOLE!", "a <|endoftext|> b<|endoftext|>. <|ENDOFTEXT|>",
    "x|y | || |", "x\x1cy z w", "ǅ ﬁ ẞ ΣΣ. İx", "é ́a. á.", "中文。\U0001d400", "a" * 5000,
]


@pytest.mark.parametrize("bits", [1, 3, 7, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    draw = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = draw.integers(0, 1 << bits, n).astype(np.uint32)
        payload = tokens.pack(ids, bits)
        assert len(payload) == -(-n // 64) * 8 * bits
        assert (tokens.unpack(payload, bits, 0, n) == ids).all()
        if n > 10:
            assert (tokens.unpack(payload, bits, 7, n - 2) == ids[7 : n - 2]).all()


def test_fewest_bits():
    assert [tokens.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65536)] == [1, 1, 2, 8, 9, 16, 16]


def test_by_word_gives_the_same_ids():
    draw = random.Random(3)
    chars = "aAbé.,;'!|<>&*- \n\t1²́ßΣ中"
    texts = ODD + ["".join(draw.choices(chars, k=draw.randint(0, 80))) for _ in range(400)]
    by_word, plain = tokens.Encoder(PATH, True), tokens.Encoder(PATH, False)
    batch = pa.array(texts, pa.string())
    assert by_word.encode(batch, 2) == plain.encode(batch, 2)
    assert by_word.encode(batch.slice(5, 9), 2) == plain.encode(batch.slice(5, 9), 2)


def test_full_caches_and_equal_fingerprints_change_no_ids(monkeypatch):
    draw = random.Random(4)
    plain = tokens.Encoder(PATH, False)
    monkeypatch.setattr(tokens, "CACHED_WORDS", 40)
    monkeypatch.setattr(tokens, "CACHED_STEMS", 10)
    prints = tokens.word_prints

    def weak(*args):
        starts, stops, one, two = prints(*args)
        return starts, stops, one % np.uint64(3), two

    for by_word in (tokens.Encoder(PATH, True), tokens.Encoder(PATH, True)):
        for _ in range(12):
            texts = pa.array([" ".join(draw.choices(["Ab,", "ab", "c.", "é!", "x|y", "word" + "s" * draw.randint(0, 60)], k=9)) for _ in range(6)])
            assert by_word.encode(texts, 2) == plain.encode(texts, 2)
        monkeypatch.setattr(tokens, "word_prints", weak)
    assert by_word.encode(pa.array([], pa.string()), 2) == []


@pytest.mark.parametrize("by_word", [True, False])
def test_written_ids_are_read_back(spark, docs, tmp_path, by_word):
    rows = [(i * 7 % 31, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "again"), (3, "again")]
    folder = str(tmp_path / "ids")
    tokens.write_tokens(docs(*rows), folder, PATH, end_id=2, by_word=by_word)
    read = sorted(tokens.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(PATH)
    wanted = sorted(
        ((-1 if i is None else i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows),
        key=lambda r: r[0],
    )
    assert [-1 if r.doc_id is None else r.doc_id for r in read] == [i for i, _ in wanted]
    assert sorted(map(str, ((r.doc_id, r.ids) for r in read if r.doc_id is not None))) == sorted(map(str, (w for w in wanted if w[0] >= 0)))
    at = 0
    for r in read:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    sums = {r.start: r for r in tokens.token_checksums(spark, folder).collect()}
    for r in read:
        assert sums[r.start].ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    stream = [i for r in read for i in r.ids]
    got = sorted(tokens.read_range(spark, folder, 5, at - 3).collect())
    assert [i for r in got for i in r.ids] == stream[5 : at - 3]


def test_an_empty_table(spark, docs, tmp_path):
    tokens.write_tokens(docs(), str(tmp_path / "none"), PATH)
    assert tokens.read_tokens(spark, str(tmp_path / "none")).collect() == []


def test_rows_without_an_id_are_shared_by_tasks(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 4_000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")
    )
    folder = str(tmp_path / "ids")
    tokens.write_tokens(rows, folder, PATH, end_id=2, by_word=True)
    blocks = spark.read.parquet(f"{folder}/blocks")
    spread = blocks.where(F.exists("doc_ids", lambda i: i.isNull())).select("part").distinct().count()
    assert spread > 1
    read = tokens.read_tokens(spark, folder).orderBy("start").collect()
    ids = [r.doc_id for r in read]
    assert ids == [None] * 2_000 + list(range(0, 4_000, 2))
