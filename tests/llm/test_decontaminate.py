import random

import corpus_pipeline
from tabflow.llm import decontaminate as dec
from tests.llm import plain


def test_bit_parallel_distance():
    draw = random.Random(1)
    for _ in range(200):
        a = bytes(draw.choices(b"ab", k=draw.randint(1, 90)))
        b = bytes(draw.choices(b"ab", k=draw.randint(0, 120)))
        best = plain.edit_distance(a, b)
        got = dec.best_substring(a, b, len(a) - 1)
        assert (got[0] if got else len(a)) == best
        assert dec.best_substring(a, b, best - 1) is None


def items_and_docs(words):
    draw = random.Random(4)
    items = [(i, " ".join(words(draw.randint(3, 40))).capitalize() + ".") for i in range(25)]
    rows = []
    for i in range(120):
        copy = list(draw.choice(items)[1])
        for _ in range(draw.randint(0, 14)):
            at = draw.randrange(len(copy))
            copy[at : at + 1] = draw.choice([[], ["q"], [copy[at], "z"]])
        before, after = " ".join(words(draw.randint(0, 30))), " ".join(words(draw.randint(0, 30)))
        rows.append((i, f"{before} {''.join(copy)}\n{after}"))
    return items, rows


def test_items_found_agree_with_all_pairs(spark, docs, words):
    items, rows = items_and_docs(words)
    wanted = set()
    for i, text in rows:
        text = dec.normalised(text)
        for n, item in items:
            item = dec.normalised(item)
            distance = plain.edit_distance(item, text)
            if distance <= dec.allowed_errors(len(item)):
                wanted.add((i, n, distance))
    table = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (dec.BLOCK_BYTES, 500):
        got = dec.find_items(docs(*rows), table, block_bytes=block)
        assert {(r.doc_id, r.item_id, r.distance) for r in got.collect()} == wanted
    assert 20 < len(wanted)
    left = dec.without_items(docs(*rows), table)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {i for i, _, _ in wanted}


def test_odd_rows(spark, docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "abc def"), (4, "abc def")], "item_id int, text string")
    df = docs((1, None), (2, ""), (None, "xx ABC  Def yy"), (5, "abc de"), (6, "x " * 30000 + "abc, def"), (6, "abc def"))
    got = sorted(map(str, ((r.doc_id, r.item_id, r.distance) for r in dec.find_items(df, items).collect())))
    assert got == sorted(map(str, [(None, 4, 0)] * 2 + [(6, 4, 0)] * 4))
    left = dec.without_items(df, items)
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "5", "None"]
    assert dec.find_items(docs(), items).collect() == []
    assert dec.find_items(df, items.limit(0)).collect() == []


def test_exact_items_match_whole_words(spark, docs):
    items = spark.createDataFrame([(1, "The art"), (2, "é")], "item_id int, text string")
    df = docs((1, "bathe artist"), (2, "bathe art"), (3, "the artist"), (4, "The art!"), (5, "bathe arts, the ART of"), (6, "né é"), (7, "éé"))
    got = sorted((r.doc_id, r.item_id, r.found) for r in dec.find_items(df, items).collect())
    assert got == [(4, 1, "the art"), (5, 1, "the art"), (6, 2, "é")]
    assert sorted(r.doc_id for r in dec.without_items(df, items).collect()) == [1, 2, 3, 7]


def test_the_stage_decides_row_by_row(spark, docs, tmp_path):
    items = spark.createDataFrame([(1, "alpha beta gamma"), (2, "one two three"), (3, None)], "item_id bigint, text string")
    df = docs((None, "x Alpha beta, gamma y"), (None, "clean"), (5, "one two three"), (5, "clean"), (5, "clean"), (6, None))
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    staged = corpus_pipeline.drop_benchmark_items(spark, df, str(tmp_path))
    for left in (staged, dec.clean_rows(df, items, block_bytes=5)):
        assert left.columns == df.columns
        got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
        assert got == sorted([(None, "clean"), (5, "clean"), (5, "clean"), (6, None)], key=str)
    assert dec.clean_rows(docs(), items).collect() == []
    assert dec.clean_rows(df, items.limit(0)).count() == 6
