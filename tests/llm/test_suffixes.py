import random

import numpy as np
import pytest

from tabflow.llm import suffixes
from tests.llm import plain


def test_suffix_array_agrees_with_sorting():
    draw = np.random.default_rng(1)
    for _ in range(200):
        s = draw.integers(1, 1 + draw.integers(1, 5), draw.integers(0, 70))
        assert suffixes.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()}


@pytest.mark.parametrize("class_bytes", [1 << 20, 0])
def test_removed_bytes_agree_with_all_windows(docs, words, class_bytes):
    draw = random.Random(8)
    text = lambda n: " ".join(words(n))
    passage, line = text(40), text(25)
    rows = [(i, text(draw.randint(1, 60))) for i in range(10)]
    rows += [(20 + i, f"{text(draw.randint(0, 9))} {passage} {text(5)}") for i in range(8)]
    rows += [(40 + i, f"{passage[i:-i]} {text(30)} {passage[: 99 + i]}") for i in range(1, 6)]
    rows += [(60, f"{line}\n{line}\n{line}"), (61, "a" * 500), (62, "ab" * 300), (63, "é" * 120)]
    rows += [(64, passage[:99]), (65, passage[:100]), (66, rows[3][1]), (67, None), (68, "")]
    rows += [(i + 100, t) for i, t in rows[:12]]
    got = found(suffixes.without_repeats(docs(*rows), class_bytes))
    assert got == plain.repeats(rows)


def test_rows_without_id_and_repeated_ids(docs):
    text = "".join(f"{i:x}/" for i in range(60))
    df = docs((None, text), (5, text), (5, text), (3, text))
    got = [(r.doc_id, r.n_removed) for r in suffixes.without_repeats(df).collect()]
    assert sorted(got, key=str) == sorted([(3, len(text)), (5, len(text)), (5, len(text)), (None, 0)], key=str)
    assert suffixes.without_repeats(docs()).collect() == []


@pytest.mark.parametrize("class_bytes", [1 << 20, 0])
def test_different_texts_of_one_id_are_cut_by_their_own_spans(docs, words, class_bytes):
    a, b, c, d = (" ".join(words(60)) for _ in range(4))
    twice = f"{c} {c}"
    rows = [(3, a), (5, a), (5, b), (5, b), (7, twice), (7, d), (None, twice), (None, d), (None, d), (None, None)]
    left = suffixes.without_repeats(docs(*rows), class_bytes)
    got = sorted(((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in left.collect()), key=str)
    size = lambda t: len(t or "")
    # rows without an id come first, so their texts stay but for what repeats within one
    once = twice[: kept_once(twice)]
    kept = [(3, a, a), (5, a, ""), (5, b, b), (5, b, b), (7, twice, ""), (7, d, "")]
    kept += [(None, twice, once), (None, d, d), (None, d, d), (None, None, "")]
    assert got == sorted(((i, size(t), k) for i, t, k in kept), key=str)


def kept_once(text):
    """Bytes of a text of two copies that plain rules keep, all at its beginning."""
    kept = plain.repeats([(1, text)])[1][3].decode()
    assert text.startswith(kept) and len(kept) < len(text)
    return len(kept)


def test_passages_shared_by_texts_of_one_id_stay_once(docs, words):
    passage = " ".join(words(40))
    texts = [f"{' '.join(words(30))} {passage} {' '.join(words(30))}" for _ in range(6)]
    rows = [(None, t) for t in texts[:3]] + [(4, t) for t in texts[3:]]
    left = suffixes.without_repeats(docs(*rows)).collect()
    assert sum(passage.encode() in bytes(r.kept) for r in left) == 1
    assert sorted(r.n_spans for r in left) == [0, 1, 1, 1, 1, 1]
    assert next(r.doc_id for r in left if not r.n_spans) is None
