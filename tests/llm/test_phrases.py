import random
import re
from collections import Counter

import numpy as np
import pytest

from tabflow.llm import phrases, prints
from tests.llm.plain import LOWER


def counts(rows, longest=4):
    """{lang: Counter of phrases as tuples} and {lang: words}."""
    found, sizes = {}, Counter()
    for text, lang in rows:
        of = found.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return found, sizes


def brute(rows, support, longest=4, percent=80, top=2000):
    out = []
    found, sizes = counts(rows, longest)
    for lang, f in found.items():
        frequent = {p: a for p, a in f.items() if a >= support and len(p) > 1}
        longer = Counter()
        for p, a in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i : i + n]] = max(longer[p[i : i + n]], a)
        scored = []
        for p, a in frequent.items():
            cuts = [(2_000_000 * a // (f[p[:c]] + f[p[c:]]), c) for c in range(1, len(p))]
            score, c = min(cuts)
            if 100 * longer[p] < percent * a:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:c]], f[p[c:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


@pytest.fixture
def corpus(spark):
    def make(rows):
        named = [(i, t, lang, "s", 1, "x", 2) for i, (t, lang) in enumerate(rows)]
        schema = "doc_id bigint, text string, lang string, source string, n bigint, phrase string, k int"
        return spark.createDataFrame(named, schema)

    return make


def texts(seed, documents, words):
    draw = random.Random(seed)
    vocabulary = ["A", "bé", "c", "D-d", "e f", "\U0001f600", "g'", "H"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " - "]
    made = []
    for _ in range(documents):
        parts = [w + draw.choice(joins) for w in draw.choices(vocabulary, range(8, 0, -1), k=words)]
        made.append(("".join(parts), draw.choice(["en", "de", None, "und"])))
    return made


ODD = [(None, "en"), ("", "en"), ("   ", None), (".,;", "fr"), ("word", "fr"), ("a " * 30_000, "de")]


@pytest.mark.parametrize("support", [3, 30])
@pytest.mark.parametrize("bits", [4, 27])
def test_agrees_with_brute_force(corpus, support, bits):
    rows = texts(1, 60, 40) + ODD
    found = phrases.collocations(corpus(rows), support=support, bits=bits, sample=2)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    wanted = brute(rows, support)
    assert sorted(map(tuple, found.collect())) == wanted and wanted


def test_border_failures_are_followed(corpus, monkeypatch):
    """With no sample every frequent word is a failure, and so is every longer phrase in turn."""
    rows = texts(2, 80, 60)
    calls = []
    named = phrases._named

    def watched(df, marks, wanted, old, *rest):
        calls.append(old is not None)
        return named(df, marks, wanted, old, *rest)

    monkeypatch.setattr(phrases, "_named", watched)
    found = phrases.collocations(corpus(rows), support=5, sample=10**9)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5)
    assert calls == [False, True, True, True]


def test_parameters(corpus):
    rows = texts(3, 60, 40)
    found = phrases.collocations(corpus(rows), 4, longest=3, inside_percent=50, per_language=7, sample=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 3, 50, 7)
    pairs = phrases.collocations(corpus(rows), 4, longest=2)
    assert sorted(map(tuple, pairs.collect())) == brute(rows, 4, 2)


def test_repeated_rows_and_a_hot_language(corpus):
    rows = [("very common phrase here", "en")] * 500 + texts(4, 20, 30)
    assert sorted(map(tuple, phrases.collocations(corpus(rows)).collect())) == brute(rows, 30)


def test_empty_table(corpus):
    assert phrases.collocations(corpus([])).collect() == []
    assert phrases.frequent_phrases(corpus([])).collect() == []


def test_fingerprints_do_not_depend_on_windows(monkeypatch):
    text = ("aa bb. cc  dd\tee " * 50 + "x" * 300 + " yy,zz").encode()
    powers = prints.Powers()
    whole = phrases.Words([text, b"", text], powers)
    monkeypatch.setattr(prints, "WINDOW", 7)
    cut = phrases.Words([text, b"", text], powers)
    for name in ("starts", "ends", "pieces", "owners"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name))
    assert all(np.array_equal(a, b) for a, b in zip(whole.prints, cut.prints))
    words = [whole.data[a:b] for a, b in zip(whole.starts, whole.ends)]
    by_print = {}
    for word, one in zip(words, whole.prints[0].tolist()):
        assert by_print.setdefault(one, word) == word
    assert len(by_print) == len(set(words))


def test_equal_fingerprints_are_added_up_and_long_counts_split(monkeypatch):
    one = np.array([8, 16, 8, 8, 16], np.uint64)
    two = np.array([1 << 40, 2 << 40, 1 << 40, 3 << 40, 2 << 40], np.uint64)
    monkeypatch.setattr(phrases, "_COUNT_BITS", 1)
    rows = [tuple(r.values()) for b in phrases._packed([(one, two)]) for r in b.to_pylist()]
    found = Counter()
    for p, rest in rows:
        found[p, rest >> 1] += rest & 1
    assert found == {(8, 1 << 39): 2, (16, 1 << 40): 2, (8, 3 << 39): 1}


def test_phrases_that_the_sample_lacks_are_named(corpus):
    rows = texts(5, 50, 40)
    found = phrases.frequent_phrases(corpus(rows), support=3, sample=25)
    f, sizes = counts(rows)
    wanted = [(lang, " ".join(p), len(p), a) for lang, of in f.items() for p, a in of.items() if a >= 3]
    wanted += [(lang, "", 0, n) for lang, n in sizes.items()]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


@pytest.mark.parametrize("bits", [9, 11])
def test_phrases_that_are_marked_by_chance_are_counted(corpus, bits):
    """Phrases of one document each, few of which the sample has, with ever more bits by chance."""
    draw, common = random.Random(6), [f"c{i}" for i in range(30)]
    rows = []
    for d in range(40):
        words = [f"w{d}_{i}" for i in range(20)] + common
        rows.append((". ".join(" ".join(draw.sample(words, 5)) + "! " for _ in range(10)) * 5, "en"))
    found = phrases.collocations(corpus(rows), support=5, bits=bits, per_language=10**6)
    wanted = brute(rows, 5, top=10**6)
    assert sorted(map(tuple, found.collect())) == wanted and wanted


def test_words_with_equal_polynomials_modulo_two_to_the_64_differ(corpus):
    """Words whose letters follow the Thue-Morse sequence, and those with the letters exchanged."""
    bits = [n.bit_count() % 2 for n in range(2048)]
    one, two = ("x" + "".join(letters[b] for b in bits) + "y" for letters in ("ab", "ba"))
    rows = [(f"{one} cat. " * 40 + f"{two} cat. " * 50 + f"{two} dog. " * 35, "en")] * 2
    assert sorted(map(tuple, phrases.collocations(corpus(rows)).collect())) == brute(rows, 30)
    words = phrases.Words([f"{one} {two}".encode()], prints.Powers())
    assert words.prints[1][0] != words.prints[1][1]


def test_few_failures_take_one_further_pass(corpus, monkeypatch):
    """Phrases of single documents that the sample lacks, beside many that it has."""
    rows = [(". ".join(" ".join(f"v{d % 12}_{i}_{j}" for j in range(4)) for i in range(20)) * 3, "en") for d in range(120)]
    rows += [(f"x{d} y{d} z{d} u{d}. " * 4, "en") for d in range(12)]
    calls = []
    named = phrases._named

    def watched(df, marks, wanted, old, *rest):
        calls.append(old is not None)
        return named(df, marks, wanted, old, *rest)

    monkeypatch.setattr(phrases, "_named", watched)
    found = phrases.frequent_phrases(corpus(rows), support=3, sample=2)
    f, sizes = counts(rows)
    wanted = [(lang, " ".join(p), len(p), a) for lang, of in f.items() for p, a in of.items() if a >= 3]
    wanted += [(lang, "", 0, n) for lang, n in sizes.items()]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert calls == [False, True]
