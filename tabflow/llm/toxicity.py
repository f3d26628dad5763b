"""Toxicity by a weighted lexicon, learned from labelled rows.

Texts are folded first: letters in lower case, homoglyphs to the Latin letter they
look like, accents dropped, digits to the letter they stand for. An Aho-Corasick
automaton then finds lexicon entries, which begin where a word begins, and
exception phrases, inside which entries do not count. The weights of the hits,
normalised by the length of the text, are the features of a logistic score.

The lexicon is learned from a sample of labelled rows: beginnings of words and
whole words that occur in many more toxic than clean rows. The sample is bounded
by ``SAMPLE_ROWS``, chosen by a hash of the id; so are the entries, by
``MAX_ENTRIES``. Only these two come to the driver.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.texts import bounded_batches, lean, per_text

#: Labelled rows used for learning, at most.
SAMPLE_ROWS = 12_000
#: Lexicon entries, at most.
MAX_ENTRIES = 2_000
#: Labelled toxic rows that must hold an entry.
MIN_ROWS = 6
#: Times an entry must be likelier in toxic rows.
MIN_RATIO = 8.0
#: Score from which a text counts as toxic.
THRESHOLD = 0.3
#: Largest log-odds of a text without any hit, whatever the share of toxic labels.
NO_HIT = -2.2
#: Words added to the length when hits are normalised.
SMOOTH_WORDS = 20

#: Lengths of word beginnings that can become entries.
STEMS = range(4, 9)

# Benign phrases around words that are insults elsewhere.
EXCEPTIONS = (
    "clown fish",
    "idiot board",
    "idiot proof",
    "loser bracket",
    "losers bracket",
    "pathetic fallacy",
    "pond scum",
    "soap scum",
    "trash bag",
    "trash bin",
    "trash can",
    "trash collection",
)

# Characters that look like a Latin letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j",
    "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y",
    "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
    "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x",
}

# Digits and signs that stand for a letter.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a"}


class _Folding(dict):
    """A translation table that is filled as characters occur."""

    def __missing__(self, code: int) -> str:
        self[code] = made = self._fold(chr(code))
        return made

    @staticmethod
    def _fold(char: str) -> str:
        out = ""
        for c in unicodedata.normalize("NFKD", SUBSTITUTES.get(char, char).lower()):
            if unicodedata.combining(c) or unicodedata.category(c) == "Cf":
                continue  # accents, soft hyphens and zero-width characters
            c = HOMOGLYPHS.get(c, c)
            out += c if c.isalnum() else " "
        return out


_FOLDING = _Folding()


def fold(text: str) -> list[str]:
    """The words of a text after folding."""
    return text.translate(_FOLDING).split()


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """Entries with weights, exceptions and the coefficients of the score.

    An entry is a word beginning; with a blank at its end it is a whole word.
    """

    entries: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, ...] = (-4.0, 1.0, 1.0)

    def matcher(self) -> Callable[[str], tuple[int, float, int]]:
        """A function from a text to (hits, sum of their weights, words)."""
        automaton = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            automaton.add_word(f" {entry}", (len(entry), weight))
        for phrase in self.exceptions:
            automaton.add_word(f" {phrase} ", (len(phrase) + 1, None))
        empty = not self.entries
        if not empty:
            automaton.make_automaton()

        def match(text: str) -> tuple[int, float, int]:
            words = fold(text)
            if empty or not words:
                return 0, 0.0, len(words)
            best: dict[int, float] = {}
            benign: list[tuple[int, int]] = []
            for end, (size, weight) in automaton.iter(f" {' '.join(words)} "):
                start = end - size + 1
                if weight is None:
                    benign.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
            if benign:
                best = {s: w for s, w in best.items() if not _inside(s, benign)}
            return len(best), sum(best.values()), len(words)

        return match

    def scorer(self) -> Callable[[str], tuple[float]]:
        match = self.matcher()

        def score(text: str) -> tuple[float]:
            z = float(np.dot(self.coefficients, features(*match(text))))
            return (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))),)

        return score


def _inside(start: int, spans: list[tuple[int, int]]) -> bool:
    return any(low <= start < high for low, high in spans)


def features(hits: int, weight: float, words: int) -> tuple[float, float, float]:
    """Constant, hits' weight, and hits' weight per 100 words, both damped."""
    density = 100 * weight / (words + SMOOTH_WORDS)
    return 1.0, math.log1p(weight), math.log1p(density)


def _stems(text: str) -> set[str]:
    found = set()
    for word in set(fold(text)):
        found.add(f"{word} ")
        found.update(word[:n] for n in STEMS if len(word) >= n)
    return found


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic rows, clean rows) summed over each batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[0 if toxic else 1].update(_stems(text.as_py() or ""))
        names = [*dict.fromkeys([*counts[0], *counts[1]])]
        columns = [pa.array([c[n] for n in names], pa.int64()) for c in counts]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["e", "t", "c"])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    max_entries: int = MAX_ENTRIES,
    exceptions: tuple[str, ...] = EXCEPTIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A model from labelled rows that are not held out.

    Rows without an id or a label are left out; an id with several labels is toxic
    if one of them is, and one with several texts is fitted by the text with most hits.
    At most ``sample_rows`` ids are learned from. Without any entry every score is the same low one.
    """
    named = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("toxic"))
    usable = named.where(F.col("id").isNotNull() & F.col("toxic").isNotNull())
    sample = (
        usable.where(~held_out(F.col("id")))
        .groupBy("id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    docs = bounded_batches(docs)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = texts.join(F.broadcast(sample), "id")  # at most sample_rows ids and flags
    counted = (
        rows.select("text", "toxic")
        .mapInArrow(lean(_count_stems), "e string, t bigint, c bigint")
        .groupBy("e")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )
    n = sample.groupBy("toxic").count().collect()
    total = {r["toxic"]: r["count"] for r in n}
    toxic, clean = total.get(True, 0), total.get(False, 0)
    if not toxic:
        return Model({}, exceptions)
    ratio = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1))
    chosen = (
        counted.where((F.col("t") >= MIN_ROWS) & (ratio >= MIN_RATIO))
        .select("e", "t", F.log(ratio).alias("w"))
        .orderBy(F.desc(F.col("t") * F.col("w")), "e")
        .limit(max_entries)
        .collect()
    )
    model = Model(_pruned({r["e"]: (r["w"], r["t"]) for r in chosen}), exceptions)
    if not model.entries:
        return model
    fields = [("hits", "bigint"), ("weight", "double"), ("words", "bigint")]
    found = per_text(rows.select("id", "text"), model.matcher, fields, "id")
    # an id with several texts counts as the one with the most hits, so there is a row per id
    facts = found.groupBy("id").agg(F.max(F.struct(*[name for name, _ in fields])).alias("f"))
    data = facts.join(F.broadcast(sample), "id").select("id", "f.*", "toxic").collect()
    data.sort(key=lambda r: r["id"])
    x = np.array([features(r["hits"], r["weight"], r["words"]) for r in data])
    constant, *others = _fit(x, np.array([float(r["toxic"]) for r in data]))
    model.coefficients = (min(constant, NO_HIT), *others)
    return model


def _pruned(found: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Weights of the entries that say something of their own.

    A beginning goes if one longer by a letter is in nearly as many toxic rows, for
    that is more specific. Then an entry goes if a shorter one of at least about its
    weight covers it.
    """
    specific = {}
    longer = {e[:-1]: t for e, (_, t) in sorted(found.items(), key=lambda x: x[1][1]) if e[-1] != " "}
    for entry, (weight, rows) in found.items():
        if longer.get(entry, 0) < 0.95 * rows:
            specific[entry] = weight
    kept: dict[str, float] = {}
    for entry in sorted(specific, key=len):
        shorter = [entry[:n] for n in range(1, len(entry))]
        if all(kept.get(s, 0.0) < specific[entry] - 0.5 for s in shorter):
            kept[entry] = specific[entry]
    return kept


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method; the ridge keeps separable data finite."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) + 1e-9 * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - penalty @ beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        move = np.linalg.solve(curve, slope)
        beta = beta + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(round(b, 9)) for b in beta)


def score_texts(
    docs: DataFrame,
    model: Model,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: id, ``score`` (0 to 1, higher: likelier toxic), ``predicted`` (0 or 1).

    Whole texts are scored; an empty or null text has the score of no hit. Labels,
    language, source and id are no inputs of the score.
    """
    scored = per_text(docs, model.scorer, [("score", "double")], id_col, text_col)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The documents whose text scores below the threshold, with all their columns.

    The decision is made row by row on the text, so repeated ids do no harm and
    nothing is shuffled.
    """
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            keep = [score(t.as_py() or "")[0] < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return bounded_batches(docs).mapInArrow(lean(run), docs.schema)
