"""Phrases whose words stand together more often than apart, by Toivonen's method.

A phrase is frequent if it occurs ``support`` times in its language. A sample of the
documents is mined level by level with a lowered support; what is frequent there is the
proposal. The full pass counts the proposal and its negative border at once: the phrases
that are not proposed themselves, but of which both parts one word shorter are. A border
phrase that turns out to be frequent is a failure: longer ones around it were not
counted. Failures join the proposal and the phrases newly on its border are counted in a
further pass, until there are no failures. Then every frequent phrase has been counted. Where
failures are few beside the proposal, one such pass is the last: it also counts longer phrases
around those on the border, at every length, as if all of these were frequent.

Passes work on fingerprints of phrases, which have 101 bits. In a task, numpy makes them from
the bytes of many texts at once and adds up equal ones before the shuffle. The proposal
is held as at most ``2 ** BITS`` bits at three places of each fingerprint. A phrase that
seems to be marked by chance is counted as well, which costs counting and changes no result;
beyond that size this happens more the more phrases there are, and memory grows no further.
The texts of frequent phrases are looked up in the sample, and of those that do not occur
there in the next pass. Later passes find few phrases and keep their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tabflow.llm.prints import WINDOW, Powers, grouped, mixed, word_prints
from tabflow.llm.texts import bounded_batches, lean
from tabflow.operators.skew import join_hot
from tabflow.scratch import staged

SUPPORT = 30
LONGEST = 4
#: Drop a phrase inside a longer one that has at least this percent of its occurrences.
INSIDE_PERCENT = 80
PER_LANGUAGE = 2_000
NO_LANGUAGE = "und"
#: One document in so many is sampled.
SAMPLE = 8
#: Share of the support that the sample asks for.
LOWERED = 0.7
#: Bits of the proposal at most, as a power of two: 16 MB.
BITS = 27
#: Bits for each fingerprint, below that.
PLACES = 16
#: Failures are followed in one pass if they add one bit in so many of the proposal at most.
FEW_FAILURES = 4

# Bytes that end a piece, and those that end a word.
_PIECE_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_PIECE_ENDS)] = 2

_HELD = 1 << 21  # fingerprints that a task holds before it adds up equal ones
_ROWS = 1 << 17  # of a batch that leaves a task
_NAMES = 40_000  # texts of phrases that a task holds
_LENGTHS = 7  # mask of a fingerprint's bits for a length
_COUNT_BITS = 24  # of the second number of a row; above them are more bits of the fingerprint
# Odd factors of the parts of a phrase.
_FIRST, _SECOND = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


class Words:
    """The words of some texts, one after the other, with fingerprints.

    ``starts`` and ``ends`` are their bytes in ``data``, where A-Z is in lower case, and
    ``owners`` the texts they are from. ``pieces`` numbers the pieces they lie in; no
    piece has words of two texts. ``prints`` are two arrays of fingerprints: a polynomial
    of the bytes, and the same with the length, the outer bytes and another polynomial.
    """

    def __init__(self, texts: list[bytes], powers: Powers) -> None:
        self.data = b"\n".join(texts).translate(_LOWER)
        data = np.frombuffer(self.data, np.uint8)
        kinds = _KIND[data]
        self.starts, self.ends, *self.prints = word_prints(data, kinds > 0, powers)
        count = len(self.starts)
        breaks = np.zeros(count + 1, np.int32)
        breaks[np.searchsorted(self.starts, np.flatnonzero(kinds == 2))] = 1
        self.pieces = np.cumsum(breaks[:count], dtype=np.int32)
        last = np.cumsum([len(t) + 1 for t in texts])
        upto = np.searchsorted(self.starts, last) if texts else last
        self.owners = np.repeat(np.arange(len(texts)), np.diff(upto, prepend=0))

    def phrase(self, at: int, words: int) -> str:
        found = self.data[self.starts[at] : self.ends[at + words - 1]]
        return b" ".join(found.split()).decode("utf-8", "surrogatepass")


class Marks:
    """Bits at three places of each fingerprint."""

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.bits = bits
        self.data = np.zeros(max(1, 1 << bits >> 3), np.uint8) if data is None else data

    @classmethod
    def of(cls, tables: Sequence[DataFrame], most: int, exactly: bool = False) -> Marks:
        """Of the columns ``print`` of written tables; the driver gets the bits alone.

        Their number is a power of two with at least ``PLACES`` for each fingerprint, but at
        most ``2 ** most``, or exactly that many.
        """
        prints = reduce(DataFrame.unionByName, tables).select("print")
        bits = most if exactly else min(most, max(10, (PLACES * prints.count()).bit_length()))
        made = cls(bits)
        one = [F.shiftrightunsigned("print", n).bitwiseAND(F.lit((1 << bits) - 1)) + 1 for n in made.shifts]
        places = prints.select(F.explode(F.array(*one)).alias("place"))
        chunks = places.groupBy(F.bitmap_bucket_number("place").alias("chunk")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
        )
        for chunk, some in chunks.collect():
            at = (chunk - 1) * len(some)
            made.data[at : at + len(some)] = np.frombuffer(some, np.uint8)[: len(made.data) - at]
        return made

    def __or__(self, other: Marks) -> Marks:
        return Marks(self.bits, self.data | other.data)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Marks) and np.array_equal(self.data, other.data)

    def count(self) -> int:
        return int(np.bitwise_count(self.data).sum(dtype=np.int64))

    @property
    def shifts(self) -> tuple[int, int, int]:
        """Where the three places begin in a fingerprint, whose lowest bits are its length's."""
        return 64 - self.bits, (67 - self.bits) // 2, 3

    def has(self, prints: np.ndarray) -> np.ndarray:
        found = np.full(len(prints), self.bits > 0)
        for shift in self.shifts if self.bits else ():
            some = np.flatnonzero(found)
            place = prints[some] >> np.uint64(shift) & np.uint64((1 << self.bits) - 1)
            found[some] = self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
        return found


def _longer(prints: np.ndarray, words: np.ndarray, at: np.ndarray, length: int, factor: int) -> np.ndarray:
    """Fingerprints of the phrases of ``length`` words at some places."""
    step = prints[at] * np.uint64(factor) + np.uint64(length)
    return mixed(step ^ words[at + length - 1])


def _levels(
    words: Words, tongues: np.ndarray, marks: Marks, old: Marks | None, longest: int, ahead: bool = False
) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], np.ndarray]]:
    """Per length: the places of its phrases, their two fingerprints, and which are fresh.

    Without ``old`` none are, and no word is.

    Phrases longer than a word are those of which both parts one word shorter are among them and
    marked or, with ``ahead``, fresh. They are fresh unless ``old`` alone gives them as well: a
    part that is in ``old`` by chance, without being one of its phrases, does not make a longer
    phrase an old one.
    """
    ones = [mixed(p + tongues[words.owners]) for p in words.prints]
    shorter, places = [p.copy() for p in ones], np.arange(len(ones[0]))
    stale = np.ones(len(places), bool)  # where old gives the shorter phrase
    fresh = np.zeros(len(places), bool)
    yield 1, places, ones, fresh
    for length in range(2, longest + 1):
        size = len(ones[0])
        known = np.zeros(size, bool)
        known[places] = sure = fresh & ahead
        some = places[~sure]
        known[some] = marks.has(shorter[0][some])
        both = np.zeros(size, bool)
        both[: max(0, size - length + 1)] = (
            words.pieces[: max(0, size - length + 1)] == words.pieces[length - 1 :]
        )
        both[:-1] &= known[:-1] & known[1:]
        places = np.flatnonzero(both)
        fresh = np.zeros(len(places), bool)
        if old is not None:
            before = np.zeros(size, bool)
            some = np.flatnonzero(known & stale)
            before[some] = old.has(shorter[0][some])
            fresh = ~(before[places] & before[places + 1])
            stale[:] = False
            stale[places[~fresh]] = True
        for one, short, factor in zip(ones, shorter, (_FIRST, _SECOND)):
            short[places] = _longer(short, one, places, length, factor)
        yield length, places, [s[places] for s in shorter], fresh


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, about ``WINDOW`` bytes of text at a time."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(0)), 0), np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // WINDOW)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(low, high - low)


def _texts(batch: pa.RecordBatch, powers: Powers) -> tuple[Words, np.ndarray]:
    """The words of a batch, and a number for the language of each text."""
    texts = batch.column(0).fill_null("").cast(pa.binary()).to_pylist()
    return Words(texts, powers), np.asarray(batch.column(1)).view(np.uint64)


def _packed(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Equal fingerprints added up: ``print`` and a number of its other bits and the count."""
    one, two = (np.concatenate(p) for p in zip(*held))
    held.clear()
    order, firsts = grouped(one, two)
    counts = np.diff(np.append(firsts, len(one)))
    one, two = one[order[firsts]], two[order[firsts]]
    most = (1 << _COUNT_BITS) - 1
    while len(counts):
        now = np.minimum(counts, most)
        rest = two & ~np.uint64(most) | now.astype(np.uint64)
        for low in range(0, len(one), _ROWS):
            some = [pa.array(a[low : low + _ROWS].view(np.int64)) for a in (one, rest)]
            yield pa.RecordBatch.from_arrays(some, ["print", "rest"])
        more = counts > most
        one, two, counts = one[more], two[more], counts[more] - most


def _counted(rows: DataFrame, marks: Marks, lengths: set[int], least: int) -> DataFrame:
    """``print, check, n`` of phrases of which both shorter parts are marked, with ``n`` at ``least``.

    The lowest bits of ``print`` are the length. With length 0, fingerprints are languages
    and their words are counted. The table is written.
    """
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        powers = Powers()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in _slices(batches):
            words, tongues = _texts(batch.select(["text", "tongue"]), powers)
            if 0 in lengths:
                of = tongues[words.owners]
                held.append((of & ~np.uint64(_LENGTHS), of << np.uint64(32)))
            for length, _, (one, two), _ in _levels(words, tongues, marks, None, max(lengths)):
                if length in lengths:
                    held.append((one & ~np.uint64(_LENGTHS) | np.uint64(length), two))
            if sum(len(one) for one, _ in held) > _HELD:
                yield from _packed(held)
        if held:
            yield from _packed(held)

    parts = rows.select("text", "tongue").mapInArrow(lean(run), "print bigint, rest bigint")
    # shuffled as they are: tasks have added up what is equal
    counts = parts.repartition("print").groupBy("print", _check(F.col("rest")).alias("check")).agg(
        F.sum(F.col("rest").bitwiseAND(F.lit((1 << _COUNT_BITS) - 1))).alias("n")
    )
    return _done(counts.where(F.col("n") >= least), "counted", shared)


def _check(rest: Column) -> Column:
    return F.shiftrightunsigned(rest, _COUNT_BITS)


def _done(df: DataFrame, name: str, shared: Broadcast) -> DataFrame:
    """The rows, written; what was shared for them is then removed from all machines."""
    written = staged(df, name)
    shared.destroy()
    return written


def _named(
    rows: DataFrame,
    marks: Marks,
    wanted: Marks,
    old: Marks | None,
    longest: int,
    least: int,
    ahead: bool = False,
) -> DataFrame:
    """``print, check, lang, phrase, k, n, fresh`` of phrases that are wanted or fresh.

    Fresh are those that ``marks`` give, ``ahead`` also with other fresh ones, and ``old`` does
    not, see ``_levels``; there are none without ``old``. Of them, only those with ``n`` at
    ``least`` are returned. The table is written.
    """
    shared = rows.sparkSession.sparkContext.broadcast((marks, wanted, old))
    names = ["print", "check", "lang", "phrase", "k", "n", "fresh"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, wanted, old = shared.value
        powers = Powers()
        found: dict[tuple[int, int], list] = {}

        def row_batch() -> pa.RecordBatch:
            columns = [*zip(*found), *zip(*found.values())]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in _slices(batches):
            words, tongues = _texts(batch, powers)
            langs = batch.column(2).to_pylist()
            for length, places, (one, two), fresh in _levels(words, tongues, marks, old, longest, ahead):
                some = wanted.has(one) | fresh
                one, two, places = one[some] & ~np.uint64(_LENGTHS) | np.uint64(length), two[some], places[some]
                order, firsts = grouped(one, two)
                counts = np.diff(np.append(firsts, len(one))).tolist()
                at = order[firsts]
                keys = zip(one[at].view(np.int64).tolist(), (two[at] >> np.uint64(_COUNT_BITS)).tolist())
                for key, place, n, is_fresh in zip(keys, places[at].tolist(), counts, fresh[some][at].tolist()):
                    if key in found:
                        found[key][3] += n
                    else:
                        lang = langs[words.owners[place]]
                        found[key] = [lang, words.phrase(place, length), length, n, is_fresh]
            if len(found) > _NAMES:
                yield row_batch()
        if found:
            yield row_batch()

    schema = "print bigint, check bigint, lang string, phrase string, k int, n bigint, fresh boolean"
    made = rows.mapInArrow(lean(run), schema).groupBy("print", "check")
    made = made.agg(*(F.min(c).alias(c) for c in names[2:5]), F.sum("n").alias("n"), F.max("fresh").alias("fresh"))
    return _done(made.where((F.col("n") >= least) | ~F.col("fresh")), "names", shared)


def frequent_phrases(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    sample: int = SAMPLE,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, phrase, k, n``: phrases of ``k`` words with ``support`` occurrences or more.

    A phrase of no words (``k`` 0) stands for all words of a language, if they are as many. Whole texts are read,
    null ones as empty; a null language is ``und``. Rows of one id are documents of
    their own. ``sample`` and ``bits`` change the passes, not the result.
    ``longest`` is at most 7.
    """
    if not 1 <= longest <= _LENGTHS:
        raise ValueError(f"phrases of 1 to {_LENGTHS} words, not {longest}")
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    columns = F.col(f"`{text_col}`").alias("text"), F.xxhash64(lang).alias("tongue"), lang.alias("lang")
    drawn = F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(sample)) == 0
    rows = bounded_batches(docs).select(*columns)
    some = staged(bounded_batches(docs).where(drawn).select(*columns), "sample")
    lowered = max(2, math.floor(support * LOWERED / sample))

    marks, levels = Marks(0), []
    for length in range(1, longest):
        levels.append(_counted(some, marks, {length}, lowered))
        marks = Marks.of(levels, bits)

    # the full pass; texts of what it finds are in the sample, but for a few
    found = _counted(rows, marks, set(range(longest + 1)), support)
    frequent, keys = _of_length(found, 1, longest), ["print", "check"]
    known = Marks.of([frequent], bits)
    named = _named(some, known, known, None, longest, support).select(*keys, "lang", "phrase", "k")
    left = staged(frequent.join(named, keys, "left_anti"), "unnamed")
    names, wanted = [named], Marks.of([left], bits)

    old, marks = marks, _with_failures(marks, found, longest)
    phrases, ahead = [], False
    while not ahead and (old != marks or (not phrases and not left.isEmpty())):
        # with many failures, counting ahead would count nearly all phrases there are
        ahead = marks.count() - old.count() <= old.count() // FEW_FAILURES
        more = _named(rows, marks, wanted, old, longest, support, ahead)
        if not phrases:
            names.append(left.join(more, keys, "left_semi").select(*keys).join(more, keys).select(*named.columns))
        phrases.append(more.where("fresh").select("lang", "phrase", "k", "n"))
        old, marks, wanted = marks, _with_failures(marks, more.where("fresh"), longest), Marks(0)
    texts = reduce(DataFrame.unionByName, names)
    phrases.append(frequent.join(texts, keys).select("lang", "phrase", "k", "n"))
    langs = rows.select("lang", F.col("tongue").bitwiseAND(F.lit(~_LENGTHS)).alias("print")).distinct()
    totals = _of_length(found, 0, 0).join(langs, "print")
    totals = totals.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("k"), "n")
    return staged(reduce(DataFrame.unionByName, phrases).unionByName(totals), "phrases")


def _with_failures(marks: Marks, found: DataFrame, longest: int) -> Marks:
    """With the frequent phrases of a pass; only those that can grow matter."""
    return marks | Marks.of([_of_length(found, 1, longest - 1)], marks.bits, exactly=True)


def _of_length(prints: DataFrame, low: int, high: int) -> DataFrame:
    return prints.where(F.col("print").bitwiseAND(F.lit(_LENGTHS)).between(low, high))


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    inside_percent: int = INSIDE_PERCENT,
    per_language: int = PER_LANGUAGE,
    sample: int = SAMPLE,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two words or more.

    A phrase with ``a`` occurrences is cut where ``2000000 * a / (l + r)``, rounded down, is
    lowest for the occurrences ``l`` and ``r`` of its parts, at the first such place; that is
    its score. Phrases inside a longer frequent one with ``inside_percent`` of their occurrences
    are dropped. Order: score, then ``a``, then the phrase by its bytes. See
    ``frequent_phrases`` for nulls; without frequent phrases there are no rows.
    """
    phrases = frequent_phrases(docs, support, longest, sample, bits, id_col, text_col, lang_col)
    sizes = phrases.where("k = 0").select("lang", F.col("n").alias("all"))
    parts = phrases.where("k > 0").select("lang", "phrase", "n")
    asked = phrases.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))

    words = F.split("phrase", " ")
    cut = asked.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    first = F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ")
    rest = F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " ")
    cut = staged(cut.select("*", first.alias("first"), rest.alias("rest")), "cuts")
    # a part is in at most its occurrences over the support phrases of each length; the parts
    # that are broadcast have one word in a thousand each, so they are few
    edge = (sizes.agg(F.sum("all")).first()[0] or 0) / 1_000
    for side, count in (("first", "l"), ("rest", "r")):
        found = parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(count))
        cut = join_hot(cut, found, ["lang", side], F.col(count) > edge)
        cut = staged(cut, "cuts")
    score = F.expr("CAST(2000000 AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0)) div (l + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    scored = cut.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "best.*")

    spans = [(i, n) for n in range(2, longest) for i in range(1, longest - n + 2)]
    inner = F.array(*[
        F.when(F.col("k") > F.greatest(F.lit(n), F.lit(i + n - 2)), F.array_join(F.slice(words, i, n), " "))
        for i, n in spans
    ]) if spans else F.array().cast("array<string>")
    longer = asked.where("k > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.where("phrase is not null").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(inside_percent) * F.col("a"))
    )

    # the best of each share of a language first, so that no task holds a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("share")
    few = kept.select("*", share).withColumn("rank", _rank(Window.partitionBy("lang", "share"), order))
    few = few.where(F.col("rank") <= per_language)
    ranked = few.withColumn("rank", _rank(Window.partitionBy("lang"), order))
    ranked = ranked.where(F.col("rank") <= per_language).join(sizes, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")


def _rank(window: WindowSpec, order: list[Column]) -> Column:
    return F.row_number().over(window.orderBy(*order)).cast("bigint")
