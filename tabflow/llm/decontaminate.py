"""Benchmark items in documents, with up to 8 percent of their characters edited.

An item of ``n`` characters may have ``n * MAX_ERRORS`` edits (insertions, deletions,
substitutions). Split into one piece more than that, a copy of it keeps at least one
piece unchanged, so exact hits of the pieces, all found in one pass by an
Aho-Corasick automaton, give every place to look at (pigeonhole principle). There,
Myers' bit-parallel algorithm computes the edit distance of the item to the best
substring.

Texts are compared as words of letters and digits in lower case, joined by single
blanks, in UTF-8 bytes; so case, punctuation and line breaks do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.texts import alnum_words, bounded_batches, lean

#: Edits allowed per character of an item.
MAX_ERRORS = 0.08
#: Items shorter than this, in bytes after normalising, match exactly and as whole words only.
SHORTEST_FUZZY = 40
#: Bytes of items in one automaton; more items take more passes over the documents.
BLOCK_BYTES = 4 << 20


def normalised(text: str | None) -> bytes:
    return b" ".join(alnum_words(text or ""))


def allowed_errors(size: int, max_errors: float = MAX_ERRORS) -> int:
    return int(size * max_errors) if size >= SHORTEST_FUZZY else 0


def best_substring(pattern: bytes, text: bytes, limit: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to a substring, and that substring's end.

    None if the distance is above ``limit``; of equal ends the first counts.
    One machine-independent integer holds a column of the distance matrix
    (Myers 1999), so a character of the text costs a few operations.
    """
    masks: dict[int, int] = {}
    for i, byte in enumerate(pattern):
        masks[byte] = masks.get(byte, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, score = full, 0, len(pattern)
    best: tuple[int, int] | None = None
    for at, byte in enumerate(text):
        equal = masks.get(byte, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if score <= limit and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Finder:
    """Finds items in one normalised text."""

    def __init__(self, items: list[tuple[int, bytes]], max_errors: float = MAX_ERRORS) -> None:
        self.items = items
        self.errors = [allowed_errors(len(text), max_errors) for _, text in items]
        pieces: dict[bytes, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(items):
            parts = self.errors[n] + 1
            cuts = [len(text) * i // parts for i in range(parts + 1)]
            for low, high in zip(cuts, cuts[1:]):
                pieces.setdefault(text[low:high], []).append((n, low))
        self.seeds = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.seeds.add_word(piece.decode("latin-1"), (len(piece), places))
        self.seeds.make_automaton()

    def find(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item number, distance, end in bytes) of the best place of each item found."""
        if not self.items:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.seeds.iter(text.decode("latin-1")):
            for n, offset in places:
                starts.setdefault(n, set()).add(end + 1 - size - offset)
        found = []
        for n, at in starts.items():
            best = self._verify(n, sorted(at), text)
            if best:
                found.append((n, *best))
        return sorted(found)

    def _verify(self, n: int, starts: list[int], text: bytes) -> tuple[int, int] | None:
        item, errors = self.items[n][1], self.errors[n]
        if not errors:
            # the seed was the whole item, so every start is a copy; it must end at words' ends
            blank = lambda at: text[at : at + 1] in (b"", b" ")
            whole = (s for s in starts if blank(s + len(item)) and (s == 0 or blank(s - 1)))
            at = next(whole, None)
            return None if at is None else (0, at + len(item))
        best, low, high = None, starts[0] - errors, starts[0]
        for start in [*starts[1:], None]:
            if start is not None and start - errors <= high + len(item) + errors:
                high = start
                continue
            low = max(0, low)
            got = best_substring(item, text[low : high + len(item) + errors], errors)
            if got and (best is None or got[0] < best[0]):
                best = (got[0], low + got[1])
            if start is not None:
                low, high = start - errors, start
        return best


def find_items(
    docs: DataFrame,
    items: DataFrame,
    max_errors: float = MAX_ERRORS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item found in it: ids, ``distance``, ``found`` (the text).

    Whole texts are searched. An item counts once per document, at its best place.
    Null and empty items and texts match nothing; repeated rows of documents or
    items give repeated results. Items are held by every task in blocks of about
    ``block_bytes``, and each block is one more pass over the documents, so memory
    does not grow with the benchmark.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("item_id", T.LongType()),
            T.StructField("distance", T.IntegerType()),
            T.StructField("found", T.StringType()),
        ]
    )
    picked = bounded_batches(docs).select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    out = None
    for wanted in _blocks(items, item_col, item_text_col, block_bytes):
        found = picked.mapInArrow(lean(_search(wanted, max_errors)), schema)
        out = found if out is None else out.union(found)
    return out


def _blocks(
    items: DataFrame, item_col: str, item_text_col: str, block_bytes: int
) -> Iterator[list[tuple[int, bytes]]]:
    """Ids and normalised texts of the items, about ``block_bytes`` at a time."""
    held = items.select(
        F.col(f"`{item_col}`").cast("bigint").alias("item"), F.col(f"`{item_text_col}`").alias("text")
    ).where(F.length("text") > 0)
    total = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        mine = held.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        wanted = [(r[0], normalised(r[1])) for r in mine.collect()]
        yield [w for w in wanted if w[1]]


def _search(items: list[tuple[int, bytes]], max_errors: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(items, max_errors)
        for batch in batches:
            row, item, distance, shown = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                text = normalised(text.as_py())
                for n, errors, end in finder.find(text):
                    row.append(i)
                    item.append(items[n][0])
                    distance.append(errors)
                    size = len(items[n][1])
                    shown.append(text[max(0, end - size) : end].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(item, pa.int64()),
                    pa.array(distance, pa.int32()),
                    pa.array(shown, pa.string()),
                ],
                [batch.schema.names[0], "item_id", "distance", "found"],
            )

    return run


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no item is found; rows with a null id are kept.

    All rows of an id go if one of them has an item. The ids to drop are far fewer
    than the documents; Spark broadcasts them only if their measured size allows.
    """
    id_col = options.get("id_col", "doc_id")
    hit = find_items(docs, items, **options).select(id_col).distinct()
    return docs.join(hit, id_col, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def clean_rows(
    docs: DataFrame,
    items: DataFrame,
    max_errors: float = MAX_ERRORS,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows in whose text no item is found, with all their columns.

    The decision is made row by row on the text, so null and repeated ids do no harm
    and nothing is shuffled. Each block of items is one more pass over the rows left.
    """
    at = docs.columns.index(text_col)

    def lacking(wanted: list[tuple[int, bytes]]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(wanted, max_errors)
            for batch in batches:
                keep = [not finder.find(normalised(t.as_py())) for t in batch.column(at)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    rows = bounded_batches(docs)
    for wanted in _blocks(items, item_col, item_text_col, block_bytes):
        rows = rows.mapInArrow(lean(lacking(wanted)), docs.schema)
    return rows
