"""Repeated passages by suffix arrays: bytes covered by an earlier ``LENGTH``-byte string.

Sorting every suffix of a corpus in one order would move each byte many times, so the
suffixes are first divided by content. Windows of ``LENGTH`` bytes are cut into
segments of one fingerprint (see ``windows``); equal windows have equal fingerprints.
A fingerprint that occurs once cannot hold a repeat and ends there. Of equal segments
only the earliest is looked into; in all later ones every window is a repeat.

The distinct segments of a fingerprint form a class. Classes are dealt over the tasks
by fingerprint, and in each task a suffix array is built by the difference-cover
algorithm (Kärkkäinen and Sanders): suffixes at positions not divisible by 3 are sorted
by their triples of symbols, the algorithm recurses on the names of the triples, the
remaining suffixes are sorted with the help of those ranks and merged in. Neighbours
in the array are compared for ``LENGTH`` bytes; of each group of equal windows all but
the earliest are repeats.

A class that is too large for one task has its windows dealt by their hashes instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.texts import bounded_batches, encode
from tabflow.llm.windows import LENGTH, Hashes, mix, segments
from tabflow.scratch import staged

#: Bytes of texts that are cut at a time, and of classes sorted at a time.
CHUNK = 1 << 20
#: Bytes of a class up to which it is sorted in one task.
CLASS_BYTES = 1 << 20

_BITS = 21  # symbols and ranks of one sort are below 2**21
_PLACE = 1 << 31  # offsets and sizes are below this, as no text has 2 GB

_NO_ID = -(1 << 63)

SEGMENTS = "v bigint, x bigint, doc bigint, key bigint, at bigint, twice boolean"


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of positive symbols in lexicographic order (DC3)."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    bits = np.uint64(_BITS)
    s = np.zeros(n + 3, np.uint64)
    s[:n] = symbols
    # with n = 1 modulo 3 the empty triple after the end keeps the two halves apart
    first, second = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((first, second))
    triples = (s[sample] << bits + bits) | (s[sample + 1] << bits) | s[sample + 2]
    order = np.argsort(triples)
    ordered = triples[order]
    names = np.cumsum(np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64))))
    if names[-1] < len(sample):
        named = np.empty(len(sample), np.int64)
        named[order] = names
        order = suffix_array(named)
    rank = np.zeros(n + 3, np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)

    rest = np.arange(0, n, 3)
    pair = lambda i: (s[i] << bits) | rank[i + 1]
    triple = lambda i: (s[i] << bits + bits) | (s[i + 1] << bits) | rank[i + 2]
    rest = rest[np.argsort(pair(rest))]
    ranked = sample[order]
    ranked = ranked[ranked < n]
    ones, twos = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    before = np.searchsorted(pair(ones), pair(rest)) + np.searchsorted(triple(twos), triple(rest))
    out = np.empty(n, np.int64)
    places = before + np.arange(len(rest))
    free = np.ones(n, bool)
    free[places] = False
    out[places] = rest
    out[free] = ranked
    return out


def equal_windows(pieces: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Windows of all pieces that may have an equal one, those of equal bytes side by side.

    Returns per window its piece, its offset, and the number of its group. Windows with a
    hash of their own equal no other one; only stretches of the rest are sorted.
    """
    piece, start, end = _stretches(pieces, length)
    cut = [pieces[p][a : b + length - 1] for p, a, b in zip(piece.tolist(), start.tolist(), end.tolist())]
    if not cut:
        return piece, start, start
    owner, offset, group = _sorted_windows(cut, length)
    return piece[owner], start[owner] + offset, group


def _stretches(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece, first and end offset of the stretches of windows whose hash occurs more than once."""
    sizes = np.array([len(p) + 1 for p in pieces], np.int64)
    begins = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - length, 0)
    owner = np.repeat(np.arange(len(pieces)), counts)
    at = np.arange(len(owner)) + np.repeat(begins - np.cumsum(counts) + counts, counts)
    hashes = Hashes(b"\0".join(pieces) + b"\0").of(at, at + length)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    often = np.zeros(len(at) + 2, bool)
    often[order[1:][same] + 1] = often[order[:-1][same] + 1] = True
    new = np.ones(len(at) + 1, bool)  # a stretch ends with its piece
    new[1:-1] = owner[1:] != owner[:-1]
    first = np.flatnonzero(often[1:-1] & (~often[:-2] | new[:-1]))
    last = np.flatnonzero(often[1:-1] & (~often[2:] | new[1:]))
    piece = owner[first]
    return piece, at[first] - begins[piece], at[last] - begins[piece] + 1


def _sorted_windows(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(p) + 1 for p in pieces])
    flat = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    begins = np.cumsum(sizes) - sizes
    symbols = flat.astype(np.int64) + 2
    symbols[begins + sizes - 1] = 1  # the end of a piece, below every byte
    owner = np.repeat(np.arange(len(pieces)), sizes)
    order = suffix_array(symbols)
    offset = order - begins[owner[order]]
    order = order[offset + length < sizes[owner[order]]]
    same = np.zeros(len(order), bool)
    view = np.lib.stride_tricks.sliding_window_view(flat, length) if len(flat) >= length else None
    for low in range(1, len(order), 50_000):
        part = slice(low, min(len(order), low + 50_000))
        left = order[part.start - 1 : part.stop - 1]
        same[part] = (view[left] == view[order[part]]).all(axis=1)
    return owner[order], order - begins[owner[order]], np.cumsum(~same)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to segments: ``v`` fingerprint, ``x`` hash of the bytes, ``at`` place and size."""
    names = ["v", "x", "doc", "key", "at", "twice"]
    for batch in batches:
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        keys = batch.column(1).to_numpy(zero_copy_only=False)
        for first, texts in _chunks(batch.column(2)):
            sizes = np.array([len(t) for t in texts])
            text, start, number, value, whole, twice = segments(sizes, Hashes(b"".join(texts)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value.astype(np.int64)),
                    pa.array(whole.astype(np.int64)),
                    pa.array(docs[first + text]),
                    pa.array(keys[first + text]),
                    pa.array(start * _PLACE + number),
                    pa.array(twice),
                ],
                names,
            )


def _chunks(column) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of stretches of about ``CHUNK`` bytes."""
    held, size, first = [], 0, 0
    for i, text in enumerate(column):
        held.append(encode(text.as_py() or ""))
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, key, text, wanted segments) to one row per segment with its bytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = encode(batch.column(2)[i].as_py() or "")
            wanted = batch.column(3)[i].as_py()
            cuts = [(w["at"] // _PLACE, w["at"] % _PLACE + LENGTH - 1) for w in wanted]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w["v"] for w in wanted], pa.int64()),
                    pa.array([w["x"] for w in wanted], pa.int64()),
                    pa.array([batch.column(0)[i].as_py()] * len(wanted), pa.int64()),
                    pa.array([batch.column(1)[i].as_py()] * len(wanted), pa.int64()),
                    pa.array([c[0] for c in cuts], pa.int64()),
                    pa.array([w["large"] for w in wanted], pa.bool_()),
                    pa.array([data[a : a + n] for a, n in cuts], pa.binary()),
                ],
                ["v", "x", "doc", "key", "start", "large", "piece"],
            )


_REPEATS = "v bigint, x bigint, low array<int>, high array<int>"


def _sorted_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in the order of their class to the ranges of windows that are repeats."""
    held, size, last = [], 0, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= CHUNK and row[0] != last:
                yield _repeats(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
            last = row[0]
    if held:
        yield _repeats(held)


def _repeats(rows: list[tuple]) -> pa.RecordBatch:
    piece, offset, group = equal_windows([r[5] for r in rows])
    doc = np.array([r[2] for r in rows])[piece]
    key = np.array([r[3] for r in rows])[piece]
    place = np.array([r[4] for r in rows])[piece] + offset
    order = np.lexsort((place, key, doc, group))
    later = np.zeros(len(order), bool)
    later[1:] = group[order[1:]] == group[order[:-1]]
    # a segment stands for its earliest occurrence; the same place is no repeat of itself
    here, before = order[1:], order[:-1]
    later[1:] &= (doc[here] != doc[before]) | (key[here] != key[before]) | (place[here] != place[before])
    found = order[later]
    piece, offset = piece[found], offset[found]
    order = np.lexsort((offset, piece))
    piece, offset = piece[order], offset[order]
    cut = np.ones(len(piece) + 1, bool)
    cut[1:-1] = (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)
    starts, ends = np.flatnonzero(cut[:-1]), np.flatnonzero(cut[1:])
    owner, low, high = piece[starts], offset[starts], offset[ends] + 1
    at = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else []
    parts = [slice(a, b) for a, b in zip(at, [*at[1:], len(owner)])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[owner[p.start]][0] for p in parts], pa.int64()),
            pa.array([rows[owner[p.start]][1] for p in parts], pa.int64()),
            pa.array([low[p] for p in parts], pa.list_(pa.int32())),
            pa.array([high[p] for p in parts], pa.list_(pa.int32())),
        ],
        ["v", "x", "low", "high"],
    )


def _hashed_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments to one row per window: two hashes of its bytes, and where it is."""
    for batch in batches:
        for v, x, doc, key, start, data in zip(*(c.to_pylist() for c in batch.columns)):
            n = len(data) - LENGTH + 1
            hashes = Hashes(data)
            other = Hashes(data[::-1])
            at = np.arange(n)
            back = other.of(len(data) - at - LENGTH, len(data) - at)
            columns = [np.full(n, c, np.int64) for c in (v, x, doc, key)]
            columns += [start + at, at, hashes.of(at, at + LENGTH).astype(np.int64)]
            columns.append(mix(back).astype(np.int64))
            names = ["v", "x", "doc", "key", "place", "offset", "h1", "h2"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _large_classes(pieces: DataFrame) -> DataFrame:
    """The same ranges for classes beyond ``CLASS_BYTES``: windows grouped by hashes."""
    rows = pieces.mapInArrow(
        _hashed_windows,
        "v bigint, x bigint, doc bigint, key bigint, place bigint, offset bigint, h1 bigint, h2 bigint",
    )
    where = F.struct("doc", "key", "place")
    earliest = rows.groupBy("h1", "h2").agg(F.min(where).alias("first"))
    later = rows.join(earliest, ["h1", "h2"]).where(where != F.col("first"))
    offset = F.col("offset").cast("int")
    # a segment has at most as many windows as its text has bytes
    return later.groupBy("v", "x").agg(
        F.sort_array(F.collect_list(offset)).alias("low"),
        F.sort_array(F.collect_list(offset + 1)).alias("high"),
    )


def repeated_spans(
    docs: DataFrame, class_bytes: int = CLASS_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc``, ``key`` and ``spans``: byte ranges (start, end) of rows with repeats, unsorted.

    ``key`` is a hash of the text and tells rows of one id apart. A byte is in a span if
    a ``LENGTH``-byte string that covers it also starts earlier: at a smaller id, at a
    smaller key of the same id, or in the same text before. Spans may overlap.
    """
    picked = _picked(docs, id_col, text_col)
    cut = picked.mapInArrow(_cut, SEGMENTS)
    often = (
        cut.groupBy("v")
        .agg(F.count("*").alias("n"), F.max("twice").alias("twice"))
        .where("n > 1 or twice")
        .select("v")
    )
    live = staged(cut.join(often, "v", "left_semi"), "segments")
    place = F.struct("doc", "key", "at")
    distinct = staged(
        live.groupBy("v", "x").agg(
            F.min(place).alias("first"), F.count("*").alias("n"), F.max("twice").alias("twice")
        ),
        "distinct",
    )
    size = F.col("first.at") % _PLACE + (LENGTH - 1)
    classes = (
        distinct.groupBy("v")
        .agg(F.count("*").alias("xs"), F.sum(size).alias("bytes"), F.max("twice").alias("t"))
        .where("xs > 1 or t")
        .select("v", (F.col("bytes") > class_bytes).alias("large"))
    )
    wanted = (
        distinct.join(classes, "v")
        .groupBy(F.col("first.doc").alias("doc"), F.col("first.key").alias("key"))
        .agg(F.collect_list(F.struct("v", "x", F.col("first.at").alias("at"), "large")).alias("w"))
    )
    pieces = staged(
        picked.join(wanted, ["doc", "key"])
        .select("doc", "key", "text", "w")
        .mapInArrow(
            _pieces,
            "v bigint, x bigint, doc bigint, key bigint, start bigint, large boolean, piece binary",
        ),
        "pieces",
    ).dropDuplicates(["v", "x"])
    columns = ("v", "x", "doc", "key", "start", "piece")
    small = pieces.where("not large").select(*columns).repartition("v").sortWithinPartitions("v")
    found = small.mapInArrow(_sorted_classes, _REPEATS).union(
        _large_classes(pieces.where("large").select(*columns))
    )
    firsts = distinct.where("n > 1").select("v", "x", "first").join(found, ["v", "x"], "full")
    start, count = F.floor(F.col("at") / _PLACE), F.col("at") % _PLACE
    inner = F.arrays_zip("low", "high")
    span = lambda a, b: F.struct(
        (start + a).cast("bigint").alias("start"), (start + b + (LENGTH - 1)).cast("bigint").alias("end")
    )
    is_first = F.col("first").isNull() | (place == F.col("first"))
    spans = F.when(~is_first, F.array(span(F.lit(0), count))).otherwise(
        F.transform(F.coalesce(inner, F.array().cast("array<struct<low:int,high:int>>")),
                    lambda r: span(r["low"], r["high"]))
    )
    # a text has at most as many spans as bytes; exact copies of a row have the same ones
    return (
        live.join(firsts, ["v", "x"])
        .select("doc", "key", spans.alias("spans"))
        .where(F.size("spans") > 0)
        .groupBy("doc", "key")
        .agg(F.flatten(F.collect_set("spans")).alias("spans"))
    )


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return bounded_batches(docs).select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("key"),
        F.col(f"`{text_col}`").alias("text"),
    )


def without_repeats(
    docs: DataFrame, class_bytes: int = CLASS_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary).

    ``kept`` has the bytes of the text, in UTF-8, that no repeat covers; ``n_spans``
    counts the maximal removed runs. A null or empty text has no bytes. Rows without
    an id stand before all others. Rows that share an id (or have none) and a text are
    one document, whose passages at one offset are no repeats of each other; different
    texts of one id are documents of their own, in the order of a hash.
    """
    spans = repeated_spans(docs, class_bytes, id_col, text_col)
    rows = _picked(docs, id_col, text_col)
    rows = rows.withColumn("id", F.when(F.col("doc") != _NO_ID, F.col("doc")))
    return (
        rows.join(spans, ["doc", "key"], "left")
        .select("id", "text", "spans")
        .mapInArrow(_remove, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
        .withColumnRenamed("id", id_col)
    )


def _kept(text: str | None, spans: list | None) -> tuple[int, int, int, bytes]:
    data = encode(text or "")
    if not spans:
        return len(data), 0, 0, data
    kept, removed, runs = [], 0, 0
    at = -1
    for low, high in sorted((s["start"], s["end"]) for s in spans):
        high = min(high, len(data))
        if low > at:
            kept.append(data[max(at, 0) : low])
            runs += 1
            removed += max(0, high - low)
        else:
            removed += max(0, high - at)
        at = max(at, high)
    kept.append(data[at:])
    return len(data), removed, runs, b"".join(kept)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 200):
            part = batch.slice(low, 200)
            made = [_kept(t.as_py(), s.as_py()) for t, s in zip(part.column(1), part.column(2))]
            columns = [pa.array([m[i] for m in made], pa.int64()) for i in range(3)]
            columns.append(pa.array([m[3] for m in made], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept"]
            )
