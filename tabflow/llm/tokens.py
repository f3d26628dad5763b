"""Token ids in a packed binary layout, written and read by Spark.

A dataset is a folder with two Parquet tables. ``blocks`` has one row per block:
its part and number, the ids of its documents and their lengths, and a payload with
all token ids, each in the fewest bits that hold the vocabulary. Every 64 ids fill a
whole number of 64-bit words, so the words of any id are found by its number
(random access) and numpy unpacks a payload in 64 vector steps. ``parts`` has the
number of tokens before each part. Documents are in ascending id order, so their
numbers are positions in one long stream of tokens.

Parquet is only the container: Spark's writers commit it, any file system that Spark
reaches can hold it, and its statistics let a reader skip blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabflow.llm.prints import Powers, grouped, word_prints
from tabflow.llm.texts import bounded_batches, lean

#: A block is closed when it has so many tokens; one document is never split.
BLOCK_TOKENS = 1 << 16
#: Words, and words without case and marks, whose ids a Python worker remembers; beyond
#: these it begins again.
CACHED_WORDS, CACHED_STEMS = 2_000_000, 300_000

BLOCKS = (
    "part int, block int, first bigint, n_tokens bigint, bits int, doc_ids array<bigint>, "
    "lengths array<bigint>, payload binary"
)
_GROUP = 64


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to ``vocabulary - 1``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids in ``bits`` bits each, low bits first, padded to 64 ids."""
    groups = -(-len(ids) // _GROUP)
    grid = np.zeros(groups * _GROUP, np.uint64)
    grid[: len(ids)] = ids
    grid = grid.reshape(groups, _GROUP)
    words = np.zeros((groups, bits), np.uint64)
    for j in range(_GROUP):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= grid[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= grid[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(payload: bytes, bits: int, start: int, end: int) -> np.ndarray:
    """The ids with numbers ``start`` to ``end - 1``; only their words are read."""
    first, last = start // _GROUP, -(-end // _GROUP)
    groups = max(0, last - first)
    words = np.frombuffer(payload, "<u8", groups * bits, first * bits * 8).reshape(groups, bits)
    grid = np.empty((groups, _GROUP), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(_GROUP):
        word, shift = divmod(j * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[:, word + 1] << np.uint64(64 - shift)
        grid[:, j] = value & mask
    return grid.reshape(-1)[start - first * _GROUP : end - first * _GROUP]


class _Known:
    """Ids of words by both fingerprints: sorted arrays, and all ids one after the other."""

    def __init__(self) -> None:
        self.one, self.two = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def find(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words would stand, and which are there."""
        at = np.searchsorted(self.one, one)
        there = np.zeros(len(one), bool)
        some = np.flatnonzero(at < len(self.one))
        there[some] = (self.one[at[some]] == one[some]) & (self.two[at[some]] == two[some])
        return at, there

    def add(self, at: np.ndarray, one: np.ndarray, two: np.ndarray, made: list[bytes]) -> None:
        """More words, sorted, at their places."""
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.one, self.two = np.insert(self.one, at, one), np.insert(self.two, at, two)
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(made), "<u4")))


class Encoder:
    """Texts to ids with a tokenizer file.

    ``by_word`` is for tokenizers that drop white space, ignore case and treat a run
    of letters and the punctuation after it apart: each distinct word is then
    encoded once and its ids are remembered. The ids are those of the whole text.
    """

    def __init__(self, path: str, by_word: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        self.powers = Powers()
        self.words = _Known()
        self.known: dict[bytes, bytes] = {b"": b""}
        self.bar = self.tokenizer.encode("|", add_special_tokens=False).ids[-1]

    def encode(self, texts: pa.Array, end_id: int | None) -> list[bytes]:
        """Per text its ids and the end id, as little-endian unsigned 32-bit integers.

        A null is an empty text. By word, numpy cuts the texts at ASCII white space and finds
        the distinct words by two fingerprints of 64 bits each; only new ones are looked at.
        """
        end = b"" if end_id is None else end_id.to_bytes(4, "little")
        texts = texts.fill_null("")
        if not self.by_word:
            return [ids.tobytes() + end for ids in self._plain(texts.to_pylist())]
        parts = texts.cast(pa.binary()).to_pylist()
        data = b"\n".join(parts)
        starts, stops, one, two = word_prints(*_spaced(data), self.powers)
        order, firsts = grouped(one, two)
        number = np.empty(len(one), np.int64)  # of each word among the distinct ones
        number[order] = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(one))))
        first = order[firsts]
        low, size = self._ids_of(data, starts[first], stops[first], one[first], two[first])

        sizes = size[number]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(low[number] - upto[:-1], sizes) + np.arange(upto[-1])
        ids = self.words.ids[at].tobytes()
        last = np.cumsum([len(p) + 1 for p in parts])
        cuts = [0, *(4 * upto[np.searchsorted(starts, last)]).tolist()]
        return [ids[a:b] + end for a, b in zip(cuts, cuts[1:])]

    def _ids_of(
        self, data: bytes, starts: np.ndarray, stops: np.ndarray, one: np.ndarray, two: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct words are, and how many; the words are sorted by fingerprint."""
        at, there = self.words.find(one, two)
        if not there.all():
            if len(self.words.one) > CACHED_WORDS:
                self.words, self.known = _Known(), {b"": b""}
                at, there = self.words.find(one, two)
            new = np.flatnonzero(~there)
            words = [data[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())]
            self._learn(set(filterfalse(self.known.__contains__, words)))
            self.words.add(at[new], one[new], two[new], list(map(self.known.__getitem__, words)))
            if len(self.known) > CACHED_STEMS:
                self.known = {b"": b""}
            at = np.arange(len(one)) if len(self.words.one) == len(one) else self._places(one, two)
        return self.words.starts[at], self.words.sizes[at]

    def _places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Of words that are all known; those with one first fingerprint stand side by side."""
        at = np.searchsorted(self.words.one, one)
        while len(off := np.flatnonzero(self.words.two[at] != two)):
            at[off] += 1
        return at

    def _learn(self, new: set[bytes]) -> None:
        known = self.known
        plain = {w for w in new if len(w.translate(None, _SPECIAL)) == len(w)}
        stems = [(w, *_stem(w)) for w in new.difference(plain)]
        parts = {s[1] for s in stems} | {s[2] for s in stems}
        plain.update(filterfalse(known.__contains__, parts))
        odd = {w for w in plain if _BAR in w}
        self._learn_joined(list(plain - odd))
        made = self._plain([w.decode("utf-8", "surrogatepass") for w in odd])
        known.update((w, ids.tobytes()) for w, ids in zip(odd, made))
        known.update((w, known[base] + known[marks]) for w, base, marks in stems)

    def _learn_joined(self, words: list[bytes]) -> None:
        """Encodes many words as one text, with bars between them."""
        for low in range(0, len(words), _JOINED):
            some = words[low : low + _JOINED]
            text = b" | ".join(some).decode("utf-8", "surrogatepass")
            ids = self._plain([text])[0]
            ends = [*(4 * np.flatnonzero(ids == self.bar)).tolist(), 4 * len(ids)]
            data = ids.tobytes()
            found = [data[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends)]
            self.known.update(zip(some, found, strict=True))

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in made]


# ASCII white space.
_SPACES = np.zeros(256, bool)
_SPACES[list(b" \t\n\x0b\x0c\r")] = True
#: Texts that are encoded together.
_TEXTS = 2_000
#: Words that are encoded as one text, with a bar between them.
_JOINED = 200
_BAR = b"|"
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SPECIAL = _MARKS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _spaced(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes as numbers, and which of them are white space."""
    numbers = np.frombuffer(data, np.uint8)
    return numbers, _SPACES[numbers]


def _stem(word: bytes) -> tuple[bytes, bytes]:
    """The word with A-Z in lower case, and the marks at its end if a letter is before them.

    The letter, or digit, is an ASCII one or one of U+00C0 to U+00FF.
    """
    if b"<|" in word:  # special tokens are found in texts as they stand
        return word, b""
    word = word.lower()
    base = word.rstrip(_MARKS)
    if len(base) == len(word) or not base:
        return word, b""
    last = base[-1:]
    if last.isalnum() or base[-2:-1] == b"\xc3" and last not in b"\x97\xb7":
        return base, word[len(base) :]
    return word, b""


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, by_word: bool) -> Encoder:
    """One encoder per Python worker, so that later tasks know the words of earlier ones."""
    key = (path, by_word)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, by_word)
    return _ENCODERS[key]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    by_word: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text and write a dataset at ``folder``, which must not exist.

    Documents are range-partitioned and sorted by id, nulls first; rows of one id
    stand side by side in the order of the input, and their place in it lets several tasks
    share them. A null text is an empty one and has the end id only. The
    tokenizer file must be readable at its path on every executor.
    """
    bits = bits_for(Tokenizer.from_file(tokenizer).get_vocab_size())
    placed = (
        bounded_batches(docs)
        .select(
            F.col(f"`{id_col}`").cast("bigint").alias("id"),
            F.col(f"`{text_col}`").alias("t"),
            F.monotonically_increasing_id().alias("place"),
        )
        .repartitionByRange(F.col("id"), F.col("place"))
        .sortWithinPartitions("id", "place")
        .select("id", "t")
    )
    blocks = placed.mapInArrow(lean(_writer(tokenizer, by_word, end_id, bits)), BLOCKS)
    blocks.write.parquet(f"{folder}/blocks")
    spark = docs.sparkSession
    sizes = (
        spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("n_tokens"))
    )
    # one row per written part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint")
    sizes.select("part", first.alias("before")).write.parquet(f"{folder}/parts")


def _writer(tokenizer: str, by_word: bool, end_id: int | None, bits: int):
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    types += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = ["part", "block", "first", "n_tokens", "bits", "doc_ids", "lengths", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, by_word)
        part, block, first, size = TaskContext.get().partitionId(), 0, 0, 0
        ids: list[int | None] = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal block, first, ids, held
            lengths = [len(h) // 4 for h in held]
            payload = pack(np.frombuffer(b"".join(held), "<u4"), bits)
            row = [part, block, first, sum(lengths), bits, ids, lengths, payload]
            block, first, ids, held = block + 1, first + sum(lengths), [], []
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)], names
            )

        for batch in batches:
            texts = batch.column(1)
            for low in range(0, len(texts), _TEXTS):
                some = texts.slice(low, _TEXTS)
                numbers = batch.column(0).slice(low, _TEXTS).to_pylist()
                for number, made in zip(numbers, encoder.encode(some, end_id)):
                    ids.append(number)
                    held.append(made)
                    size += len(made) // 4
                    if size >= BLOCK_TOKENS or len(held) >= BLOCK_TOKENS:
                        yield close()
                        size = 0
        if held:
            yield close()

    return run


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, each with the number of its first token in the whole stream."""
    parts = spark.read.schema("part int, before bigint").parquet(f"{folder}/parts")
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    # one row per written part: bounded by the tasks of the job that wrote them
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("first"))


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, number of the first token, token ids) of each document of the blocks."""
    for start, bits, ids, lengths, payload in zip(*(c.to_pylist() for c in batch.columns)):
        values = unpack(payload, bits, 0, sum(lengths))
        ends = list(accumulate(lengths, initial=0))
        for number, low, high in zip(ids, ends, ends[1:]):
            yield number, start + low, values[low:high]


_READ = ("start", "bits", "doc_ids", "lengths", "payload")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a dataset: ``doc_id, start, n_tokens, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(batch.num_rows)):
                found = list(_documents(one))
                columns = [
                    pa.array([d[0] for d in found], pa.int64()),
                    pa.array([d[1] for d in found], pa.int64()),
                    pa.array([len(d[2]) for d in found], pa.int64()),
                    pa.array([d[2] for d in found], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids array<int>"
    return _blocks(spark, folder).select(*_READ).mapInArrow(lean(run), schema)


def token_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a dataset: ``doc_id, start, n_tokens, ids_crc32``, from its blocks.

    The checksum is over the ids as little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (number, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                for number, start, ids in _documents(batch)
            ]
            columns = [pa.array([d[i] for d in found], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return _blocks(spark, folder).select(*_READ).mapInArrow(lean(run), schema)


def read_range(spark: SparkSession, folder: str, start: int, end: int) -> DataFrame:
    """Tokens ``start`` to ``end - 1`` of the stream, as rows ``start, ids`` of whole blocks' cuts.

    Only blocks that meet the range are read, and of them only the words needed.
    """
    met = _blocks(spark, folder).where(
        (F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, bits, payload in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = max(0, start - at), min(n, end - at)
                ids = unpack(payload, bits, low, high)
                columns = [pa.array([at + low], pa.int64()), pa.array([ids], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["start", "ids"])

    return met.select("start", "n_tokens", "bits", "payload").mapInArrow(
        run, "start bigint, ids array<int>"
    )
