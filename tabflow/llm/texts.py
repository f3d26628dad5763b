"""Words as bytes, and running a function over the texts of a table."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Lower-cases A-Z and makes every byte that is no ASCII digit, no ASCII letter
#: and not part of a character above U+007F a space.
ALNUM = bytes(
    _LOWER[b] if 48 <= b <= 57 or 97 <= _LOWER[b] <= 122 or b >= 128 else 32 for b in range(256)
)

BYTE_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
}


#: Bytes of texts that are handed to a Python worker at a time.
BATCH_BYTES = 4 << 20


def bounded_batches(docs: DataFrame) -> DataFrame:
    """The same rows, in a session whose Arrow batches hold ``BATCH_BYTES`` at most.

    By default a batch has 10,000 rows or 64 MB, and Java and Python both hold
    several. That is too much for tasks on whole texts.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same function of a task, after which what it has freed goes back to the system.

    Python workers wait for further tasks, and what they keep meanwhile counts as memory of
    their executor, also in stages that have no Python.
    """

    def leaving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return leaving


def give_back() -> None:
    """Return free memory of Arrow's pool, and of the C library where it can, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def alnum_words(text: str) -> list[bytes]:
    """Runs of digits, letters a-z and characters above U+007F, A-Z in lower case."""
    return encode(text).translate(ALNUM).split()


def space_words(text: str) -> list[bytes]:
    """Runs of anything but U+0020 and U+0009 to U+000D, A-Z in lower case."""
    return encode(text).translate(_LOWER).split()


def encode(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def arrow_type(ddl: str) -> pa.DataType:
    """Of a plain type or of ``array<struct<name:type,...>>`` of plain types."""
    if ddl.startswith("array<struct<"):
        parts = [p.split(":") for p in ddl[len("array<struct<") : -2].split(",")]
        return pa.list_(pa.struct([(name, BYTE_TYPES[kind]) for name, kind in parts]))
    return BYTE_TYPES[ddl]


def per_text(
    docs: DataFrame,
    make: Callable[[], Callable[[str], tuple]],
    fields: Sequence[tuple[str, str]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: the id and what a function makes of the text.

    ``make`` builds that function once per task; it gets the whole text (a null
    as an empty one) and returns the values of ``fields``. Other columns of the
    input are not read. Rows stay in their partitions.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)])
    for name, ddl in fields:
        schema = schema.add(name, T.StructType.fromDDL(f"x {ddl}")["x"].dataType)
    types = [arrow_type(ddl) for _, ddl in fields]
    names = [id_col, *(name for name, _ in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            made = [of(text.as_py() or "") for text in batch.column(1)]
            columns = [batch.column(0)]
            columns += [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    picked = bounded_batches(docs).select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return picked.mapInArrow(lean(run), schema)
