"""Telling most rows without a partner from the others before a join on their ids.

A join that keeps few rows of a wide table shuffles all of them. Here the ids of the other
side become a Bloom filter in pieces, which is broadcast: a row whose id is among them
always passes, few others do, and only rows that pass need the join. The filter takes
``BITS`` bits for each id up to ``MOST_PIECES`` pieces of 4 KB, whatever the input; beyond
that more rows pass, and the join still decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each id; two of them are set, so that about 1.4 % of the other rows pass.
BITS = 16
#: Pieces of the filter at most, 64 MB in all.
MOST_PIECES = 1 << 14

_PIECE_BITS = 8 * 4096  # what bitmap_construct_agg() makes


def may_match(rows: DataFrame, ids: DataFrame, id_col: str, name: str) -> DataFrame:
    """The rows with ``name``: false only where their id is not in ``ids``, a table of one column.

    A null id gets either value. The rows are not shuffled. ``ids`` is read twice, so it is
    best ``staged``. No column of ``rows`` may begin with ``name``.
    """
    pieces = max(1, min(MOST_PIECES, -(-BITS * ids.count() // _PIECE_BITS)))
    piece, bits = f"{name}_piece", f"{name}_bits"
    key = F.col(f"`{ids.columns[0]}`")
    marks = ids.select(_piece(key, pieces).alias(piece), F.explode(F.array(*_places(key))).alias(bits))
    # dealt by piece before they are merged, as a merged piece is larger than its ids
    merged = F.bitmap_construct_agg(F.col(bits)).alias(bits)
    maps = marks.repartition(piece).groupBy(piece).agg(merged)

    own = F.col(f"`{id_col}`").cast(ids.schema[0].dataType)
    first, second = [_has(F.col(bits), place) for place in _places(own)]
    found = rows.withColumn(piece, _piece(own, pieces)).join(F.broadcast(maps), piece, "left")
    passes = F.coalesce(first & second, F.lit(False)).alias(name)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], passes)


def _piece(key: Column, pieces: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(pieces))


def _places(key: Column) -> list[Column]:
    """Two bits of a piece."""
    return [F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(_PIECE_BITS)) for salt in (1, 2)]


def _has(bits: Column, place: Column) -> Column:
    """Whether a bit is set; every byte holds its bits from the lowest upwards."""
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1
