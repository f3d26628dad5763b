"""Fill-in-the-middle: texts cut at two drawn places and put together in another order.

A text is a sequence of units: code points, or the matches of a pattern. It lies in
fixed blocks of code points. A Fenwick tree over the blocks holds how many units end and
how many code points lie in each. To find the end of a unit, a descent over the powers
of two finds its block and both counts before it, and the rest of the way is searched
within that block alone. So an index needs a few numbers per block, not one per unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.texts import bounded_batches

#: Code points of a block.
BLOCK = 1024
# Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that stay as they are, and of the others that start with the suffix.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20


class Fenwick:
    """Sums of counts over blocks, as a tree in one array; row ``i`` ends with block ``i - 1``."""

    def __init__(self, counts: np.ndarray) -> None:
        self.size = len(counts)
        sums = np.concatenate((np.zeros((1, counts.shape[1]), np.int64), np.cumsum(counts, axis=0)))
        at = np.arange(self.size + 1)
        self.tree = (sums - sums[at - (at & -at)]).tolist()
        self.top = 1 << self.size.bit_length() >> 1
        self.total = sums[-1].tolist()

    def descend(self, count: int) -> tuple[int, int, int]:
        """The block in which the first counts reach ``count``, and both counts before it."""
        block = first = second = 0
        step = self.top
        while step:
            at = block + step
            if at <= self.size and first + self.tree[at][0] < count:
                block, first, second = at, first + self.tree[at][0], second + self.tree[at][1]
            step >>= 1
        return block, first, second


class Blocks:
    """The units of one text; without a pattern every code point is one."""

    def __init__(self, text: str, pattern: re.Pattern | None = None, block: int = BLOCK) -> None:
        self.text, self.pattern = text, pattern
        blocks = -(-len(text) // block)
        points = np.full(blocks, block, np.int64)
        if blocks:
            points[-1] = len(text) - block * (blocks - 1)
        self.resume: list[int] = []
        units = points
        if pattern:
            # where matching goes on in a block: at the end of the last unit before it
            ends, self.resume = [0] * blocks, [0] * blocks
            last = 0
            for _, end in self._matches(0):
                at = (end - 1) // block
                if not ends[at]:
                    self.resume[at] = last
                ends[at] += 1
                last = end
            units = np.array(ends, np.int64)
        self.sums = Fenwick(np.stack((units, points), axis=1))
        self.units = self.sums.total[0]

    def _matches(self, start: int) -> Iterator[tuple[int, int]]:
        for found in self.pattern.finditer(self.text, start):
            if found.end() > found.start():
                yield found.span()

    def end_of(self, unit: int) -> int:
        """Code points up to the end of the first ``unit`` units."""
        if unit <= 0:
            return 0
        block, before, points = self.sums.descend(unit)
        if not self.pattern:
            return points + unit - before
        for found, (_, end) in enumerate(self._matches(self.resume[block]), before + 1):
            if found == unit:
                return end
        raise ValueError(f"{unit} of {self.units} units")


@dataclass(frozen=True)
class Infill:
    """How texts are put together. ``unit`` is a pattern; None stands for code points."""

    unit: str | None = None
    plain_percent: int = PLAIN_PERCENT
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT
    block: int = BLOCK

    def maker(self):
        pattern = re.compile(self.unit, re.DOTALL) if self.unit else None
        marks = (PREFIX, SUFFIX, MIDDLE)

        def make(text: str, draws: tuple[int, ...]) -> tuple:
            blocks = Blocks(text, pattern, self.block)
            n = blocks.units
            if not text or draws[2] % 100 >= 100 - self.plain_percent or any(m in text for m in marks):
                return n, "plain", None, None, text
            low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
            low, high = blocks.end_of(low), blocks.end_of(high)
            prefix, middle, suffix = text[:low], text[low:high], text[high:]
            if draws[3] % 100 < self.suffix_first_percent:
                form, made = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
            else:
                form, made = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
            return n, form, low, high - low, made

        return make


def fill_in_middle(
    docs: DataFrame,
    infill: Infill = Infill(),
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: id, ``n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units of the whole text. The draws are the first four groups of eight
    digits of the hex SHA-256 of ``seed:id``: two places, the form and the order; rows of one id
    have the same ones, and a null id stands for an empty one. A text stays ``plain`` if it is
    empty (or null, which counts as empty), if it has one of the marks, or by its draw; its
    two lengths are null. Others become ``psm`` or ``spm``, named by the order of their
    parts; lengths are in code points. ``original`` takes them apart again. Rows stay in
    their partitions; other columns of the input are not read.
    """
    kind = docs.schema[id_col].dataType
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    digits = F.sha2(name, 256)
    draws = [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    rows = bounded_batches(docs).select(
        F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("__text"), *[d.alias(f"__h{i}") for i, d in enumerate(draws)]
    )
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [id_col, "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = infill.maker()
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            made = [make(t, d) for t, d in zip(texts, zip(*(batch.column(i).to_pylist() for i in range(2, 6))))]
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = f"`{id_col}` {kind.simpleString()}, n bigint, form string, "
    return rows.mapInArrow(run, schema + "prefix_chars bigint, middle_chars bigint, output string")


def original(output: Column, form: Column) -> Column:
    """The text that was cut, from what was made of it: the marks occur only where they were set."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    one, two, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(one, middle, two))
        .when(form == "spm", F.concat(two, middle, one))
        .otherwise(output)
    )
