"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``COORDINATES`` values per set of word shingles. In every round each
shingle is hashed to one coordinate and competes there with its hash value; a value
of an earlier round always wins. After as many rounds as coordinates, each further
round serves one coordinate with all shingles, so every coordinate is filled. Two
sets agree in a coordinate with a probability equal to their similarity, and the
number of agreements is concentrated as for independent trials (Dahlgaard, Knudsen
and Thorup, 2017). Large sets fill a sketch in a few rounds.

Candidates share a band of coordinates. Texts with equal sets are one node. Within
a band's bucket, nodes are not paired with each other but with the bucket's hub, the
node that meets most others; links are confirmed on the full sets. Only nodes that
stay outside the hub's component are then held against the rest of the bucket. What
two nodes share lies in the hub or outside it. If their parts inside it may be
enough for a link, their sketches decide whether they become a candidate. If not,
both must hold the same shingles outside it, which few do: they meet on those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.components import components
from tabflow.llm.sieve import may_match
from tabflow.llm.texts import bounded_batches, encode, lean
from tabflow.scratch import staged

COORDINATES = 192
#: A pair at similarity 0.8 shares none of 38 bands with a probability of 3e-7.
BAND_ROWS = 5
BANDS = 38
#: Links need an intersection of at least so many percent of the union.
PERCENT = 80
#: Words per shingle where nothing else is asked for.
WORDS = 5
#: Bytes of text that are hashed at a time.
CHUNK = 1 << 19

_PLANES = 4  # bits kept of each coordinate for estimates
_LONGS = COORDINATES // 64
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of some texts, sorted by text, and their number per text.

    Words are runs of anything but blanks and U+0009 to U+000D, A-Z in lower case. A
    text with fewer words than a shingle has one shingle of all its words, one
    without words has none.
    """
    count = len(texts)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, count)
    flat = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    space = _SPACE[flat]
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(count, np.int64)
    powers = _powers(_BASE, len(flat))
    total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTES[flat] * powers, dtype=np.uint64)))
    word = (total[ends] - total[starts]) * _powers(_BASE_INVERSE, len(flat))[starts]
    word = _mix(word + (ends - starts).astype(np.uint64))
    text = np.searchsorted(np.cumsum(sizes), starts, "right")
    number = np.bincount(text, minlength=count)
    first = np.cumsum(number) - number

    hashes, owners = [], []
    full = len(word) - words + 1
    if full > 0:
        made = np.zeros(full, np.uint64)
        for j in range(words):
            made = _mix(made + word[j : j + full])
        same = text[:full] == text[words - 1 :]
        hashes.append(made[same])
        owners.append(text[:full][same])
    for t in np.flatnonzero((number > 0) & (number < words)):
        whole = np.zeros(1, np.uint64)
        for j in range(first[t], first[t] + number[t]):
            whole = _mix(whole + word[j])
        hashes.append(whole)
        owners.append(np.array([t]))
    value, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=count)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def sketch(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of coordinates per set; the rows of empty sets stay unfilled."""
    t = COORDINATES
    grid = np.full(len(sizes) * t, _NEVER, np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for turn in range(2 * t):
        if not len(values):
            break
        x = _mix(values + np.uint64((turn + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        if turn < t:
            at = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            at = turn - t
        low = np.uint64(turn << 40) | (x & np.uint64((1 << 40) - 1))
        np.minimum.at(grid, owner * t + at, low)
        open_ = (grid.reshape(-1, t) == _NEVER).any(axis=1)
        more = open_[owner]
        values, owner = values[more], owner[more]
    return grid.reshape(-1, t)


def _bands(grid: np.ndarray) -> np.ndarray:
    """A key per set and band; the band's number is part of it."""
    rows = grid[:, : BANDS * BAND_ROWS].reshape(len(grid), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(grid), BANDS))
    for j in range(BAND_ROWS):
        key = _mix(key + rows[:, :, j])
    return key.astype(np.int64)


def _planes(grid: np.ndarray) -> np.ndarray:
    """Some bits of all coordinates: per set ``_PLANES * _LONGS`` 64-bit words."""
    low = _mix(grid)
    bits = [(low >> np.uint64(p)).astype(np.uint8) & 1 for p in range(_PLANES)]
    packed = [np.packbits(b, axis=1).view("<i8") for b in bits]
    return np.concatenate(packed, axis=1)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of stretches of about ``CHUNK`` bytes."""
    held, size, first = [], 0, 0
    for i, text in enumerate(batch.column(1)):
        held.append(encode(text.as_py() or ""))
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _keys(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two sums of hashes per set, by which equal sets are known."""
    ends, sums = np.cumsum(sizes), []
    for salt in (1, 2):
        mixed = _mix(values ^ _mix(np.full(1, salt, np.uint64)))
        total = np.concatenate(([np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)))
        sums.append((total[ends] - total[ends - sizes]).astype(np.int64))
    return sums


_FACTS = "id bigint, n bigint, k1 bigint, k2 bigint, planes array<bigint>, bands array<bigint>"


def _sketches(words: int):
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
    names = ["id", "n", "k1", "k2", "planes", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch):
                values, sizes = shingles(texts, words)
                grid = sketch(values, sizes)
                columns = [batch.column(0).slice(first, len(texts)), sizes, *_keys(values, sizes)]
                columns += [list(_planes(grid)), list(_bands(grid))]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)],
                    names,
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch):
                values, sizes = shingles(texts, words)
                ends = np.cumsum(sizes)
                parts = [values[e - s : e].astype(np.int64) for e, s in zip(ends, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        *[pa.array(k, pa.int64()) for k in _keys(values, sizes)],
                        pa.array(parts, pa.list_(pa.int64())),
                    ],
                    ["id", "k1", "k2", "items"],
                )

    return run


def _least_agreements(percent: int) -> int:
    """Coordinates that a link agrees in but for a probability of about 1e-7."""
    p = percent / 100 + (1 - percent / 100) / (1 << _PLANES)
    return math.floor(COORDINATES * p - 5.2 * math.sqrt(COORDINATES * p * (1 - p)))


def _agreements(a: str, b: str) -> Column:
    """Coordinates whose kept bits agree in two rows with the planes as columns."""
    parts = []
    for i in range(_LONGS):
        unequal = F.lit(0).cast("bigint")
        for p in range(_PLANES):
            c = p * _LONGS + i
            unequal = unequal.bitwiseOR(F.col(f"{a}.p{c}").bitwiseXOR(F.col(f"{b}.p{c}")))
        parts.append(F.bit_count(unequal))
    return F.lit(COORDINATES) - sum(parts[1:], parts[0])


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Two texts are linked if ``100 * intersection >= percent * union`` of their
    distinct shingles. ``component_id`` is the smallest id that links reach, the
    row's own included, and a row is kept if it has that id. An empty or null text
    is linked with nothing. Rows that share an id are one document: they are linked
    with each other, and all or none are kept. Rows without an id are linked with
    nothing and kept, with a null component.
    """
    picked = bounded_batches(docs).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    facts = staged(picked.mapInArrow(lean(_sketches(words)), _FACTS), "sketches")
    known = facts.where(F.col("id").isNotNull() & (F.col("n") > 0))
    # one node per class of equal sets, numbered in the order of its smallest id, as rows of
    # one id can be of several classes
    classes = known.groupBy("k1", "k2").agg(F.min("id").alias("id")).orderBy("id", "k1", "k2")
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    node_of = classes.drop("id")
    links = staged(_links(picked, known, classes, words, percent), "links")

    # ids with several texts tie the classes of those texts together
    member = known.select("id", "k1", "k2").join(node_of, ["k1", "k2"])
    several = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    several = several.where("a <> z").select("id", "a")
    tied = member.join(several, "id").select("a", F.col("node").alias("b"))
    found = components(links.select("a", "b").union(tied))
    smallest = classes.select(F.col("node").alias("component"), F.col("id").alias("reached"))
    found = found.withColumnRenamed("id", "node").join(smallest, "component").drop("component")

    named = facts.join(classes.withColumnRenamed("id", "least"), ["k1", "k2"], "left").join(
        found, "node", "left"
    )
    linked = F.col("id").isNotNull() & (F.col("n") > 0)
    component = F.when(linked, F.coalesce("reached", "least")).otherwise(F.col("id"))
    return named.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _links(
    picked: DataFrame, known: DataFrame, classes: DataFrame, words: int, percent: int
) -> DataFrame:
    """Confirmed links ``a, b`` between nodes, enough to connect all that are linked."""
    # a class has one smallest id, so that these rows are its node; they are shuffled once
    sketched = known.groupBy("id", "k1", "k2").agg(
        F.min(F.struct("n", "planes", "bands")).alias("s"), F.count("*").alias("rows")
    )
    nodes = sketched.join(classes, ["id", "k1", "k2"])
    nodes = staged(nodes.select("node", "id", "k1", "k2", "rows", "s.*"), "nodes")
    spread = nodes.select("node", F.explode("bands").alias("key"))
    sizes = spread.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    live = staged(spread.join(sizes, "key"), "buckets")
    weight = live.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (
        live.join(weight, "node")
        .groupBy("key")
        .agg(F.max(F.struct("weight", F.negative("node").alias("m"))).alias("h"))
        .select("key", F.negative("h.m").alias("hub"))
    )
    met = staged(live.select("key", "node").join(hubs, "key"), "met")
    wanted = nodes.select("node", "id", "k1", "k2", "rows").join(live.select("node"), "node", "left_semi")
    wanted = staged(wanted, "wanted")
    # few texts are wanted, so the others are left out before anything is shuffled
    texts = may_match(picked, wanted.select("id"), "id", "may").where("may").select("id", "text")
    read = texts.mapInArrow(lean(_sets(words)), "id bigint, k1 bigint, k2 bigint, items array<bigint>")
    read = staged(read.join(wanted, ["id", "k1", "k2"]).select("node", "rows", "items"), "sets")
    # rows repeated with their id give their set once
    repeated = read.where("rows > 1").groupBy("node").agg(F.first("items").alias("items"))
    sets = read.where("rows = 1").select("node", "items").union(repeated)

    pairs = met.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    checked = staged(_verified(pairs.distinct(), sets, percent), "checked")
    first = checked.where("linked").select("a", "b")
    found = components(first).select(F.col("id").alias("node"), "component")
    rest = _rest(nodes, met, checked, found, percent)
    return first.union(_verified(rest, sets, percent).where("linked").select("a", "b"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with their overlap on the full sets, and whether they are linked."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - F.col("both")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("both", both)
        .select(
            "a",
            "b",
            F.col("both").cast("bigint").alias("both"),
            (100 * F.col("both") >= percent * union).alias("linked"),
            F.array_except("x", "y").alias("own"),
        )
    )


def _rest(
    nodes: DataFrame, met: DataFrame, checked: DataFrame, found: DataFrame, percent: int
) -> DataFrame:
    """Pairs with a common hub that may be linked but are in different components."""
    hub_is = found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    rows = (
        checked.select(F.col("a").alias("node"), F.col("b").alias("hub"), "both", "own")
        .join(found, "node", "left")
        .join(hub_is, "hub", "left")
        .join(nodes.select("node", "n"), "node")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("loose", F.col("component") != F.coalesce("hub_component", "hub"))
    )
    mixed = rows.where("loose").select("hub").distinct()
    rows = staged(rows.join(mixed, "hub", "left_semi").drop("hub_component"), "loose")
    return _inside(rows, nodes, met, percent).union(_outside(rows, percent)).distinct()


def _apart() -> Column:
    """Of rows ``a`` (loose) and ``b``: not yet connected, and each pair only once."""
    once = (F.col("a.node") < F.col("b.node")) | ~F.col("b.loose")
    return (F.col("a.component") != F.col("b.component")) & once


def _enough(shared: Column, percent: int) -> Column:
    """Whether so many shared items would be a link of ``a`` and ``b``."""
    return (100 + percent) * shared >= percent * (F.col("a.n") + F.col("b.n"))


def _inside(rows: DataFrame, nodes: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket whose overlaps with the hub may be enough for a link."""
    planes = [F.col("planes")[i].alias(f"p{i}") for i in range(_PLANES * _LONGS)]
    kept = staged(
        met.join(rows.drop("own"), ["node", "hub"]).join(nodes.select("node", *planes), "node"),
        "inside",
    )
    a, b = kept.where("loose").alias("a"), kept.alias("b")
    near = _agreements("a", "b") >= _least_agreements(percent)
    may = _enough(F.least("a.both", "b.both"), percent) & near
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & _apart() & may)
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _outside(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs that must share items outside the hub, found by those items.

    A link needs ``percent`` of the larger set, so each side needs that much of its own
    less its overlap with the hub from outside. Of items in one order, two lists that
    share ``need`` meet within all but the last ``need - 1`` of each (prefix filter). The
    rarest items of a hub come first, so that most of those have no partner at all.
    """
    facts = ("node", "hub", "component", "n", "both", "loose", "m")
    items = rows.withColumn("m", F.size("own")).select(*facts, F.explode("own").alias("item"))
    often = items.groupBy("hub", "item").agg(F.count("*").alias("often")).where("often > 1")
    need = F.greatest(F.lit(1), F.ceil(percent * F.col("n") / 100) - F.col("both"))
    length = F.greatest(F.lit(0), F.col("m") - need + 1).cast("int")
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "item")))
    items = (
        items.join(often, ["hub", "item"], "left")
        .groupBy(*facts)
        .agg(order.alias("own"))
        .select(*facts, F.explode(F.slice("own", F.lit(1), length)).alias("o"))
        .where("o.often > 1")
        .select(*facts, F.col("o.item").alias("item"))
    )
    a, b = items.where("loose").alias("a"), items.alias("b")
    most = F.least("a.both", "b.both") + F.least("a.m", "b.m")
    same = (F.col("a.hub") == F.col("b.hub")) & (F.col("a.item") == F.col("b.item"))
    pairs = a.join(b, same & _apart() & _enough(most, percent))
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def without_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all their columns.

    Rows without an id are kept. Repeated rows of a kept id are repeated.
    """
    found = near_duplicates(docs, words, percent, id_col, text_col)
    gone = staged(found.where(~F.col("kept")).select(id_col).distinct(), "gone")
    names = [F.col(f"`{c}`") for c in docs.columns]
    may = "__may"
    while any(c.lower().startswith(may) for c in docs.columns):
        may += "_"
    # rows that cannot be gone stay where they are; only the others are shuffled to the join
    rows = may_match(docs, gone, id_col, may)
    rest = rows.where(f"`{may}`").join(gone, id_col, "left_anti")
    return rows.where(f"NOT `{may}`").select(*names).union(rest.select(*names))
