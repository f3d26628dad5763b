"""Mixing sources to target weights as a minimum-cost flow.

A document may belong to several sources. Documents are summed by membership
pattern (the set of their sources); the flow network has a node per pattern and per
source only, so it does not grow with the documents. Words flow from a pattern to
any of its sources' quotas; the first pass over a pattern costs less than the second
and so on, so words are repeated only where quotas cannot be met without it. The
flow per pattern is then taken from its documents in the order of a seeded hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.scratch import staged

#: Words that make up a document's size.
WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)
#: Words of the mix per word of the corpus.
SHARE = Fraction(3, 2)
#: A document is taken at most so many times.
MAX_REPEATS = 2
SEED = 17
#: Hash ranges in which sizes are summed to find where a pattern's selection ends.
RANGES = 1 << 14


def word_count(text: Column) -> Column:
    """Words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sizes: dict[str | None, int],
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    max_repeats: int = MAX_REPEATS,
) -> dict[str | None, float]:
    """Words to take per source: by weight, but never above ``max_repeats`` times its size.

    What a source cannot take is shared again by weight among those below their
    limit, until none is above. Sources are ordered by code point, null last.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left = share * sum(sizes.values())
    open_, out = set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        got = {s: left * weight[s] / total for s in open_}
        full = {s for s in open_ if got[s] >= max_repeats * sizes[s]}
        if not full:
            out |= got
            break
        for s in full:
            out[s] = Fraction(max_repeats * sizes[s])
            left -= out[s]
        open_ -= full
    return {s: float(out[s]) for s in order}


def route(
    patterns: dict[tuple, int], quotas: dict, max_repeats: int = MAX_REPEATS
) -> dict[tuple, dict]:
    """Words to take from each pattern for each of its sources, at least cost.

    ``patterns`` maps sets of sources, as tuples, to words. The k-th pass over a
    pattern's words costs k. Successive shortest paths on integers, sources and
    patterns in a fixed order, so a rerun gives the same flow.
    """
    quotas = {s: round(q) for s, q in quotas.items()}
    names = list(patterns)
    first_source = 1 + len(names)
    place = {s: first_source + i for i, s in enumerate(quotas)}
    sink = first_source + len(quotas)
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    to, room, cost = [], [], []

    def edge(a: int, b: int, size: int, price: int) -> int:
        for x, y, r, c in ((a, b, size, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
        return len(to) - 2

    carried: list[tuple[tuple, object, int]] = []
    for i, name in enumerate(names):
        for k in range(max_repeats):
            edge(0, 1 + i, patterns[name], k + 1)
        for s in name:
            at = edge(1 + i, place[s], max_repeats * patterns[name], 0)
            carried.append((name, s, at))
    for s, quota in quotas.items():
        edge(place[s], sink, quota, 0)

    potential = [0] * (sink + 1)
    while True:
        far = [None] * (sink + 1)
        via: list[int | None] = [None] * (sink + 1)
        far[0], queue = 0, [(0, 0)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                if room[e] > 0:
                    new = d + cost[e] + potential[a] - potential[to[e]]
                    if far[to[e]] is None or new < far[to[e]]:
                        far[to[e]], via[to[e]] = new, e
                        heapq.heappush(queue, (new, to[e]))
        if far[sink] is None:
            break
        reach = max(d for d in far if d is not None)
        potential = [p + (reach if d is None else d) for p, d in zip(potential, far)]
        path, at = [], sink
        while at:
            path.append(via[at])
            at = to[via[at] ^ 1]
        moved = min(room[e] for e in path)
        for e in path:
            room[e] -= moved
            room[e ^ 1] += moved
    flow: dict[tuple, dict] = {name: {} for name in names}
    for name, s, e in carried:
        flow[name][s] = room[e ^ 1]
    return flow


def mix(
    docs: DataFrame,
    sources: Column,
    size: Column,
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    id_col: str = "doc_id",
    row_col: str | None = None,
) -> DataFrame:
    """Per input row: id, ``size``, ``source_size``, ``target``, ``taken``, ``repeats``.

    ``sources`` is the array of a document's sources (a source may be null; a null
    or empty array is the null source), ``size`` its words. A source's size is that
    of all its documents. ``taken`` is ``repeats`` times the size: whole documents,
    0 to ``max_repeats`` times. ``source_size`` and ``target`` are sums over the
    document's sources. Selection follows a seeded hash of the id up to the last
    document that fits; then the document whose size is nearest to what is missing
    is added. Rows of one id and size share that last decision, unless ``row_col`` names a
    column of unique numbers: it breaks ties, spreads rows without an id, and is returned too.

    Driver memory holds one number per pattern. Prefix sums are over ``RANGES`` hash
    ranges per pattern; rows are windowed only in the one range where a pattern's
    selection ends.
    """
    known = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    pattern = F.when(F.size(known) == 0, F.array(F.lit(None).cast("string"))).otherwise(known)
    row = F.col(f"`{row_col}`") if row_col else F.lit(None).cast("bigint")
    mark = F.xxhash64(F.lit(seed), F.col("id"), F.when(F.col("id").isNull(), F.col("row")))
    facts = staged(
        docs.select(
            F.col(f"`{id_col}`").alias("id"), row.alias("row"), pattern.alias("pattern"), size.alias("size")
        )
        .withColumn("mark", mark)
        .withColumn("range", F.pmod("mark", F.lit(RANGES)).cast("int")),
        "sizes",
    )
    sums = facts.groupBy("pattern").agg(F.sum("size").alias("size")).collect()
    patterns = {tuple(r["pattern"]): r["size"] for r in sorted(sums, key=lambda r: str(r[0]))}
    sizes: dict[str | None, int] = {}
    for name, words in patterns.items():
        for s in name:
            sizes[s] = sizes.get(s, 0) + words
    quota = targets(sizes, weights, share, max_repeats)
    flow = route(patterns, quota, max_repeats)
    plan = [
        (
            list(name),
            int(sum(sizes[s] for s in name)),
            float(sum(quota[s] for s in name)),
            *_passes(patterns[name], sum(flow[name].values()), max_repeats),
        )
        for name in patterns
    ]
    schema = "p array<string>, source_size long, target double, base int, goal long"
    plan_table = docs.sparkSession.createDataFrame(plan, schema)

    # goal: words that get one repeat more than base, taken in the order of the hash.
    # plan: one row per pattern, as many as the driver has just held.
    ranges = facts.groupBy("pattern", "range").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranges.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    same = F.col("pattern") == F.col("p")
    goal, before = F.col("goal"), F.col("before")
    ends = (
        summed.join(F.broadcast(plan_table), same)
        .where((before < goal) & (goal <= before + F.col("words")))
        .select(F.col("p").alias("pattern"), F.col("range").alias("end"), "before")
    )
    limits = plan_table.join(F.broadcast(ends), same, "left").drop("pattern")
    rows = facts.join(F.broadcast(limits), same)
    inside = rows.where(F.col("range") < F.coalesce("end", F.lit(-1))).withColumn("more", F.lit(1))
    outside = rows.where(F.col("end").isNull() | (F.col("range") > F.col("end"))).withColumn(
        "more", F.lit(0)
    )
    order = Window.partitionBy("pattern").orderBy("mark", "id", "size", "row")
    end = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    edge = rows.where(F.col("range") == F.col("end")).withColumn("more", (end <= goal).cast("int"))
    chosen = inside.unionByName(edge).unionByName(outside).drop("p", "end", "before")
    # what is still missing goes to the one document left out whose size is nearest to it
    gaps = chosen.groupBy("pattern").agg(
        F.first("goal").alias("g"), F.sum(F.col("more") * F.col("size")).alias("w")
    ).select(F.col("pattern").alias("p"), (F.col("g") - F.col("w")).alias("gap"))
    off = F.abs(F.col("size") - F.col("gap"))
    filler = (
        chosen.where((F.col("more") == 0) & (F.col("size") > 0))
        .join(F.broadcast(gaps), same)
        .where(off < F.col("gap"))
        .groupBy("p")
        .agg(F.min(F.struct(off.alias("off"), "mark", "id", "size", "row")).alias("f"))
    )
    found = (F.col("more") == 0) & F.col("id").eqNullSafe(F.col("f.id"))
    found = found & (F.col("size") == F.col("f.size")) & F.col("row").eqNullSafe(F.col("f.row"))
    more = F.col("more") + F.coalesce(found.cast("int"), F.lit(0))
    repeats = F.least(F.col("base") + more, F.lit(max_repeats))
    return chosen.join(F.broadcast(filler), same, "left").select(
        F.col("id").alias(id_col),
        *([F.col("row").alias(row_col)] if row_col else []),
        "size",
        "source_size",
        "target",
        (repeats * F.col("size")).cast("bigint").alias("taken"),
        repeats.alias("repeats"),
    )


def _passes(size: int, words: int, max_repeats: int) -> tuple[int, int]:
    """Repeats that every document gets, and the words to take beyond them."""
    if not size:
        return 0, 0
    base = min(words // size, max_repeats)
    return int(base), int(words - base * size)
