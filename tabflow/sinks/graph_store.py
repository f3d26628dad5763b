"""The follower graph as two growing tables with get-or-create loads."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.graph import follow_nodes, follow_pairs, only_new, relationships
from tabflow.operators.numbering import dense_numbers
from tabflow.scratch import Scratch
from tabflow.sinks.manifest import Files, Manifest
from tabflow.sinks.partition import sql_text

COLUMNS = {
    "nodes": "node_id bigint, userid bigint",
    "edges": "rel_id bigint, edge string, src bigint, dst bigint, rel_type string, name string",
}
KEYS = {"nodes": ["userid"], "edges": ["src", "dst"]}
IDS = {"nodes": "node_id", "edges": "rel_id"}
#: The one column that tells rows apart; files have a Bloom filter on it.
LOOKUP = {"nodes": "userid", "edges": "edge"}
#: Share of the absent keys that a Bloom filter lets through.
FALSE_HITS = 1e-6
#: Pairs of a load whose keys are looked up by those filters, instead of joined, at most.
SMALL_LOAD = 5_000
#: A load with fewer keys than one in this many stored ones reduces the stored side first.
MANY_STORED = 16
#: How often a load starts anew because another writer was faster.
TRIES = 10

#: Keys in one list of such a lookup. Readers compare the keys of a list one after the other, and
#: a longer one would nest too deeply; lists are joined in pairs.
KEYS_IN_LIST = 100
_IN_LIST = "spark.sql.parquet.pushdown.inFilterThreshold"


@dataclass(frozen=True)
class _State:
    """A version of the store. ``moves`` are files of it that may still lie where they were
    written: (table, file with its folder)."""

    buckets: int
    nodes: str = "nodes"
    edges: str = "edges"
    next_nodes: int = 0
    next_edges: int = 0
    moves: list[list[str]] = field(default_factory=list)


@contextmanager
def _at_least(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    """Raise a setting that changes plans, not results."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(value, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class GraphStore:
    """Catalog tables ``<name>_nodes`` and ``<name>_edges``, bucketed by their keys.

    A large load is shuffled into the buckets of the stored keys and joined there; the
    stored graph itself is never shuffled. The keys of a small load are looked up, and
    the Bloom filters of the files skip all row groups that have none of them. What the
    keys tell of an edge is added when its file is written: until then a load shuffles,
    sorts and stages its keys alone.

    ``<location>/manifest`` has the versions of the store: its number of buckets, the next
    ids, the folders of both tables and the files a load adds. A load writes its files
    aside and then adds one version, which makes its nodes and edges count together; until
    then nothing has happened. Files that a version names are moved into the tables'
    folders after that, by the load or, if it was interrupted, by whoever comes next.
    Several writers may load at a time: the one that comes second starts anew on the
    version of the first. Catalog entries follow from the manifest.
    """

    def __init__(self, spark: SparkSession, name: str, location: str) -> None:
        self.spark = spark
        self.name = name
        self.location = location.rstrip("/")
        self._files = Files(spark, location)
        self._manifest = Manifest(self._files, f"{self.location}/manifest")
        self._version = -1
        self._state = _State(0)

    @property
    def buckets(self) -> int:
        return self._state.buckets

    @classmethod
    def open(
        cls, spark: SparkSession, name: str, location: str, buckets: int | None = None
    ) -> GraphStore:
        """The store at ``location``; it is created there if it is missing.

        For a new store ``buckets`` defaults to the shuffle partitions of the
        session. Fewer than those make Spark shuffle the stored side of large
        loads; more leave more small files behind each small load. A store that
        exists keeps its number, and another one is refused, as is a folder that has
        tables but no manifest.
        """
        store = cls(spark, name, location)
        if store._manifest.latest() is None:
            if any(store._files.names(f"{store.location}/{table}") for table in COLUMNS):
                raise RuntimeError(f"{store.location} has tables but no manifest")
            count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            store._manifest.add(-1, asdict(_State(count)))
        store._refresh()
        if buckets not in (None, store.buckets):
            raise ValueError(f"{store.location} has {store.buckets} buckets, not {buckets}")
        return store

    def _refresh(self) -> None:
        """Go to the latest version: finish its moves and match the catalog entries to it."""
        found = self._manifest.latest()
        if found is None:
            raise RuntimeError(f"{self.location} has lost its manifest")
        self._version, self._state = found[0], _State(**found[1])
        self._finish()
        for table in COLUMNS:
            self._declare(table)

    def _finish(self) -> None:
        """Move the files that the version names to their tables, if they are not there yet."""
        for table, file in self._state.moves:
            target = f"{self._folder(table)}/{file.rsplit('/', 1)[1]}"
            source = f"{self.location}/{file}"
            if self._files.exists(source):
                self._files.move_new(source, target)
            elif not self._files.exists(target):
                raise RuntimeError(f"{self.location} has lost {file}")

    def _folder(self, table: str) -> str:
        return f"{self.location}/{getattr(self._state, table)}"

    def _declare(self, table: str) -> None:
        """A catalog entry with the folder and buckets of this version."""
        name, keys = f"{self.name}_{table}", ", ".join(KEYS[table])
        folder = self._folder(table)
        self._files.make(folder)
        if self.spark.catalog.tableExists(name):
            facts = self.spark.sql(f"DESCRIBE FORMATTED {name}").collect()
            is_at = next(r["data_type"] for r in facts if r["col_name"] == "Location")
            has = next(r["data_type"] for r in facts if r["col_name"] == "Num Buckets")
            if _plain(is_at) == _plain(folder) and int(has) == self.buckets:
                self.spark.catalog.refreshTable(name)
                return
            self.spark.sql(f"DROP TABLE {name}")  # external: the files stay
        self.spark.sql(
            f"CREATE TABLE {name} ({COLUMNS[table]}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION {sql_text(folder)}"
        )

    def nodes(self) -> DataFrame:
        return self._read("nodes")

    def edges(self) -> DataFrame:
        return self._read("edges")

    def _read(self, table: str) -> DataFrame:
        """The rows without their buckets, so that joins on one end can split hot users."""
        return self.spark.read.schema(COLUMNS[table]).parquet(self._folder(table))

    def forget(self) -> None:
        """Remove the catalog entries; the files stay and ``open`` finds them again."""
        for table in COLUMNS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}")

    def upsert(self, pairs: DataFrame) -> dict[str, int]:
        """Create the nodes and edges of ``(src, dst)`` pairs that do not exist yet.

        Returns how many of each were created. Loading the same pairs again changes
        nothing, so a failed load is finished by running it again. Ids continue from the
        last load's, in key order and without gaps.
        """
        with Scratch(self.spark) as scratch:
            batch = scratch.staged(follow_pairs(pairs), "pairs")
            for _ in range(TRIES):
                self._refresh()
                aside = f"staging/{uuid.uuid4().hex}"
                edges = self._new("edges", batch, scratch)
                users = scratch.staged(follow_nodes(self._with_new_ends(edges, batch)), "users")
                created = {
                    "nodes": self._write_new("nodes", self._new("nodes", users, scratch), aside, scratch),
                    "edges": self._write_new("edges", edges, aside, scratch),
                }
                if not any(created.values()) or self._commit(aside, created):
                    return created
                self._files.remove(f"{self.location}/{aside}")
        raise RuntimeError(f"{self.location}: other writers were faster {TRIES} times")

    def _commit(self, aside: str, created: dict[str, int]) -> bool:
        moves = [
            [table, f"{aside}/{table}/{file}"]
            for table in COLUMNS
            for file in self._files.names(f"{self.location}/{aside}/{table}")
            if file.endswith(".parquet")
        ]
        nexts = {f"next_{t}": getattr(self._state, f"next_{t}") + n for t, n in created.items()}
        if not self._manifest.add(self._version, asdict(replace(self._state, moves=moves, **nexts))):
            return False
        self._refresh()
        self._files.remove(f"{self.location}/{aside}")
        return True

    def _with_new_ends(self, edges: DataFrame, batch: DataFrame) -> DataFrame:
        """The pairs of a load whose ends may be new; those of a stored edge came with it.

        A missing end is found nowhere, so pairs with one always count.
        """
        if edges is batch:
            return batch
        return edges.unionByName(batch.where(F.col("src").isNull() | F.col("dst").isNull()))

    def _write_new(self, table: str, new: DataFrame, aside: str, scratch: Scratch) -> int:
        """Write rows that are not stored, with ids, below ``aside``; their number."""
        count = new.count()
        if count:
            numbered = dense_numbers(new, "__n", KEYS[table], unique=True, stage=scratch.staged)
            start = getattr(self._state, f"next_{table}")
            with_ids = numbered.withColumn(IDS[table], F.col("__n") + start)
            self._write(table, with_ids, f"{self.location}/{aside}/{table}", count)
        return count

    def _new(self, table: str, rows: DataFrame, scratch: Scratch) -> DataFrame:
        """The staged keys that are not stored; they have been written once."""
        known = getattr(self._state, f"next_{table}")
        if not known:
            return rows  # nothing is stored
        column, keys = LOOKUP[table], KEYS[table]
        named = relationships(rows) if table == "edges" else rows
        wanted = [r[0] for r in named.select(column).limit(SMALL_LOAD + 1).collect()]
        if len(wanted) > SMALL_LOAD:
            low, high, count = rows.agg(F.min(keys[0]), F.max(keys[0]), F.count("*")).first()
            # stored files are sorted by key, so the range skips what cannot match
            stored = self.spark.table(f"{self.name}_{table}").where(F.col(keys[0]).between(low, high))
            if count < known // MANY_STORED:
                return scratch.staged(only_new(rows, stored, keys), "new")
            # in the buckets of the stored side, whatever the session's partitions
            bucketed = rows.repartition(self.buckets, *keys)
            return scratch.staged(bucketed.join(stored.select(*keys), keys, "left_anti"), "new")
        with _at_least(self.spark, _IN_LIST, KEYS_IN_LIST):
            hits = scratch.staged(self.lookup(table, wanted), "hits")
        return scratch.staged(named.join(F.broadcast(hits), column, "left_anti").select(*rows.columns), "new")

    def lookup(self, table: str, wanted: list) -> DataFrame:
        """Which of a short list of keys are stored, by a filter that reaches the files.

        Row groups are skipped by their Bloom filters while ``inFilterThreshold`` of
        Spark's Parquet settings is at least ``KEYS_IN_LIST``.
        """
        column = LOOKUP[table]
        lists = [wanted[i : i + KEYS_IN_LIST] for i in range(0, max(1, len(wanted)), KEYS_IN_LIST)]
        tests = [F.col(column).isin(keys) for keys in lists]
        while len(tests) > 1:
            tests = [reduce(or_, tests[i : i + 2]) for i in range(0, len(tests), 2)]
        return self._read(table).where(tests[0]).select(column)

    def _write(self, table: str, rows: DataFrame, folder: str, count: int) -> None:
        """One sorted file for each bucket; edges may come as their keys and ids."""
        made = f"{self.name}_{table}_{uuid.uuid4().hex}"
        columns = [part.split()[0] for part in COLUMNS[table].split(", ")]
        per_bucket = rows.repartition(self.buckets, *KEYS[table])
        if table == "edges" and LOOKUP[table] not in rows.columns:
            per_bucket = relationships(per_bucket)  # not shuffled
        writer = per_bucket.select(*columns).write.format("parquet").bucketBy(self.buckets, *KEYS[table]).sortBy(*KEYS[table])
        self._with_filters(table, writer, count).option("path", folder).saveAsTable(made)
        self.spark.sql(f"DROP TABLE {made}")  # external: the files stay

    def _with_filters(self, table: str, writer: DataFrameWriter, count: int) -> DataFrameWriter:
        column = LOOKUP[table]
        return writer.options(
            **{
                f"parquet.bloom.filter.enabled#{column}": "true",
                f"parquet.bloom.filter.expected.ndv#{column}": str(2 * count // self.buckets + 100),
                f"parquet.bloom.filter.fpp#{column}": str(FALSE_HITS),
                "parquet.bloom.filter.max.bytes": str(16 << 20),
            }
        )

    def compact(self) -> None:
        """Merge the files of all loads into one per bucket.

        The merged files are written to a new folder, and one new version switches to it. If
        another writer adds a version meanwhile, the table is merged again. The old
        folder stays for readers that use it.
        """
        for table in COLUMNS:
            for _ in range(TRIES):
                self._refresh()
                folder = f"{table}-{uuid.uuid4().hex}"
                rows = self._read(table)
                self._write(table, rows, f"{self.location}/{folder}", rows.count())
                if self._manifest.add(self._version, asdict(replace(self._state, moves=[], **{table: folder}))):
                    break
                self._files.remove(f"{self.location}/{folder}")
            else:
                raise RuntimeError(f"{self.location}: other writers were faster {TRIES} times")
        self._refresh()


def _plain(location: str) -> str:
    """A location without its ``file:`` scheme, in which two forms of a path may differ."""
    return "/" + location.removeprefix("file:").strip("/") if location.startswith(("file:", "/")) else location
