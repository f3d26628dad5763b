import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tabflow.checks.inputs import fresh_name
from tabflow.operators import graph as G
from tabflow.scratch import Scratch
from tabflow.sinks.graph_store import GraphStore
from tabflow.sinks.manifest import Files
from tests.helpers import rows

PAIRS = [(1, 2), (2, 1), (1, 2), (3, 3), (1, 4), (9, 1)]


@pytest.fixture
def pairs(spark):
    return lambda data: spark.createDataFrame(data, "src bigint, dst bigint")


@pytest.fixture
def store(spark, tmp_path):
    opened = GraphStore.open(spark, fresh_name("graph"), str(tmp_path / "graph"))
    yield opened
    opened.forget()


def test_nodes_and_edges(pairs):
    assert rows(G.follow_nodes(pairs(PAIRS))) == [(1,), (2,), (3,), (4,), (9,)]
    edges = G.follow_edges(pairs(PAIRS))
    assert {r["edge"] for r in edges.collect()} == {"1:2", "2:1", "3:3", "1:4", "9:1"}
    assert {(r["rel_type"], r["name"]) for r in edges.collect()} == {("KNOWS", "follows")}


def test_incident_edges_count_a_self_loop_once(pairs):
    found = rows(G.incident_edges(G.follow_edges(pairs(PAIRS))).select("userid", "src", "dst"))
    expected = [
        (node, s, d) for s, d in set(PAIRS) for node in {s, d}
    ]
    assert found == sorted(expected, key=repr)


def test_incident_edges_need_no_shuffle(spark, pairs, tmp_path, plan):
    path = str(tmp_path / "edges")
    G.follow_edges(pairs(PAIRS)).write.parquet(path)
    text = plan(G.incident_edges(spark.read.parquet(path)))
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_first_load_numbers_in_key_order(store, pairs):
    store.upsert(pairs(PAIRS))
    assert rows(store.nodes()) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 9)]
    assert rows(store.edges().select("rel_id", "edge")) == [
        (0, "1:2"),
        (1, "1:4"),
        (2, "2:1"),
        (3, "3:3"),
        (4, "9:1"),
    ]


def test_loading_again_changes_nothing(store, pairs):
    store.upsert(pairs(PAIRS))
    nodes, edges = rows(store.nodes()), rows(store.edges())
    store.upsert(pairs(PAIRS[::-1]))
    store.upsert(pairs([]))
    assert (rows(store.nodes()), rows(store.edges())) == (nodes, edges)


def test_incremental_loads_keep_ids_and_reach_the_same_graph(store, pairs):
    rng = random.Random(3)
    data = [(rng.randrange(60), rng.randrange(60)) for _ in range(900)]
    store.upsert(pairs(data[:300]))
    before = set(rows(store.edges()))
    store.upsert(pairs(data))
    assert before <= set(rows(store.edges()))
    edges = store.edges().collect()
    assert {(r["src"], r["dst"]) for r in edges} == set(data)
    assert sorted(r["rel_id"] for r in edges) == list(range(len(set(data))))
    nodes = store.nodes().collect()
    assert {r["userid"] for r in nodes} == {n for p in data for n in p}
    assert sorted(r["node_id"] for r in nodes) == list(range(len(nodes)))


class Interrupted(Exception):
    pass


def interrupt(*args):
    raise Interrupted


DENSE = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 9)]


@pytest.mark.parametrize("step", ["_commit", "_write"])
def test_before_its_version_a_load_has_not_happened(store, pairs, monkeypatch, step):
    monkeypatch.setattr(store, step, interrupt)
    with pytest.raises(Interrupted):
        store.upsert(pairs(PAIRS))
    monkeypatch.undo()
    assert rows(store.nodes()) == rows(store.edges()) == []
    assert store.upsert(pairs(PAIRS)) == {"nodes": 5, "edges": 5}
    assert rows(store.nodes()) == DENSE


@pytest.mark.parametrize("moved", [0, 1, 3])
def test_after_its_version_a_load_is_finished_by_whoever_comes_next(store, pairs, monkeypatch, moved):
    """Interrupted when some of its files have been moved."""
    whole = Files.move_new
    calls = []

    def some(self, source, target):
        if "/manifest/" not in target:
            calls.append(target)
            if len(calls) > moved:
                raise Interrupted
        return whole(self, source, target)

    monkeypatch.setattr(Files, "move_new", some)
    with pytest.raises(Interrupted):
        store.upsert(pairs(PAIRS))
    monkeypatch.undo()
    other = GraphStore.open(store.spark, fresh_name("graph"), store.location)
    assert rows(other.nodes()) == DENSE and other.edges().count() == 5
    assert other.upsert(pairs(PAIRS)) == {"nodes": 0, "edges": 0}
    other.forget()


@pytest.mark.parametrize("small", [0, 5_000])
def test_a_writer_that_comes_second_starts_anew(store, pairs, monkeypatch, small):
    monkeypatch.setattr("tabflow.sinks.graph_store.SMALL_LOAD", small)
    store.upsert(pairs([(1, 2)]))
    other = GraphStore.open(store.spark, fresh_name("graph"), store.location)
    commit = store._commit
    lost = []

    def late(aside, created):
        if len(lost) < 2:
            lost.append(other.upsert(pairs([(1, 3 + len(lost)), (50 + len(lost), 1)])))
        return commit(aside, created)

    monkeypatch.setattr(store, "_commit", late)
    assert store.upsert(pairs([(1, 2), (1, 3), (1, 7), (60, 61)])) == {"nodes": 3, "edges": 2}
    assert lost == [{"nodes": 2, "edges": 2}, {"nodes": 2, "edges": 2}]
    for one in (store, other):
        edges, nodes = one.edges().collect(), one.nodes().collect()
        assert sorted(r["rel_id"] for r in edges) == list(range(7))
        assert len({r["edge"] for r in edges}) == 7
        assert sorted(r["node_id"] for r in nodes) == list(range(9)) and len({r["userid"] for r in nodes}) == 9
    assert not Path(store.location, "staging").exists() or not list(Path(store.location, "staging").iterdir())
    other.forget()


def test_a_compaction_meanwhile_loses_no_rows(store, pairs, monkeypatch):
    store.upsert(pairs(PAIRS))
    other = GraphStore.open(store.spark, fresh_name("graph"), store.location)
    commit = store._commit

    def late(aside, created):
        monkeypatch.setattr(store, "_commit", commit)
        other.compact()
        return commit(aside, created)

    monkeypatch.setattr(store, "_commit", late)
    assert store.upsert(pairs([(1, 2), (7, 8)])) == {"nodes": 2, "edges": 1}
    assert store.edges().count() == 6
    other.forget()


def test_an_interrupted_compaction_leaves_catalog_entries_behind(spark, store, pairs, monkeypatch):
    """The entries still name the old folders; a load by them would be lost."""
    store.upsert(pairs(PAIRS))
    store.compact()
    before = rows(store.edges())
    monkeypatch.setattr(store, "_declare", lambda table: None)
    store.compact()
    monkeypatch.undo()
    again = GraphStore.open(spark, store.name, store.location)
    assert rows(again.edges()) == before
    assert again.upsert(pairs([(1, 2), (7, 8)])) == {"nodes": 2, "edges": 1}
    assert again.edges().count() == 6 == spark.table(f"{store.name}_edges").count()


def test_a_compaction_that_never_got_its_version_changes_nothing(store, pairs, monkeypatch):
    store.upsert(pairs(PAIRS))
    before = rows(store.edges())
    monkeypatch.setattr(store._manifest, "add", interrupt)
    with pytest.raises(Interrupted):
        store.compact()
    monkeypatch.undo()
    assert store.upsert(pairs([(7, 8)])) == {"nodes": 2, "edges": 1}
    assert set(before) < set(rows(store.edges()))


def test_tables_without_a_manifest_are_refused(spark, store, pairs):
    store.upsert(pairs(PAIRS))
    for file in Path(store.location, "manifest").iterdir():
        file.unlink()
    with pytest.raises(RuntimeError, match="no manifest"):
        GraphStore.open(spark, fresh_name("graph"), store.location)
    with pytest.raises(RuntimeError, match="lost its manifest"):
        store.upsert(pairs(PAIRS))


def test_an_unreadable_manifest_is_an_error(spark, store, pairs):
    store.upsert(pairs(PAIRS))
    last = sorted(Path(store.location, "manifest").glob("0*.json"))[-1]
    last.write_text("{")
    Path(last.parent, f".{last.name}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        GraphStore.open(spark, fresh_name("graph"), store.location)


def rows_read(df):
    """Rows that the file scans of a query return, before any filter above them."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_small_load_skips_most_row_groups(spark, tmp_path, pairs, conf):
    """2,000 scattered pairs, of which three are stored, beside 40,000 stored ones."""
    conf("spark.sql.adaptive.enabled", "false")
    store = GraphStore.open(spark, fresh_name("graph"), str(tmp_path / "large"), buckets=32)
    key = F.col("id")
    store.upsert(spark.range(40_000).select((key * 7).alias("src"), (key * 13 % 1_000).alias("dst")))
    known = [(7 * i, 13 * i % 1_000) for i in (5, 20_000, 39_999)]
    scattered = [(211 * i, 1_000 + i % 700) for i in range(1_997)] + known
    conf("spark.sql.parquet.pushdown.inFilterThreshold", "5000")
    found = store.lookup("edges", [f"{s}:{d}" for s, d in scattered])
    assert rows(found) == sorted(((f"{s}:{d}",) for s, d in known), key=repr)
    assert rows_read(store.edges().select("edge")) == 40_000
    assert rows_read(found) <= 8 * 40_000 / 32
    conf("spark.sql.parquet.pushdown.inFilterThreshold", "10")
    assert store.upsert(pairs(scattered))["edges"] == 1_997
    assert spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold") == "10"
    assert store.edges().count() == 41_997
    store.forget()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("partitions", ["3", "16"])
def test_another_session_setting_changes_nothing(spark, tmp_path, pairs, conf, partitions, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    conf("spark.sql.shuffle.partitions", "8")
    data = pairs([(i, 7 * i % 300) for i in range(300)])
    location = str(tmp_path / "it's")
    store = GraphStore.open(spark, fresh_name("graph"), location)
    assert store.upsert(data) == {"nodes": 300, "edges": 300}
    before = rows(store.nodes()), rows(store.edges())
    store.forget()
    conf("spark.sql.shuffle.partitions", partitions)
    again = GraphStore.open(spark, fresh_name("graph"), location)
    assert again.buckets == 8
    assert again.upsert(data) == {"nodes": 0, "edges": 0}
    assert (rows(again.nodes()), rows(again.edges())) == before
    assert again.upsert(pairs([(1, 2), (900, 1)])) == {"nodes": 1, "edges": 2}
    with pytest.raises(ValueError, match="8 buckets, not 4"):
        GraphStore.open(spark, fresh_name("graph"), location, buckets=4)
    again.forget()


def test_compacting_keeps_the_rows_in_fewer_files(store, pairs):
    for k in range(3):
        store.upsert(pairs([(i, i + k) for i in range(200)]))
    before = rows(store.nodes()), rows(store.edges()), len(store.edges().inputFiles())
    store.compact()
    assert (rows(store.nodes()), rows(store.edges())) == before[:2]
    assert len(store.edges().inputFiles()) <= store.buckets < before[2]
    assert store.upsert(pairs([(i, i) for i in range(201)])) == {"nodes": 0, "edges": 1}
    store.forget()
    again = GraphStore.open(store.spark, store.name, store.location)
    assert again.edges().count() == len(before[1]) + 1


def test_a_load_leaves_no_scratch_tables(spark, store, pairs):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("*"))
    store.upsert(pairs(PAIRS))
    assert set(folder.glob("*")) == before


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_only_new_with_and_without_broadcast(pairs, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    new = G.only_new(pairs([(1, 1), (1, 2), (2, 2)]), pairs([(1, 2), (5, 5)]), ["src", "dst"])
    assert rows(new) == [(1, 1), (2, 2)]


@pytest.fixture
def staged(monkeypatch):
    """What loads stage: (name, columns, rows)."""
    whole, found = Scratch.staged, []

    def kept(self, df, name):
        table = whole(self, df, name)
        found.append((name, table.columns, table.count()))
        return table

    monkeypatch.setattr(Scratch, "staged", kept)
    return found


@pytest.mark.parametrize("small", [0, 5_000])
def test_a_load_stages_keys_alone_and_only_ends_of_new_edges(store, pairs, monkeypatch, staged, small):
    monkeypatch.setattr("tabflow.sinks.graph_store.SMALL_LOAD", small)
    store.upsert(pairs([(i, i + 1_000) for i in range(300)]))
    first = [r for r in staged if r[0] == "numbered"]
    assert [r[2] for r in first] == [600, 300]
    staged.clear()
    assert store.upsert(pairs([(i, i + 1_000) for i in range(300)] + [(5, 7), (9, 2_000)])) == {"nodes": 1, "edges": 2}
    assert [r[2] for r in staged if r[0] == "users"] == [4]
    assert not any({"rel_type", "name"} & set(r[1]) for r in first + staged)
    edges = {(r["src"], r["dst"]): r for r in store.edges().collect()}
    assert tuple(edges[9, 2_000]) == (301, "9:2000", 9, 2_000, "KNOWS", "follows")
    assert len(edges) == 302 and store.nodes().count() == 601


@pytest.mark.parametrize("many", [1, 16])
def test_large_loads_beside_a_smaller_and_a_larger_store(store, pairs, monkeypatch, conf, many):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr("tabflow.sinks.graph_store.SMALL_LOAD", 0)
    monkeypatch.setattr("tabflow.sinks.graph_store.MANY_STORED", many)
    store.upsert(pairs([(i, i + 1) for i in range(400)]))
    before = set(rows(store.edges()))
    assert store.upsert(pairs([(i, i + 1) for i in range(350, 450)])) == {"nodes": 50, "edges": 50}
    assert before < set(rows(store.edges()))
    assert sorted(r["rel_id"] for r in store.edges().collect()) == list(range(450))
    assert sorted(r["userid"] for r in store.nodes().collect()) == list(range(451))


@pytest.mark.parametrize("small, created", [(0, {"nodes": 1, "edges": 1}), (5_000, {"nodes": 1, "edges": 0})])
def test_a_missing_end_is_found_nowhere(store, pairs, monkeypatch, small, created):
    monkeypatch.setattr("tabflow.sinks.graph_store.SMALL_LOAD", small)
    data = pairs([(None, 5), (5, 6)])
    assert store.upsert(data) == {"nodes": 3, "edges": 2}
    assert store.upsert(data) == created


def test_a_store_is_found_again(spark, store, pairs):
    store.upsert(pairs(PAIRS[:2]))
    store.forget()
    again = GraphStore.open(spark, store.name, store.location)
    again.upsert(pairs(PAIRS))
    assert rows(again.edges().select("rel_id", "edge"))[:2] == [(0, "1:2"), (1, "2:1")]
    assert again.edges().count() == 5


def test_the_stored_side_of_a_large_load_is_not_shuffled(spark, store, pairs, conf, plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    store.upsert(pairs(PAIRS))
    batch = pairs(PAIRS).distinct()
    stored = spark.table(f"{store.name}_edges")
    text = plan(G.only_new(batch, stored, ["src", "dst"]))
    scan = text[: text.index("FileScan")].splitlines()
    above = [line for line in scan if "Join" in line or "Exchange" in line]
    assert "LeftSemi" in above[-1], text  # the scan sits right below the join
    assert f"Bucketed: true" in text


def test_each_load_writes_one_file_per_bucket(store, pairs):
    store.upsert(pairs([(i, i + 1) for i in range(300)]))
    files = [f for f in store.edges().inputFiles() if f.endswith(".parquet")]
    assert 1 < len(files) <= store.buckets


def test_dump_joins_both_ends(store, pairs):
    store.upsert(pairs(PAIRS))
    found = rows(G.edge_dump(store.edges(), store.nodes()))
    ids = {r["userid"]: r["node_id"] for r in store.nodes().collect()}
    expected = [
        (r["rel_id"], ids[r["src"]], r["src"], "follows", ids[r["dst"]], r["dst"])
        for r in store.edges().collect()
    ]
    assert found == sorted(expected, key=repr)


def test_a_hot_user_is_split_in_the_dump(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "8")
    src = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    pairs = spark.range(0, 40_000, 1, 8).select(src.alias("src"), F.col("id").alias("dst"))
    store = GraphStore.open(spark, fresh_name("hot"), str(tmp_path / "hot"))
    store.upsert(pairs)
    dump = G.edge_dump(store.edges().repartition(8), store.nodes())
    found = dump.collect()
    store.forget()
    assert sorted((r["start_userid"], r["end_userid"]) for r in found) == sorted(
        (7 if i % 3 == 0 else i, i) for i in range(40_000)
    )
    assert "SortMergeJoin(skew=true)" in dump._jdf.queryExecution().executedPlan().toString()
