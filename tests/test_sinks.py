import json
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tabflow.checks.inputs import drop_all, fresh_name, pointer_table
from tabflow.sinks import files, publish
from tabflow.sinks import jdbc as jdbc_sink
from tabflow.sinks import partition
from tabflow.sinks.jdbc import load_jdbc
from tabflow.sinks.partition import add_partition, drop_partition, overwrite_partition
from tabflow.sinks.record_batches import send_in_batches
from tabflow.sources.jdbc import JdbcTarget, count_jdbc, query_jdbc, update_jdbc
from tabflow.sources.lines import text_lines
from tests.helpers import rows

JUNE_4, JUNE_11 = datetime(2013, 6, 4), datetime(2013, 6, 11)


def failing(df):
    """The rows of ``df``, but reading the last of them fails."""
    last = df.agg(F.max("id")).first()[0]
    broken = F.when(F.col("id") == last, F.raise_error(F.lit("broken"))).otherwise(F.col("id"))
    return df.withColumn("id", broken.cast("bigint"))


# Text files


def test_nulls_do_not_shift_columns(spark, tmp_path):
    schema = "a bigint, b string, c double"
    df = spark.createDataFrame([(1, None, 0.1), (None, "", None), (3, "x y", 1e300)], schema)
    path = str(tmp_path / "t")
    assert files.write_lines(files.to_tsv(df), path) == 3
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == [
        "1\t\\N\t0.1",
        "3\tx y\t1.0E300",
        "\\N\t\t\\N",
    ]
    assert rows(files.read_tsv(text_lines(spark, path), schema)) == rows(df)


def test_texts_with_separators_stay_whole(spark, tmp_path):
    texts = ["a\tb", "c\nd", "e\rf", "g\r\nh", "\\N", "\\", "\\\\t", "\\t", "x\\", "\t\\\n", ""]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "i int, t string, n string")
    path = str(tmp_path / "t")
    assert files.write_lines(files.to_tsv(df), path) == len(texts)
    found = text_lines(spark, path)
    assert found.count() == len(texts)
    assert rows(files.read_tsv(found, "i int, t string, n string")) == rows(df)


def test_foreign_backslashes_can_be_plain(lines):
    found = files.read_tsv(lines("C:\\new\t\\N"), "a string, b string", escape=False)
    assert rows(found) == [("C:\\new", None)]


def test_output_is_replaced_or_refused(spark, tmp_path, lines):
    path = str(tmp_path / "t")
    files.write_lines(lines("a", "b"), path)
    assert files.write_lines(lines("c"), path) == 1
    assert [r["value"] for r in spark.read.text(path).collect()] == ["c"]
    with pytest.raises(AnalysisException):
        files.write_lines(lines("d"), path, replace=False)


def test_text_partitions(spark, tmp_path):
    df = spark.range(6).select("id", (F.col("id") % 2).alias("odd"), F.lit("x").alias("v"))
    path = str(tmp_path / "t")
    files.write_lines(files.to_tsv(df, ("odd",)), path, partition_by=("odd",))
    found = text_lines(spark, path, "odd int").where("odd = 1")
    assert sorted(r["value"] for r in found.collect()) == ["1\tx", "3\tx", "5\tx"]


def test_discard_runs_the_whole_plan(spark):
    with pytest.raises(PySparkException, match="broken"):
        files.discard(failing(spark.range(5)))


# One partition of a table


@pytest.fixture
def table(spark):
    name = fresh_name("parts")
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT, p STRING, q INT) USING parquet PARTITIONED BY (p, q)"
    )
    yield name
    spark.sql(f"DROP TABLE {name}")


def sizes(spark, table):
    counts = spark.table(table).groupBy("p", "q").count().collect()
    return {(r["p"], r["q"]): r["count"] for r in counts}


def test_only_the_named_partition_is_replaced(spark, table):
    assert overwrite_partition(spark.range(5), table, {"p": "a", "q": 1}) == 5
    assert overwrite_partition(spark.range(6), table, {"p": "it's", "q": 1}) == 6
    assert overwrite_partition(spark.range(2), table, {"q": 1, "p": "a"}) == 2
    assert sizes(spark, table) == {("a", 1): 2, ("it's", 1): 6}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_an_empty_export_empties_the_partition_but_keeps_it(spark, table):
    overwrite_partition(spark.range(5), table, {"p": "a", "q": 1})
    overwrite_partition(spark.range(5), table, {"p": "b", "q": 1})
    assert overwrite_partition(spark.range(0), table, {"p": "a", "q": 1}) == 0
    assert sizes(spark, table) == {("b", 1): 5}
    shown = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert shown == {"p=a/q=1", "p=b/q=1"}


def test_a_failed_export_leaves_the_old_partition(spark, table):
    overwrite_partition(spark.range(5), table, {"p": "a", "q": 1})
    with pytest.raises(PySparkException, match="broken"):
        overwrite_partition(failing(spark.range(100)), table, {"p": "a", "q": 1})
    assert sizes(spark, table) == {("a", 1): 5}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_exports_in_threads_keep_each_others_partitions(spark, table):
    """The first one to end must not make the others replace the whole table."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before, started, first = spark.conf.get(key), threading.Event(), threading.Event()

    def quick():
        started.wait()
        overwrite_partition(spark.range(5), table, {"p": "quick", "q": 1})
        first.set()

    def late():
        with partition._dynamic_overwrite(spark):
            started.set()
            first.wait()
            assert spark.conf.get(key) == "dynamic"
            overwrite_partition(spark.range(3), table, {"p": "late", "q": 1})

    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(quick), pool.submit(late)]:
            done.result()
    assert spark.conf.get(key) == before and not partition._exports
    assert sizes(spark, table) == {("quick", 1): 5, ("late", 1): 3}


def test_a_table_of_text_lines(spark):
    name = fresh_name("text")
    spark.sql(f"CREATE TABLE {name} (value STRING, day STRING) USING text PARTITIONED BY (day)")
    df = spark.range(3).withColumn("n", F.lit(None).cast("string"))
    for day in ("1", "2", "1"):
        overwrite_partition(files.to_tsv(df), name, {"day": day})
    found = sorted(tuple(r) for r in spark.table(name).collect())
    assert found == [(f"{i}\t\\N", d) for i in range(3) for d in "12"]
    spark.sql(f"DROP TABLE {name}")


def test_the_table_and_columns_must_exist(spark, table):
    with pytest.raises(ValueError, match="does not exist"):
        overwrite_partition(spark.range(1), "no_such_table", {"p": "a"})
    with pytest.raises(ValueError, match="nope"):
        overwrite_partition(spark.range(1), table, {"nope": 1})


def test_nothing_is_written_for_a_wrong_spec(spark, table):
    overwrite_partition(spark.range(5), table, {"p": "a", "q": 1})
    for spec in ({"p": "a"}, {"p": "a", "q": 1, "id": 7}, {"id": 7}):
        with pytest.raises(ValueError, match="is partitioned by"):
            overwrite_partition(spark.range(9), table, spec)
    assert sizes(spark, table) == {("a", 1): 5}


def test_an_empty_export_empties_an_external_table(spark, tmp_path):
    name = fresh_name("external")
    spark.sql(
        f"CREATE TABLE {name} (id BIGINT, p STRING, q INT) USING parquet "
        f"PARTITIONED BY (p, q) LOCATION '{tmp_path / 'files'}'"
    )
    for p in "ab":
        overwrite_partition(spark.range(5), name, {"p": p, "q": 1})
    assert overwrite_partition(spark.range(0), name, {"p": "a", "q": 1}) == 0
    assert sizes(spark, name) == {("b", 1): 5}
    assert spark.read.parquet(str(tmp_path / "files")).count() == 5
    spark.sql(f"DROP TABLE {name}")


def test_partition_definitions(spark, table):
    add_partition(spark, table, {"p": "x", "q": 3})
    add_partition(spark, table, {"p": "x", "q": 3})
    assert spark.sql(f"SHOW PARTITIONS {table}").collect()[0][0] == "p=x/q=3"
    drop_partition(spark, table, {"p": "x", "q": 3})
    drop_partition(spark, table, {"p": "x", "q": 3})
    assert spark.sql(f"SHOW PARTITIONS {table}").collect() == []


# Relational targets


@pytest.fixture
def database():
    return JdbcTarget(
        "jdbc:derby:memory:sinks;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    )


def stored(spark, database, table):
    return database.apply(spark.read).option("dbtable", table).load()


def test_replace_and_append(spark, database):
    assert load_jdbc(spark.range(25_000), database, "ids") == 25_000
    assert load_jdbc(spark.range(10), database, "ids") == 10
    assert load_jdbc(spark.range(10, 15), database, "ids", replace=False) == 5
    assert rows(stored(spark, database, "ids")) == sorted([(i,) for i in range(15)], key=repr)


def test_a_short_load_is_noticed(spark, database, monkeypatch):
    load_jdbc(spark.range(3), database, "short")
    monkeypatch.setattr("tabflow.sinks.jdbc._attempts", lambda *a: [(0, 1, 2)])
    with pytest.raises(RuntimeError, match="5 rows sent, 2 rows found"):
        load_jdbc(spark.range(5), database, "short")
    assert count_jdbc(spark, database, "short") == 3


@pytest.mark.parametrize("replace", [True, False])
def test_a_task_that_ran_again_after_its_insert_is_counted_once(spark, database, monkeypatch, replace):
    """Every row is sent by two complete attempts of a task, and some by a broken third one."""
    name = fresh_name("again")
    first = spark.range(100, 103).withColumn("text", F.lit(None).cast("string"))
    load_jdbc(first, database, name)
    send = jdbc_sink._send

    def twice(rows, *rest):
        send(rows, *rest)
        send(rows.where("id < 20"), *rest)
        send(rows, *rest)

    monkeypatch.setattr(jdbc_sink, "_send", twice)
    df = spark.range(0, 50, 1, 3).withColumn("text", F.concat(F.lit("n"), "id"))
    left = [] if replace else [(i, None) for i in range(100, 103)]
    assert load_jdbc(df, database, name, replace=replace) == 50
    wanted = [(i, f"n{i}") for i in range(50)] + left
    assert rows(stored(spark, database, name)) == sorted(wanted, key=repr)


def test_a_failed_load_leaves_the_target_as_it_was(spark, database, monkeypatch):
    name = fresh_name("kept")
    load_jdbc(spark.range(4), database, name)
    move = jdbc_sink._move

    def broken(df, target, stage, table, attempts, *rest):
        return move(df, target, "no_such_table", table, attempts, *rest)

    monkeypatch.setattr(jdbc_sink, "_move", broken)
    with pytest.raises(Exception):
        load_jdbc(spark.range(9), database, name)
    assert count_jdbc(spark, database, name) == 4
    found = query_jdbc(spark, database, "SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLENAME LIKE ?", [f"{name.upper()}%"])
    assert found == [name.upper()]  # no staging table is left


def test_a_failed_truncate_fails_the_load(spark, database):
    database.apply(spark.range(1).write).option("dbtable", "base").save()
    wider = spark.range(2).withColumn("other", F.lit(1))
    with pytest.raises(Exception):
        load_jdbc(wider, database, "base")


# Publishing


@pytest.fixture
def pointer(spark):
    name = fresh_name("pointers")
    publish.write_pointers(spark, name, {"songs": "none", "it's": "Table1"})
    yield name
    spark.sql(f"DROP VIEW {name}")


@pytest.fixture
def songs(spark):
    name = fresh_name("songs")
    yield name
    drop_all(spark, name)


def publish_at(spark, table, df, at, pointer, prop="songs"):
    return publish.publish_tables(spark, [publish.Publication(prop, table, df)], at, pointer)


def test_weeks_alternate_and_the_pointer_follows(spark, songs, pointer):
    seen = []
    for n, at in ((3, JUNE_4), (4, JUNE_11)):
        assert publish_at(spark, songs, spark.range(n), at, pointer) == {songs: n}
        assert spark.table(songs).count() == n
        seen.append(dict(rows(spark.table(pointer)))["songs"])
    assert sorted(seen) == ["Table1", "Table2"]
    assert spark.table(f"{songs}_{seen[0]}").count() == 3  # kept for a roll-back
    assert dict(rows(spark.table(pointer)))["it's"] == "Table1"


def test_publishing_again_in_the_same_week_replaces(spark, songs, pointer):
    publish_at(spark, songs, spark.range(3), JUNE_4, pointer)
    publish_at(spark, songs, spark.range(7), JUNE_4, pointer)
    assert spark.table(songs).count() == 7


def test_a_failed_load_does_not_flip(spark, songs, pointer):
    publish_at(spark, songs, spark.range(3), JUNE_4, pointer)
    before = rows(spark.table(pointer))
    with pytest.raises(PySparkException, match="broken"):
        publish_at(spark, songs, failing(spark.range(9)), JUNE_11, pointer)
    assert spark.table(songs).count() == 3 and rows(spark.table(pointer)) == before


def test_an_unknown_property_changes_no_pointer(spark, songs, pointer):
    before = rows(spark.table(pointer))
    publish_at(spark, songs, spark.range(3), JUNE_4, pointer, prop="other")
    assert rows(spark.table(pointer)) == before


def test_a_failed_publish_in_the_same_week_keeps_the_live_copy(spark, songs, pointer):
    publish_at(spark, songs, spark.range(3), JUNE_4, pointer)
    before = rows(spark.table(pointer))
    with pytest.raises(PySparkException, match="broken"):
        publish_at(spark, songs, failing(spark.range(9)), JUNE_4, pointer)
    assert spark.table(songs).count() == 3 and rows(spark.table(pointer)) == before


def test_a_list_that_failed_half_way_can_be_run_again(spark, songs, pointer):
    good = publish.Publication("songs", songs, spark.range(3))
    bad = publish.Publication("it's", f"{songs}_b", failing(spark.range(3)))
    for _ in range(2):
        with pytest.raises(PySparkException, match="broken"):
            publish.publish_tables(spark, [good, bad], JUNE_4, pointer)
        assert spark.table(songs).count() == 3
    mended = publish.Publication("it's", f"{songs}_b", spark.range(2))
    publish.publish_tables(spark, [good, mended], JUNE_4, pointer)
    assert (spark.table(songs).count(), spark.table(f"{songs}_b").count()) == (3, 2)


def test_earlier_tables_of_a_copy_are_dropped(spark, songs, pointer):
    for n in (3, 4, 5):
        publish_at(spark, songs, spark.range(n), JUNE_4, pointer)
    names = [t.name for t in spark.catalog.listTables(pattern=f"{songs}_table*")]
    assert len(names) == 2  # the copy's view and the table it shows


def pointers(spark, database, name):
    table = database.apply(spark.read).option("dbtable", name).load()
    return {r["property"]: (r["value"], r["note"]) for r in table.collect()}


def test_publishing_to_a_database(spark, database):
    bag = fresh_name("bag")
    pointer_table(spark, database, bag, {"s": "none", "t": "Table1"})
    chart = fresh_name("chart")

    def publish_rows(df, at=JUNE_4, prop="s"):
        item = publish.Publication(prop, chart, df)
        return publish.publish_jdbc(spark, [item], at, bag, database, connections=2)

    assert publish_rows(spark.range(4)) == {chart: 4}
    live = pointers(spark, database, bag)
    assert live["t"] == ("Table1", "kept") and live["s"][1] == "kept"
    assert count_jdbc(spark, database, f"{chart}_{live['s'][0]}") == 4
    with pytest.raises(PySparkException, match="broken"):
        publish_rows(failing(spark.range(9)))  # the same week
    assert pointers(spark, database, bag) == live
    assert count_jdbc(spark, database, f"{chart}_{live['s'][0]}") == 4
    publish_rows(spark.range(6))
    now = pointers(spark, database, bag)
    assert now["s"][0] != live["s"][0] and now["t"] == live["t"]
    assert count_jdbc(spark, database, f"{chart}_{now['s'][0]}") == 6
    with pytest.raises(ValueError, match="0 rows"):
        publish_rows(spark.range(1), prop="nobody")
    assert pointers(spark, database, bag) == now


def test_a_wrong_update_is_rolled_back(spark, database):
    bag = fresh_name("bag")
    pointer_table(spark, database, bag, {"s": "1", "t": "1"})
    with pytest.raises(RuntimeError, match="2 rows changed instead of 1"):
        update_jdbc(spark, database, f'UPDATE {bag} SET "value" = ?', ["2"], expected=1)
    assert pointers(spark, database, bag)["s"] == ("1", "kept")


def test_the_input_of_a_load_runs_once(spark, database):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 100, 1, 8).mapInArrow(count, "id bigint")
    assert load_jdbc(df, database, fresh_name("once")) == 100
    assert seen.value == 100


def test_an_append_with_a_key_can_be_run_again(spark, database):
    name = fresh_name("keyed")
    for key, n in ((1, 5), (2, 7), (2, 3), (1, 5)):
        df = spark.range(n).withColumn("load", F.lit(key))
        assert load_jdbc(df, database, name, replace=False, load_key=("load", key)) == n
    found = stored(spark, database, name).groupBy("load").count()
    assert {r["load"]: r["count"] for r in found.collect()} == {1: 5, 2: 3}


# External stores


def test_records_are_sent_in_bounded_batches(spark, tmp_path, monkeypatch):
    folder = tmp_path / "sent"
    folder.mkdir()
    location = F.struct(F.lit("x").alias("city")).alias("location")
    df = spark.range(0, 25, 1, 2).select(F.lit(str(folder)).alias("folder"), "id", location)
    send_in_batches(df, "tests.helpers:save_batch", size=5)
    batches = [json.loads(p.read_text()) for p in folder.iterdir()]
    assert all(len(b) <= 5 for b in batches)
    sent = [r for b in batches for r in b]
    assert sorted(r["id"] for r in sent) == list(range(25))
    assert sent[0]["location"] == {"city": "x"}
