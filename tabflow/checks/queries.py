"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.checks import inputs
from tabflow.checks.inputs import table
from tabflow.fixed import LOCATION_HEADER_LINES
from tabflow.functions.weeks import standby_suffix
from tabflow.operators import clean, geo, graph, numbering, placement, uniques
from tabflow.plans.graphs import load_users
from tabflow.plans.places import load_city_locations
from tabflow.plans.relational import export_partition
from tabflow.scratch import scratch_path
from tabflow.sinks import files, jdbc, publish
from tabflow.sinks.graph_store import GraphStore
from tabflow.sinks.partition import overwrite_partition
from tabflow.sources import lines
from tabflow.sources.jdbc import read_jdbc

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that the SQL repeats.
USERS_PER_BATCH = 500
ORDERS_PER_FILE = 5_000
LOAD_TIME = "2013-06-11 00:00:00"
FIRST_PUBLISH = datetime(2013, 6, 4)
SECOND_PUBLISH = datetime(2013, 6, 11)


def explode_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniques.explode_unique(inputs.id_list_lines(table(spark, sf_dir, "lineitem")))


def partition_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.partitioned_id_lists(
        table(spark, sf_dir, "lineitem"), scratch_path(spark, "idlists")
    )
    chosen = lines.partition_lines(
        spark,
        path,
        "uniq_type string, year int, datecomputed date",
        ["uniq_type", "year", "datecomputed"],
        ["sessionid", "1996:1999", "1996-04-01:1999-07-01"],
    )
    return uniques.explode_unique(chosen)


def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniques.id_list_counts(inputs.id_list_lines(table(spark, sf_dir, "lineitem")))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniques.word_count(table(spark, sf_dir, "documents"), "text")


def seqfile_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.sequence_files(
        table(spark, sf_dir, "conversations"),
        F.col("text"),
        F.col("role"),
        scratch_path(spark, "turns"),
    )
    turns = lines.sequence_file(spark, path, "key string, value string")
    return uniques.word_count(turns, "key")


def seqfile_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.sequence_files(
        table(spark, sf_dir, "customer"),
        F.col("c_custkey"),
        F.col("c_name"),
        scratch_path(spark, "names"),
    )
    out = scratch_path(spark, "text")
    files.write_lines(
        lines.sequence_file(spark, path, "key string, value string").select("value"), out
    )
    return lines.text_lines(spark, out).select(F.col("value").alias("line"))


def line_copy_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.order_files(
        table(spark, sf_dir, "orders"), scratch_path(spark, "orders"), ORDERS_PER_FILE
    )
    return lines.offset_lines(spark, path).select("byte_offset", F.col("value").alias("line"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.edge_list(inputs.follower_lines(table(spark, sf_dir, "lineitem")))


def edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placement.cluster_rows(_pairs(spark, sf_dir), "src")


def follow_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.follow_nodes(_pairs(spark, sf_dir))


def follow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.follow_edges(_pairs(spark, sf_dir))


def graph_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the shipped lines first, then everything; stored edges keep their ids."""
    everything = inputs.follower_lines(table(spark, sf_dir, "lineitem"))
    shipped = everything.where(F.col("l_linestatus") == "F")
    return _loaded_graph(spark, clean.edge_list(shipped), clean.edge_list(everything)).edges()


def _loaded_graph(spark: SparkSession, *loads: DataFrame) -> GraphStore:
    """A store after some loads; each load opens it under another shuffle setting."""
    name, location = inputs.fresh_name("graph"), scratch_path(spark, "graph")
    key = "spark.sql.shuffle.partitions"
    partitions = spark.conf.get(key)
    store = GraphStore.open(spark, name, location)
    for n, pairs in enumerate(loads):
        if n:
            store.forget()
            spark.conf.set(key, str(2 * int(partitions)))
            store = GraphStore.open(spark, name, location)
        store.upsert(pairs)
    spark.conf.set(key, partitions)
    store.forget()
    return store


def edge_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _loaded_graph(spark, _pairs(spark, sf_dir))
    return graph.edge_dump(store.edges(), store.nodes())


def incident_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.incident_edges(graph.follow_edges(_pairs(spark, sf_dir)))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [table(spark, sf_dir, name) for name in ("customer", "nation", "region")]
    return clean.user_records(inputs.user_lines(*tables))


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(spark, sf_dir).select(
        "userid", "username", "fname", "lname", "mname", "email", "location.*"
    )


def user_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(spark, sf_dir).select("userid", "username")
    return numbering.batch_numbers(users, USERS_PER_BATCH, order_by=["userid"])


def user_send(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send all users in numbered batches to a folder, twice, and read them back from there."""
    tables = [table(spark, sf_dir, name) for name in ("customer", "nation", "region")]
    given, outbox, target = (scratch_path(spark, name) for name in ("users", "outbox", "sent"))
    files.write_lines(inputs.user_lines(*tables), given)
    sender = "tabflow.sinks.record_batches:save_as_json"
    for _ in range(2):
        load_users(spark, given, sender, size=USERS_PER_BATCH, outbox=outbox, target=target)
    schema = "userid bigint, username string, email string, location struct<city: string>"
    return spark.read.schema(schema).json(target).select(
        "userid",
        "username",
        "email",
        "location.city",
        F.split(F.col("_metadata.file_name"), r"\.")[0].cast("bigint").alias("batch"),
    )


def _locations(spark: SparkSession, sf_dir: str, city: Column, **options: str | bool) -> DataFrame:
    part = table(spark, sf_dir, "part")
    located = geo.city_locations(
        geo.feed_places(inputs.feed_lines(part)),
        inputs.known_cities(part).withColumn("city", city),
        ts_added=F.lit(LOAD_TIME).cast("timestamp_ntz"),
        **options,
    )
    return located.withColumn("ts_added", F.col("ts_added").cast("string"))


def city_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _locations(spark, sf_dir, F.col("city"))


def city_locations_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City names in another case and padded, matched under a collation."""
    city = F.concat(F.upper("city"), F.lit("  "))
    return _locations(spark, sf_dir, city, collation="UTF8_LCASE_RTRIM")


def city_locations_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of common names divided before the join."""
    return _locations(spark, sf_dir, F.col("city"), salted=True)


def city_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append locations to a relational table; the load is run twice."""
    part, target = table(spark, sf_dir, "part"), inputs.database(spark)
    feed, name = scratch_path(spark, "feed"), inputs.fresh_name("locations")
    files.write_lines(inputs.feed_lines(part), feed)
    cities = inputs.known_cities(part).select("city_id", "city")
    for _ in range(2):
        load_city_locations(
            spark, feed, cities, target, name, datetime.fromisoformat(LOAD_TIME)
        )
    stored = read_jdbc(spark, target, name, "city_id")
    return stored.withColumn("ts_added", F.col("ts_added").cast("string"))


def feed_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = geo.keyed_by_country(inputs.feed_lines(table(spark, sf_dir, "part")))
    return placement.cluster_rows(keyed, "country").withColumnRenamed("value", "line")


def country_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.location_files(
        table(spark, sf_dir, "supplier"), scratch_path(spark, "locations")
    )
    rows = geo.centroids(lines.lines_after_header(spark, path, LOCATION_HEADER_LINES))
    return rows.select(
        "country",
        "region",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )


def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_totalprice",
        F.col("o_orderdate").cast("date").cast("string").alias("order_day"),
        F.when(F.col("o_orderstatus") == "F", F.lit("\\N"))
        .when(F.col("o_orderstatus") == "O", F.concat("o_orderpriority", F.lit("\t\n\\t")))
        .alias("note"),
    )
    path = scratch_path(spark, "orders")
    files.write_lines(files.to_tsv(orders.select("order_day")), path)
    files.write_lines(files.to_tsv(orders), path)  # replaces the first output
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderpriority string, "
        "o_totalprice double, order_day string, note string"
    )
    return files.read_tsv(lines.text_lines(spark, path), schema)


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load three partitions, then replace one with rows and one with none."""
    songs = inputs.song_columns(table(spark, sf_dir, "part"))
    name, path = inputs.fresh_name("songs"), scratch_path(spark, "songs")
    schema = ", ".join(f"{c} {t}" for c, t in songs.dtypes)
    spark.sql(
        f"CREATE TABLE {name} ({schema}, test_part STRING) USING parquet "
        f"PARTITIONED BY (test_part) LOCATION '{path}'"
    )
    raised = songs.withColumn("popularity", F.col("popularity") + 1)
    overwrite_partition(songs, name, {"test_part": "2013-06-01"})
    overwrite_partition(songs, name, {"test_part": "2013-06-02"})
    overwrite_partition(songs, name, {"test_part": "2013-06-03"})
    overwrite_partition(raised, name, {"test_part": "2013-06-01"})
    overwrite_partition(songs.where("song_id is null"), name, {"test_part": "2013-06-03"})
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.schema(f"{schema}, test_part string").parquet(path)


def jdbc_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read a relational table in parallel and land it as one table partition."""
    target, source = inputs.database(spark), inputs.fresh_name("songs")
    songs = inputs.song_columns(table(spark, sf_dir, "part"))
    jdbc.load_jdbc(songs, target, source)
    name, path = inputs.fresh_name("exported"), scratch_path(spark, "exported")
    schema = ", ".join(f"{c} {t}" for c, t in songs.dtypes)
    spark.sql(
        f"CREATE TABLE {name} ({schema}, test_part STRING) USING parquet "
        f"PARTITIONED BY (test_part) LOCATION '{path}'"
    )
    export_partition(spark, target, source, "song_id", name, {"test_part": "2013-06-01"})
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.schema(f"{schema}, test_part string").parquet(path)


def jdbc_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a relational table twice; the second load replaces the first."""
    target, name = inputs.database(spark), inputs.fresh_name("customers")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    jdbc.load_jdbc(customers.withColumn("c_acctbal", F.lit(0.0)), target, name)
    jdbc.load_jdbc(customers, target, name)
    return read_jdbc(spark, target, name, "c_custkey")


def ab_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a table in one week, and two more versions of it in the following week."""
    songs = inputs.song_columns(table(spark, sf_dir, "part"))
    name, pointer = inputs.fresh_name("songs"), inputs.fresh_name("pointers")
    location = scratch_path(spark, "published")
    publish.write_pointers(spark, pointer, {"songs": "", "other": "Table1"})
    old = songs.withColumn("popularity", F.lit(0).cast("bigint"))
    for rows, at in ((old, FIRST_PUBLISH), (old, SECOND_PUBLISH), (songs, SECOND_PUBLISH)):
        item = publish.Publication("songs", name, rows)
        publish.publish_tables(spark, [item], at, pointer, location)
    pointers = spark.table(pointer).where(F.col("property") == "songs").collect()
    live = spark.table(name).withColumn("live_copy", F.lit(pointers[0]["value"]))
    inputs.drop_all(spark, name, pointer)  # external tables: the files stay
    return live


def jdbc_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a relational database, with its pointer table beside it."""
    target = inputs.database(spark)
    name, pointer = inputs.fresh_name("customers"), inputs.fresh_name("pointers")
    inputs.pointer_table(spark, target, pointer, {"customers": "", "other": "Table1"})
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    old = customers.withColumn("c_acctbal", F.lit(0.0))
    for rows, at in ((old, FIRST_PUBLISH), (customers, SECOND_PUBLISH)):
        item = publish.Publication("customers", name, rows)
        publish.publish_jdbc(spark, [item], at, pointer, target)
    pointers = target.apply(spark.read).option("dbtable", pointer).load().collect()
    live = {r["property"]: (r["value"], r["note"]) for r in pointers}
    stored = read_jdbc(spark, target, f"{name}_{live['customers'][0]}", "c_custkey")
    return stored.withColumns(
        {
            "live_copy": F.lit(live["customers"][0]),
            "note": F.lit(live["customers"][1]),
            "other": F.lit(live["other"][0]),
        }
    )


def week_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", standby_suffix(F.col("ts")).alias("suffix")
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        explode_unique,
        partition_range_scan,
        record_counts,
        word_count,
        seqfile_word_count,
        seqfile_to_text,
        line_copy_offset,
        edge_list,
        follow_nodes,
        follow_edges,
        graph_upsert,
        edge_dump,
        incident_edges,
        user_records,
        user_batches,
        user_send,
        city_locations,
        city_locations_collated,
        city_locations_salted,
        city_load,
        feed_by_country,
        country_region,
        tsv_roundtrip,
        partition_overwrite,
        jdbc_export,
        jdbc_load,
        ab_publish,
        jdbc_publish,
        week_suffix,
    )
}
