"""Job inputs derived from the given tables, with dirty rows among the clean ones.

Every input is a projection (or a join with a fixed small dimension) of a whole
table, so it grows with the table and no step gathers a group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.sources.jdbc import JdbcTarget, update_jdbc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tabbed(*fields: Column) -> Column:
    return F.concat_ws("\t", *[f.cast("string") for f in fields]).alias("value")


def id_list_lines(lineitem: DataFrame) -> DataFrame:
    """A part id and a comma list of the supplier and order it was seen with.

    Unusable ids carry a null marker, unusable lists are blank; some lists start
    with an empty item (which counts) or end with empty items (which do not).
    """
    key = (
        F.when(F.col("l_discount") == 0.1, "NULL")
        .when(F.col("l_tax") == 0.08, "\\N")
        .otherwise(F.col("l_partkey").cast("string"))
    )
    items = F.concat(
        F.when(F.col("l_returnflag") == "R", ",").otherwise(""),
        F.concat_ws(
            ",",
            F.concat(F.lit("s"), "l_suppkey"),
            F.concat(F.lit("o"), "l_orderkey"),
            F.concat(F.lit("s"), "l_suppkey"),
        ),
        F.when(F.col("l_returnflag") == "N", ",,").otherwise(""),
    )
    listed = F.when(F.col("l_linenumber") == 7, "   ").otherwise(items)
    return lineitem.select(tabbed(key, listed), "l_linestatus", "l_shipdate")


def partitioned_id_lists(lineitem: DataFrame, path: str) -> str:
    """The id lists as text below ``uniq_type``, ``year`` and ``datecomputed`` folders."""
    lines = id_list_lines(lineitem).select(
        "value",
        F.when(F.col("l_linestatus") == "O", "sessionid").otherwise("userid").alias("uniq_type"),
        F.year("l_shipdate").alias("year"),
        F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("datecomputed"),
    )
    folders = ("uniq_type", "year", "datecomputed")
    lines.hint("rebalance", *folders).write.partitionBy(*folders).text(path)
    return path


def follower_lines(lineitem: DataFrame) -> DataFrame:
    """A pair of ids per line, some padded, some with markers, some with one field."""
    src = (
        F.when(F.col("l_linenumber") == 7, "NULL")
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("  "), "l_partkey", F.lit(" ")))
        .otherwise(F.col("l_partkey").cast("string"))
    )
    dst = F.when(F.col("l_discount") == 0.1, "\\N").otherwise(F.col("l_suppkey").cast("string"))
    line = F.when(F.col("l_tax") == 0.08, F.concat(src, F.lit("\t\t"))).otherwise(
        F.concat_ws("\t", src, dst, F.lit("extra"))
    )
    return lineitem.select(line.alias("value"), "l_linestatus")


def user_lines(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """A profile line per customer; three nations stand for three kinds of bad id."""
    userid = (
        F.when(F.col("c_nationkey") == 3, "NULL")
        .when(F.col("c_nationkey") == 5, F.concat(F.lit("x"), "c_custkey"))
        .when(F.col("c_nationkey") == 7, "-1")
        .otherwise(F.col("c_custkey").cast("string"))
    )
    fname = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "\\N").otherwise(F.col("c_mktsegment"))
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return people.select(
        tabbed(
            userid,
            F.concat(F.lit(" "), "c_name"),
            F.lit("unused"),
            fname,
            F.lit(""),
            F.lit("NULL"),
            F.col("n_name"),
            F.concat(F.lit("S"), "n_regionkey"),
            F.col("r_name"),
            F.col("c_custkey") + 10000,
            F.concat("c_custkey", F.lit("@example.com")),
        )
    )


def feed_lines(part: DataFrame) -> DataFrame:
    """A geographic feed line per part."""
    empty = F.lit("")
    return part.select(
        tabbed(
            F.col("p_partkey"),
            F.col("p_name"),
            F.col("p_name"),
            empty,
            F.col("p_size"),
            F.col("p_retailprice"),
            empty,
            empty,
            F.col("p_type"),
            empty,
            F.col("p_brand"),
        )
    )


def known_cities(part: DataFrame) -> DataFrame:
    """One city id for each name and brand, so that a name has several ids."""
    return part.groupBy(F.col("p_name").alias("city"), "p_brand").agg(
        F.min("p_partkey").alias("city_id")
    )


def location_files(supplier: DataFrame, path: str) -> str:
    """Location CSV files, each starting with two lines that are not data."""
    city = F.when(F.col("s_acctbal") < 2000, '""').otherwise(
        F.concat(F.lit('"'), "s_name", F.lit('"'))
    )
    line = F.concat_ws(
        ",",
        F.col("s_suppkey").cast("string"),
        F.concat(F.lit('"C'), "s_nationkey", F.lit('"')),
        F.concat(F.lit('"R'), F.call_function("div", F.col("s_nationkey"), F.lit(5)), F.lit('"')),
        city,
        F.lit('""'),
        F.col("s_acctbal").cast("string"),
        (F.col("s_suppkey") * 0.5).cast("string"),
        F.lit(""),
        F.lit(""),
    )
    header = "Locations\nlocId,country,region,city,postalCode,latitude,longitude,metro,area\n"
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    starts_file = row_in_task == 0
    supplier.select(
        F.when(starts_file, F.concat(F.lit(header), line)).otherwise(line).alias("value")
    ).write.text(path)
    return path


def order_files(orders: DataFrame, path: str, per_file: int) -> str:
    """Order lines in key order, one text file for each run of ``per_file`` keys."""
    lines = orders.select(
        F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority").alias("value"),
        "o_orderkey",
        F.call_function("div", F.col("o_orderkey"), F.lit(per_file)).alias("run"),
    )
    (
        lines.repartition("run")
        .sortWithinPartitions("run", "o_orderkey")
        .select("value", "run")
        .write.partitionBy("run")
        .text(path)
    )
    return path


def sequence_files(df: DataFrame, key: Column, value: Column, path: str) -> str:
    """Two text columns as a SequenceFile."""
    df.select(key.cast("string"), value.cast("string")).rdd.map(tuple).saveAsSequenceFile(path)
    return path


def song_columns(part: DataFrame) -> DataFrame:
    """A catalogue of songs with artists, genre and popularity, from the parts."""
    return part.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("song_name"),
        F.col("p_size").cast("bigint").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.length("p_type").cast("bigint").alias("genre_id"),
        F.floor("p_retailprice").cast("bigint").alias("popularity"),
    )


def database(spark: SparkSession) -> JdbcTarget:
    """The database named by ``spark.tabflow.jdbc.url`` and ``.driver``.

    A local session without that setting uses an embedded in-memory database,
    which only its own process can see; a cluster needs the setting.
    """
    url = spark.conf.get("spark.tabflow.jdbc.url", None)
    if url:
        return JdbcTarget(url, spark.conf.get("spark.tabflow.jdbc.driver"))
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.tabflow.jdbc.url to a database all executors can reach")
    return JdbcTarget(
        "jdbc:derby:memory:tabflow;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    )


def fresh_name(stem: str) -> str:
    """A table name that no earlier run has used."""
    return f"{stem}_{uuid.uuid4().hex[:12]}"



def drop_all(spark: SparkSession, *names: str) -> None:
    """Drop the views and tables that have these names or begin with one and ``_``."""
    for name in names:
        for found in spark.catalog.listTables(pattern=f"{name}*"):
            kind = "VIEW" if found.tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} {found.name}")


def pointer_table(
    spark: SparkSession, target: JdbcTarget, name: str, values: dict[str, str]
) -> None:
    """A pointer table with one more column, which every row must have."""
    columns = ", ".join(f"{target.quoted(c)} VARCHAR(64) NOT NULL" for c in ("property", "value", "note"))
    update_jdbc(spark, target, f"CREATE TABLE {name} ({columns})")
    for prop, value in values.items():
        update_jdbc(spark, target, f"INSERT INTO {name} VALUES (?, ?, 'kept')", [prop, value])
