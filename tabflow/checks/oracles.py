"""SQL that gives the expected rows of each registered query on the same tables."""

from __future__ import annotations

from tabflow.checks.queries import LOAD_TIME, ORDERS_PER_FILE, SECOND_PUBLISH, USERS_PER_BATCH

_KEPT_LISTS = "l_discount <> 0.1 AND l_tax <> 0.08 AND l_linenumber <> 7"
_KEPT_PAIRS = "l_linenumber <> 7 AND l_discount <> 0.1 AND l_tax <> 0.08"
_KEPT_USERS = "c_nationkey NOT IN (3, 5, 7)"

_UNIQUES = """
SELECT l_partkey AS id,
       count(DISTINCT l_suppkey) + count(DISTINCT l_orderkey)
         + max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS uniq
FROM lineitem
WHERE {where}
GROUP BY l_partkey
"""

_WORDS = """
SELECT word, count(*) AS n
FROM (
  SELECT unnest(CASE
    WHEN {text} = '' THEN ['']
    WHEN rtrim({text}, ' ') = '' THEN []
    ELSE string_split(rtrim({text}, ' '), ' ')
  END) AS word
  FROM {table}
)
GROUP BY word
"""

_PAIRS = f"SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE {_KEPT_PAIRS}"

_EDGES = f"""
SELECT DISTINCT src || ':' || dst AS edge, src, dst, 'KNOWS' AS rel_type, 'follows' AS name
FROM ({_PAIRS})
"""

_NODES = f"SELECT src AS userid FROM ({_PAIRS}) UNION SELECT dst FROM ({_PAIRS})"

_SONGS = """
SELECT p_partkey AS song_id, p_name AS song_name, CAST(p_size AS BIGINT) AS artist_id,
       p_brand AS artist_name, CAST(length(p_type) AS BIGINT) AS genre_id,
       CAST(floor(p_retailprice) AS BIGINT) AS popularity
FROM part
"""

_LOCATIONS = f"""
WITH cities AS (
  SELECT min(p_partkey) AS city_id, p_name AS city FROM part GROUP BY p_name, p_brand
)
SELECT DISTINCT city_id, p_brand AS region, p_type AS country,
       CAST(p_size AS DOUBLE) AS latitude, p_retailprice AS longitude,
       '{LOAD_TIME}' AS ts_added
FROM part JOIN cities ON p_name = city
"""

_LIVE = f"""
'Table' || ((epoch_ms(TIMESTAMP '{SECOND_PUBLISH}') // 604800000 + 1) % 2 + 1) AS live_copy
"""

ORACLES: dict[str, str] = {
    "explode_unique": _UNIQUES.format(where=_KEPT_LISTS),
    "partition_range_scan": _UNIQUES.format(
        where=_KEPT_LISTS
        + " AND l_linestatus = 'O' AND year(l_shipdate) BETWEEN 1996 AND 1999"
        + " AND date_trunc('quarter', l_shipdate)"
        + " BETWEEN TIMESTAMP '1996-04-01' AND TIMESTAMP '1999-07-01'"
    ),
    "record_counts": f"""
SELECT count(*) AS lines,
       count(*) FILTER (l_discount = 0.1 OR l_tax = 0.08) AS marker_lines,
       count(*) FILTER (NOT (l_discount = 0.1 OR l_tax = 0.08) AND l_linenumber = 7)
         AS no_list_lines,
       count(*) FILTER ({_KEPT_LISTS}) AS kept_lines,
       count(DISTINCT CASE WHEN {_KEPT_LISTS} THEN l_partkey END) AS kept_ids
FROM lineitem
""",
    "word_count": _WORDS.format(text="text", table="documents"),
    "seqfile_word_count": _WORDS.format(text="text", table="conversations"),
    "seqfile_to_text": "SELECT c_name AS line FROM customer",
    "line_copy_offset": f"""
SELECT CAST(sum(strlen(line) + 1) OVER (PARTITION BY k // {ORDERS_PER_FILE} ORDER BY k)
         - strlen(line) - 1 AS BIGINT) AS byte_offset, line
FROM (
  SELECT o_orderkey AS k, o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS line
  FROM orders
)
""",
    "edge_list": _PAIRS,
    "follow_nodes": _NODES,
    "follow_edges": _EDGES,
    "graph_upsert": f"""
SELECT row_number() OVER (ORDER BY load, src, dst) - 1 AS rel_id,
       src || ':' || dst AS edge, src, dst, 'KNOWS' AS rel_type, 'follows' AS name
FROM (
  SELECT l_partkey AS src, l_suppkey AS dst,
         min(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END) AS load
  FROM lineitem WHERE {_KEPT_PAIRS}
  GROUP BY l_partkey, l_suppkey
)
""",
    "edge_dump": f"""
WITH nodes AS (
  SELECT userid, row_number() OVER (ORDER BY userid) - 1 AS node_id FROM ({_NODES})
), edges AS (
  SELECT src, dst, name, row_number() OVER (ORDER BY src, dst) - 1 AS rel_id FROM ({_EDGES})
)
SELECT rel_id, s.node_id AS start_id, src AS start_userid, name,
       e.node_id AS end_id, dst AS end_userid
FROM edges JOIN nodes s ON s.userid = src JOIN nodes e ON e.userid = dst
""",
    "incident_edges": f"""
WITH edges AS ({_EDGES})
SELECT src AS userid, edge, src, dst, rel_type, name FROM edges
UNION ALL
SELECT dst AS userid, edge, src, dst, rel_type, name FROM edges WHERE src <> dst
""",
    "user_records": f"""
SELECT c_custkey AS userid, c_name AS username,
       CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS fname,
       CAST(NULL AS VARCHAR) AS lname, CAST(NULL AS VARCHAR) AS mname,
       c_custkey || '@example.com' AS email,
       n_name AS city, 'S' || n_regionkey AS state, r_name AS country,
       CAST(c_custkey + 10000 AS VARCHAR) AS zip
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE {_KEPT_USERS}
""",
    "user_batches": f"""
SELECT c_custkey AS userid, c_name AS username,
       CAST(row_number() OVER (ORDER BY c_custkey) // {USERS_PER_BATCH} AS BIGINT) AS batch
FROM customer WHERE {_KEPT_USERS}
""",
    "user_send": f"""
SELECT c_custkey AS userid, c_name AS username, c_custkey || '@example.com' AS email,
       n_name AS city,
       CAST(row_number() OVER (ORDER BY c_custkey) // {USERS_PER_BATCH} AS BIGINT) AS batch
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE {_KEPT_USERS}
""",
    "city_locations": _LOCATIONS,
    "city_locations_collated": _LOCATIONS,
    "city_locations_salted": _LOCATIONS,
    "city_load": _LOCATIONS,
    "feed_by_country": """
SELECT p_type AS country,
       p_partkey || chr(9) || p_name || chr(9) || p_name || chr(9) || chr(9) || p_size
         || chr(9) || p_retailprice || chr(9) || chr(9) || chr(9) || p_type
         || chr(9) || chr(9) || p_brand AS line
FROM part
""",
    "country_region": """
SELECT 'C' || s_nationkey AS country, 'R' || (s_nationkey // 5) AS region,
       s_acctbal AS latitude, s_suppkey * 0.5::DOUBLE AS longitude
FROM supplier WHERE s_acctbal < 2000
""",
    "tsv_roundtrip": """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority,
       o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
       CASE o_orderstatus WHEN 'F' THEN '\\N'
         WHEN 'O' THEN o_orderpriority || chr(9) || chr(10) || '\\t' END AS note
FROM orders
""",
    "partition_overwrite": f"""
SELECT * REPLACE (popularity + 1 AS popularity), '2013-06-01' AS test_part FROM ({_SONGS})
UNION ALL
SELECT *, '2013-06-02' AS test_part FROM ({_SONGS})
""",
    "jdbc_export": f"SELECT *, '2013-06-01' AS test_part FROM ({_SONGS})",
    "jdbc_load": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "ab_publish": f"SELECT *, {_LIVE} FROM ({_SONGS})",
    "jdbc_publish": f"""
SELECT c_custkey, c_name, c_acctbal, {_LIVE}, 'kept' AS note, 'Table1' AS other FROM customer
""",
    "week_suffix": """
SELECT event_id, 'Table' || ((epoch_ms(ts) // 604800000 + 1) % 2 + 1) AS suffix FROM events
""",
}
