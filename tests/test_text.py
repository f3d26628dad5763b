from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabflow.functions import text as T
from tabflow.functions.weeks import standby_suffix, standby_suffix_at
from tests.helpers import drop_trailing, trim

few = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("sep", [",", " ", "|"])
@few
@given(data=st.data())
def test_items_match_plain_python(spark, sep, data):
    texts = data.draw(st.lists(st.text(alphabet=f"ab{sep}\n", max_size=8), min_size=20))
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    df = df.withColumn("body", T.without_trailing(F.col("v"), sep))
    found = one(df, F.coalesce(T.items(F.col("v"), F.col("body"), sep), F.array()))
    assert found == [drop_trailing(t, sep) for t in texts]


def test_separator_must_be_one_character():
    with pytest.raises(ValueError):
        T.items(F.lit("a"), F.lit("a"), "::")


def test_leading_fields(spark, lines):
    df = lines("a\tb\tc\td", "a", "", "\t\t")
    fields = T.leading_fields(F.col("value"), 2)
    assert one(df, F.get(fields, F.lit(0))) == ["a", "a", "", ""]
    assert one(df, F.get(fields, F.lit(1))) == ["b", None, None, ""]


@few
@given(texts=st.lists(st.text(alphabet="a \t\r\n\x00\x1f\x7f\xa0", max_size=6), min_size=20))
def test_trim_strips_controls_and_spaces_only(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert one(df, T.trim_blanks(F.col("v"))) == [trim(t) for t in texts]


def test_marker_rules_differ(lines):
    df = lines("NULL", "xNULLx", "\\N", "a\\N", "null", "", "N")
    assert one(df, T.has_null_marker(F.col("value"))) == [True] * 4 + [False] * 3
    assert one(df, T.present(F.col("value"))) == [
        None,
        "xNULLx",
        None,
        "a\\N",
        "null",
        None,
        "N",
    ]


LONGS = {
    "12": 12,
    "+5": 5,
    "-7": -7,
    "007": 7,
    "9223372036854775807": 9223372036854775807,
    "9223372036854775808": None,
    " 12": None,
    "12\n": None,
    "1.5": None,
    "": None,
    "+": None,
    "x1": None,
}


def test_soft_long(lines):
    assert one(lines(*LONGS), T.soft_long(F.col("value"))) == list(LONGS.values())


@pytest.mark.parametrize("text", [t for t, v in LONGS.items() if v is None])
def test_strict_long_fails(lines, text):
    with pytest.raises(PySparkException, match="not a 64-bit integer"):
        lines("1", text).select(T.strict_long(F.col("value"))).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_long_does_not_depend_on_ansi(lines, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    good = lines("1", None, "-2")
    assert one(good, T.strict_long(F.col("value"))) == [1, None, -2]
    with pytest.raises(PySparkException, match="not a 64-bit integer"):
        lines("x").select(T.strict_long(F.col("value"))).collect()


def test_kept_is_where_then_select(spark):
    df = spark.range(10)
    found = df.select(T.kept(F.col("id") % 3 == 0, F.col("id"), (F.col("id") * 2).alias("two")))
    assert found.columns == ["id", "two"]
    assert [tuple(r) for r in found.collect()] == [(i, 2 * i) for i in range(0, 10, 3)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_suffix_follows_utc_weeks_in_any_session(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    times = [
        datetime(1970, 1, 1),
        datetime(1970, 1, 7, 23, 59, 59, 999999),
        datetime(1970, 1, 8),
        datetime(2013, 6, 5, 23, 59, 59),
        datetime(2013, 6, 6),
        datetime(2024, 2, 29, 12),
    ]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    week_ms = 7 * 24 * 3600 * 1000
    expected = []
    for t in times:
        ms = int((t - datetime(1970, 1, 1)).total_seconds() * 1000)
        expected.append(f"Table{(ms // week_ms + 1) % 2 + 1}")
    assert one(df, standby_suffix(F.col("ts"))) == expected
    assert [standby_suffix_at(t) for t in times] == expected
