import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from tabflow.operators.clean import edge_list, user_records
from tests.helpers import drop_trailing, rows, trim


def brute_edges(values):
    found = []
    for value in values:
        fields = drop_trailing(value, "\t")
        if len(fields) <= 1:
            continue
        ends = [trim(f) for f in fields[:2]]
        if any(e == "" or "NULL" in e or "\\N" in e for e in ends):
            continue
        found.append((int(ends[0]), int(ends[1])))
    return sorted(found, key=repr)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=st.data())
def test_edges_match_plain_python(lines, data):
    field = st.sampled_from(["1", " 22 ", "-3", "", "  ", "NULL", "\\N", "aNULL", "\r7\r"])
    values = data.draw(st.lists(st.lists(field, max_size=4), min_size=30))
    texts = ["\t".join(v) for v in values]
    assert rows(edge_list(lines(*texts))) == brute_edges(texts)


def test_edges_keep_duplicates_and_ignore_further_columns(lines):
    df = lines("1\t2", "1\t2\textra\tmore", "2\t1")
    assert rows(edge_list(df)) == [(1, 2), (1, 2), (2, 1)]


def test_bad_edge_end_fails(lines):
    for bad in ("x\t1", "1\ty", "1 2\t3"):
        with pytest.raises(PySparkException, match="not a 64-bit integer"):
            edge_list(lines("1\t2", bad)).collect()


def profile(userid, *rest):
    return "\t".join([userid, *rest])


def test_user_record_positions(lines):
    line = profile("7", "nick", "unused", "f", "l", "m", "city", "st", "co", "zip", "e@x", "more")
    record = user_records(lines(line)).first().asDict(recursive=True)
    assert record == {
        "userid": 7,
        "username": "nick",
        "fname": "f",
        "lname": "l",
        "mname": "m",
        "email": "e@x",
        "location": {"city": "city", "state": "st", "country": "co", "zip": "zip"},
    }


def test_user_properties_are_trimmed_and_markers_are_exact(lines):
    df = user_records(lines("1\t nick \t\tNULL\t \t\\N\tNULLville\t\\N "))
    record = df.first()
    assert (record["username"], record["fname"], record["lname"], record["mname"]) == (
        "nick",
        None,
        None,
        None,
    )
    assert record["location"].asDict() == {
        "city": "NULLville",
        "state": None,
        "country": None,
        "zip": None,
    }


def test_only_the_bad_user_line_is_dropped(lines):
    df = lines("1\ta", "\t\t\t", "", "NULL\tb", "\\N\tb", "x2\tb", "-1\tb", " 3 \tc", "1.5\td")
    assert [r["userid"] for r in user_records(df).collect()] == [1, 3]


def test_cleaning_takes_a_line_apart_once(lines, plan):
    for df in (edge_list(lines("1\t2")), user_records(lines("1\ta"))):
        text = plan(df.where(df.columns[0] + " > 0"))
        assert text.count("split(") == 1
        assert "Python" not in text
