"""Numbered batches: staged once, delivered once each, also after failures."""

import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabflow.plans import graphs
from tabflow.sinks import record_batches as R
from tests.helpers import rows


def note(target, number, records):
    """A sender that also counts its calls, and fails for a batch while a file says so."""
    folder = Path(target)
    fail = folder / "fail"
    if fail.exists() and int(fail.read_text()) == number:
        raise OSError("the store is down")
    R.save_as_json(f"{target}/sent", number, records)
    with open(folder / "calls", "a") as out:
        out.write(f"{number}\n")


@pytest.fixture
def users(spark):
    """25 records in three batches, dealt over several partitions."""
    return spark.range(25).select(
        F.col("id").alias("userid"),
        F.struct(F.lit("x").alias("city"), F.col("id").alias("zip")).alias("location"),
        F.floor(F.col("id") / 10).alias("batch"),
    ).repartition(4)


@pytest.fixture
def folders(tmp_path):
    target = tmp_path / "target"
    target.mkdir()
    return str(tmp_path / "outbox"), str(target)


def sent(target):
    files = sorted(Path(target, "sent").glob("*.json"))
    return {int(f.stem): [json.loads(line) for line in f.read_text().splitlines()] for f in files}


def calls(target):
    return sorted(map(int, Path(target, "calls").read_text().split()))


def test_batches_are_staged_and_read_back(spark, users, folders):
    outbox, _ = folders
    assert not R.is_staged(spark, outbox)
    assert R.stage_batches(users, outbox)
    back = R.read_batches(spark, outbox, users.schema)
    assert rows(back) == rows(users)
    assert back.rdd.getNumPartitions() == 3
    assert rows(back.select("batch", "userid").where("batch = 2")) == [(2, i) for i in range(20, 25)]


def test_an_outbox_is_written_once(spark, users, folders):
    outbox, _ = folders
    R.stage_batches(users, outbox)
    assert not R.stage_batches(users.where("batch = 0"), outbox)
    assert R.read_batches(spark, outbox, users.schema).count() == 25


def test_what_a_lost_attempt_staged_is_not_read(spark, users, folders):
    outbox, _ = folders
    broken = F.when(
        (F.col("batch") == 2) & (F.col("userid") == 24), F.raise_error(F.lit("lost"))
    ).otherwise(F.col("userid"))
    with pytest.raises(PySparkException):
        R.stage_batches(users.withColumn("userid", broken.cast("bigint")), outbox)
    assert not R.is_staged(spark, outbox)
    Path(outbox, "batches").mkdir(parents=True, exist_ok=True)
    Path(outbox, "batches", "0-lost.parquet").write_bytes(b"half a file")
    assert R.stage_batches(users, outbox)
    assert rows(R.read_batches(spark, outbox, users.schema)) == rows(users)


def test_rows_of_a_batch_must_come_from_one_task(users, folders):
    writer = R.OutboxWriter(folders[0])
    messages = [R.Staged([("a", 1, 2)]), R.Staged([("b", 1, 3)])]
    with pytest.raises(RuntimeError, match="several tasks"):
        writer.commit(messages)


def test_every_batch_is_delivered_once(spark, users, folders):
    outbox, target = folders
    R.stage_batches(users, outbox)
    sender = "tests.test_outbox:note"
    assert R.deliver(spark, outbox, sender, target) == {"batches": 3, "records": 25}
    assert R.deliver(spark, outbox, sender, target) == {"batches": 0, "records": 0}
    assert calls(target) == [0, 1, 2]
    assert rows(R.delivered(spark, outbox)) == [(0, 10), (1, 10), (2, 5)]
    found = sent(target)
    assert [r["userid"] for n in sorted(found) for r in sorted(found[n], key=lambda r: r["userid"])] == list(range(25))
    assert found[2][0]["location"]["city"] == "x"


def test_a_failed_delivery_goes_on_where_it_stopped(spark, users, folders):
    outbox, target = folders
    R.stage_batches(users, outbox)
    Path(target, "fail").write_text("1")
    sender = "tests.test_outbox:note"
    with pytest.raises(PySparkException, match="the store is down"):
        R.deliver(spark, outbox, sender, target, senders=1)
    before = calls(target)
    assert 1 not in before
    Path(target, "fail").unlink()
    found = R.deliver(spark, outbox, sender, target, senders=1)
    assert found["batches"] == 3 - len(before)
    assert calls(target) == [0, 1, 2]


def test_a_batch_without_its_entry_is_sent_again_under_its_number(spark, users, folders):
    outbox, target = folders
    R.stage_batches(users, outbox)
    R.deliver(spark, outbox, "tests.test_outbox:note", target, senders=1)
    Path(outbox, "ledger", "1.parquet").unlink()  # sent, but lost before its entry
    assert R.deliver(spark, outbox, "tests.test_outbox:note", target) == {"batches": 1, "records": 10}
    assert calls(target) == [0, 1, 1, 2] and sorted(sent(target)) == [0, 1, 2]


def test_an_empty_load(spark, users, folders):
    outbox, target = folders
    R.stage_batches(users.limit(0), outbox)
    assert R.is_staged(spark, outbox)
    assert R.read_batches(spark, outbox, users.schema).collect() == []
    assert R.deliver(spark, outbox, "tests.test_outbox:note", target) == {"batches": 0, "records": 0}


def test_the_users_job_can_be_run_again(spark, tmp_path, folders):
    outbox, target = folders
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f").write_text("".join(f"{i}\tname{i}\n" for i in range(12)) + "NULL\tx\n")
    job = (spark, str(tmp_path / "in"), "tests.test_outbox:note")
    Path(target, "fail").write_text("2")
    with pytest.raises(PySparkException):
        graphs.load_users(*job, size=5, outbox=outbox, target=target)
    Path(target, "fail").unlink()
    done = calls(target)
    (tmp_path / "in" / "late").write_text("99\tlate\n")  # belongs to the next load
    found = graphs.load_users(*job, size=5, outbox=outbox, target=target)
    assert found["batches"] == 3 - len(done) and "lines" not in found
    assert calls(target) == [0, 1, 2]
    # counting from one, row n is in batch n div 5
    assert {n: sorted(r["userid"] for r in b) for n, b in sent(target).items()} == {
        0: [0, 1, 2, 3], 1: [4, 5, 6, 7, 8], 2: [9, 10, 11]
    }
