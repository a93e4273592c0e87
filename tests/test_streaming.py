"""Runs that carry state over calls, and keyed state with timers, against the same work done at once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import ledger
from weftline.streaming import quota, window
from weftline.streaming.runs import NamedRun

START = dt.datetime(2024, 1, 1)
EVENTS = "event_id long, provider string, ts timestamp, delta long"


def events(n, seed=1):
    rng = random.Random(seed)
    return [(k, "hot" if k % 5 else "cold", START + dt.timedelta(minutes=7 * k + rng.randint(0, 5)), rng.randint(1, 4)) for k in range(n)]


def put(spark, rows, folder, name, schema=EVENTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder, schema=EVENTS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{folder}/*")


def used(rows):
    out = {}
    for _, provider, ts, delta in rows:
        key = provider, ts.strftime("%Y-%m-%d")
        out[key] = out.get(key, 0) + delta
    return out


def quota_run(spark, root, inbox, save=None):
    charges = quota.daily_quota(stream(spark, inbox), "40 days")
    run = NamedRun(spark, "quota", f"file://{root}")
    run.advance(charges, "update", save)
    return {(r.provider, r.day): r.used for r in run.latest(charges.schema, ["provider", "day"]).collect()}


def test_two_calls_equal_one(spark, tmp_path):
    rows = events(400)
    put(spark, rows[:150], tmp_path / "in", "a")
    assert quota_run(spark, tmp_path / "state", tmp_path / "in") == used(rows[:150])
    assert quota_run(spark, tmp_path / "state", tmp_path / "in") == used(rows[:150])
    put(spark, rows[150:300], tmp_path / "in", "b")
    put(spark, rows[300:], tmp_path / "in", "c")
    assert quota_run(spark, tmp_path / "state", tmp_path / "in") == used(rows)
    assert quota_run(spark, tmp_path / "once", tmp_path / "in") == used(rows)


@pytest.mark.parametrize("when", ["before", "between", "after"])
def test_a_crash_in_a_batch_neither_loses_nor_repeats_rows(spark, tmp_path, when):
    """The call ends before a batch's rows are written, between rows and commit, or after the commit but before Spark notes it."""
    rows = events(300)
    put(spark, rows[:150], tmp_path / "in", "a")
    root, inbox = f"file://{tmp_path}/state", tmp_path / "in"
    NamedRun(spark, "copy", root).advance(stream(spark, inbox))
    put(spark, rows[150:], tmp_path / "in", "b")
    run = NamedRun(spark, "copy", root)

    def crash(batch, n):
        if when == "between":
            batch.write.parquet(f"{run.home}/rows/{n}-0123abcd")
        if when == "after":
            run._save(batch, n)
        raise RuntimeError("the driver is gone")

    with pytest.raises(Exception, match="the driver is gone"):
        run.advance(stream(spark, inbox), save=crash)
    again = NamedRun(spark, "copy", root).advance(stream(spark, inbox))
    got = again.rows(EVENTS)
    assert sorted(r.event_id for r in got.collect()) == list(range(300))
    assert {r.batch for r in got.select("batch").distinct().collect()} == {0, 1}


def test_rows_of_a_run_that_has_none(spark, tmp_path):
    run = NamedRun(spark, "none", f"file://{tmp_path}")
    assert run.rows(EVENTS).count() == 0 and run.commits().count() == 0


def test_stream_counts_as_the_table_does_in_any_order(spark, tmp_path):
    """Events out of order within the watermark, equal times, a hot key, slots' edges; a last event far ahead closes the stream."""
    rng = random.Random(3)
    times = [START + dt.timedelta(seconds=160 * k + e) for k in range(5) for e in (-1, 0, 9, 10, 150, 159)] + [START + dt.timedelta(seconds=rng.randint(0, 900), microseconds=rng.choice([0, 1, 999_999])) for _ in range(150)]
    rows = [(k, "hot" if k % 7 else "cold", t, 1) for k, t in enumerate(times)]
    table = spark.createDataFrame(rows, EVENTS)
    want = {r.event_id: r.in_window for r in ledger.sliding_count(table, "provider", "ts", 10).collect()}
    arrival = sorted(rows, key=lambda r: (r[2] + dt.timedelta(seconds=rng.randint(0, 200))))
    for k in range(4):
        put(spark, arrival[k * 45 : (k + 1) * 45], tmp_path / "in", f"f{k}")
    put(spark, [(None, "close", START + dt.timedelta(days=30), 1)], tmp_path / "in", "z")
    counted = window.sliding_count(stream(spark, tmp_path / "in"), "provider", "ts", "event_id", 10, "10 minutes")
    with window.store(spark):
        got = NamedRun(spark, "window", f"file://{tmp_path}").advance(counted).rows(counted.schema).collect()
    assert len(got) == len(want) and {r.id: r.in_window for r in got} == want
