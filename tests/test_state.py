"""Admission of charges and keyed snapshots, against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import admission, ledger, merge
from weftline.operators.keyed_store import KeyedStore

CHARGES = "event_id long, provider string, ts timestamp, delta int, limit_value long, used_before int"
T0 = dt.datetime(2024, 1, 1)


def charges(n, seed, hot=0.7):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        p = "hot" if rng.random() < hot else rng.choice(["a", "b", "free", None])
        t = None if rng.random() < 0.01 else T0 + dt.timedelta(hours=rng.randint(0, 60))
        rows.append((k, p, t, rng.choice([1, 1, 2, 3, 9, 30, None, -4]), None if p == "free" or rng.random() < 0.3 else rng.randint(100, 130), 7))
    return rows


def brute(rows, margin=1.0):
    limit, used, out = {}, {}, {}
    key = lambda r: (r[1], r[2].strftime("%Y-%m-%d") if r[2] else None)
    order = lambda r: (r[2] is not None, r[2] or T0, r[0], r[3] is not None, r[3] or 0)
    for r in sorted(rows, key=order):
        if r[4] is not None:
            limit[key(r)] = max(1, int(r[4] * margin))
    for r in sorted(rows, key=order):
        u, n, cap = used.get(key(r), 0), max(0, r[3] or 0), limit.get(key(r))
        ok = cap is None or u + n <= cap
        out[r[0]] = (u, None if cap is None else max(0, cap - u), not ok, ok)
        used[key(r)] = u + (n if ok else 0)
    return out


@pytest.mark.parametrize("slot_rows", [1, 7, 10_000])
def test_charges_are_taken_in_order(spark, slot_rows):
    rows = charges(600, 4)
    got = admission.admit(spark.createDataFrame(rows, CHARGES).repartition(5), "daily", 1.0, slot_rows)
    assert got.columns == ["event_id", "provider", "ts", "delta", "limit_value", "window_key", "effective_limit", "used_before", "remaining", "would_exceed", "admitted"]
    found = {r[0]: (r[7], r[8], r[9], r[10]) for r in got.collect()}
    want = brute(rows)
    assert found == want
    refused = [i for i, w in want.items() if not w[3]]
    assert refused and any(want[i][3] for i in range(max(refused[0], 0) + 1, 600))


def test_effect_is_the_loop_from_every_start():
    rng = random.Random(1)
    for _ in range(200):
        limit, deltas = rng.randint(1, 40), [rng.randint(0, 12) for _ in range(rng.randint(0, 25))]
        begin, add = admission.effect(deltas, limit)
        for start in range(limit + 1):
            used = start
            for n in deltas:
                used += n if used + n <= limit else 0
            piece = max(k for k, b in enumerate(begin) if b <= start)
            assert start + add[piece] == used


def test_admission_of_nothing(spark):
    assert admission.admit(spark.createDataFrame([], CHARGES), "monthly").count() == 0


PEOPLE = "domain string, name string, role string, created_at int"


def changes(rng, n, t):
    return [(f"d{rng.randint(0, 12)}", f"n{rng.randint(0, 3)}", f"r{t}-{k}", 100 * t + k, 100 * t + k) for k in range(n)]


def test_snapshots_by_two_keys(spark, tmp_path):
    rng = random.Random(2)
    store = KeyedStore(spark, f"file://{tmp_path}/s", PEOPLE, ["domain", "name"], 8)
    want, states = {}, [{}]
    assert store.rows().count() == 0 and store.latest() == 0
    for t in range(1, 5):
        rows = changes(rng, 12, t)
        for d, n, role, created, _ in rows:
            want[d, n] = (role, want[d, n][1] if (d, n) in want else created)
        states.append(dict(want))
        new = spark.createDataFrame(rows, PEOPLE + ", o int").repartition(3)
        assert store.put(new, "o", txn=f"t{t}") == t
        assert store.put(new, "o", txn=f"t{t}") == t
    for t, state in enumerate(states):
        got = {(r.domain, r["name"]): (r.role, r.created_at) for r in store.rows(t).collect()}
        assert got == state
    again = KeyedStore(spark, f"file://{tmp_path}/s", PEOPLE, ["domain", "name"], 99)
    assert again.n_buckets == 8 and again.latest() == 4
    asked = spark.createDataFrame([("d1", "n1"), ("d2", "n2"), ("zz", "n0"), ("d1", "n1")], "domain string, name string")
    assert {(r.domain, r["name"]) for r in again.get(asked).collect()} == {k for k in [("d1", "n1"), ("d2", "n2")] if k in want}


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = KeyedStore(spark, f"file://{tmp_path}/s", "k string, v string, created_at int", ["k"], 16)
    store.put(spark.createDataFrame([(f"k{i}", "old", 1, 1) for i in range(200)], "k string, v string, created_at int, o int"), "o")
    before = store._paths(1)
    store.put(spark.createDataFrame([("k7", "new", 2, 2)], "k string, v string, created_at int, o int"), "o")
    after = store._paths(2)
    assert sum(before[b] != after[b] for b in after) == 1 and len(after) == 16
    got = {r.k: (r.v, r.created_at) for r in store.rows().collect()}
    assert len(got) == 200 and got["k7"] == ("new", 1) and got["k8"] == ("old", 1)
    assert {r.k: r.v for r in store.rows(1).collect()}["k7"] == "old"


def test_a_failed_change_leaves_no_trace(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, f"file://{tmp_path}/s", "k string, v string, created_at int", ["k"], 4)
    row = lambda v, t: spark.createDataFrame([("a", v, t, t)], "k string, v string, created_at int, o int")
    store.put(row("one", 1), "o", txn="a")
    broken = row("two", 2).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.put(broken, "o", txn="b")
    assert store.latest() == 1 and store.rows().first().v == "one"
    assert store.put(row("two", 2), "o", txn="b") == 2 and store.rows().first().v == "two"
    assert store.put(row("two", 2).limit(0), "o", txn="c") == 3 and store.rows().count() == 1


def test_upsert_by_several_columns_and_ties(spark):
    old = spark.createDataFrame([("a", "x", 1, "p")], "d string, n string, created_at int, v string")
    new = spark.createDataFrame([("a", "x", 5, "q", 1), ("a", "x", 6, "r", 1), ("a", "y", 7, "s", 2), ("a", "y", 8, "t", 3)], "d string, n string, created_at int, v string, o int")
    got = sorted(map(tuple, merge.upsert(old, new, ["d", "n"], "o").collect()))
    assert got == [("a", "x", 1, "r"), ("a", "y", 7, "t")]


def test_limits_of_the_ledger_hold_for_admission(spark):
    df = spark.createDataFrame([(1, "p", T0, 79, 100, 0), (2, "p", T0, 2, None, 0), (3, "p", T0, 1, None, 0)], CHARGES)
    assert [r.admitted for r in admission.admit(df, "daily").orderBy("event_id").select("admitted").collect()] == [True, False, True]
    assert ledger.usage(df, "daily").first().used == 82


def test_slots_without_a_limit_are_one_piece():
    """What a slot does is worked out in one pass where nothing is refused; before, each charge made a piece more."""
    from weftline.operators.admission import UNCAPPED, effect

    assert effect([3, 0, -1, 4], UNCAPPED) == ([0], [7])
    assert effect([3] * 5000, UNCAPPED) == ([0], [15000])
