"""The log of calls as one text for each user."""

import datetime as dt

from weftline.plans.catalogue import QUERIES


def test_a_log_is_whole(spark, tmp_path):
    """More lines than a part holds are one user's one row; a user without event types has a row and no log."""
    n = 25_000
    at = dt.datetime(2024, 1, 1)
    rows = [(k, at + dt.timedelta(seconds=n - k), 1, f"e{k}") for k in range(n)] + [(n, at, 2, None), (n + 1, at, 3, "b"), (n + 2, at, 3, None), (n + 3, at, 3, "c")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.user_id: r.log for r in QUERIES["call_note_log"](spark, str(tmp_path)).collect()}
    assert got == {1: "\n".join(f"e{k}" for k in reversed(range(n))), 2: None, 3: "b\nc"}
