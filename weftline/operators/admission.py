"""Admission of charges: each is taken or refused by what its window has used, in order, and a refused one uses nothing.

Whether a charge is taken depends on all before it, and not by a running sum: a
large one may be refused and a smaller one after it taken. So a window's charges
are parted by their place into slots of bounded size. What a slot does to the
amount used is a function with few pieces, each adding a constant; every slot
works that out by itself, for all amounts at once. The functions of a window's
slots are then chained, a row for each slot, and every slot runs over its own
charges once more from the amount it begins with. A provider may hold any part
of the charges; no task holds more than a slot of them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.dates import window_key
from weftline.operators.ledger import MARGIN, effective_limit, usage
from weftline.operators.order import numbered_within
from weftline.scratch import materialize

#: Charges of one slot.
SLOT_ROWS = 10_000
#: Columns that admission gives, in place of the charges' own of these names.
ADDED = ("window_key", "effective_limit", "used_before", "remaining", "would_exceed", "admitted")
#: Stands for no limit.
UNCAPPED = 1 << 62


def effect(deltas: list[int], limit: int) -> tuple[list[int], list[int]]:
    """What charges in order do to an amount used from 0 to limit: pieces by where each begins, and what each adds."""
    if limit >= UNCAPPED:  # nothing is refused, from whatever amount
        return [0], [sum(n for n in deltas if n > 0)]
    pieces = [(0, limit, 0)]
    for n in deltas:
        if n <= 0:
            continue
        out: list[tuple[int, int, int]] = []
        for low, high, add in pieces:
            edge = limit - n - add  # amounts up to this are charged
            for a, b, c in ((low, min(high, edge), add + n), (max(low, edge + 1), high, add)):
                if a > b:
                    continue
                if out and out[-1][2] == c and out[-1][1] == a - 1:
                    out[-1] = (out[-1][0], b, c)
                else:
                    out.append((a, b, c))
        pieces = out
    return [p[0] for p in pieces], [p[2] for p in pieces]


def admit(charges: DataFrame, reset: str, margin: float = MARGIN, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """charges (provider, ts, event_id, delta, limit_value and others) with window_key, effective_limit, used_before, remaining, would_exceed and admitted.

    The limit of a window is its latest that isn't null, times the margin, as in
    :func:`weftline.operators.ledger.usage`; without one every charge is taken
    and remaining is null. Order is by ts, event_id and delta; a null or negative
    delta uses nothing. Charges without a time are a window of their own.
    """
    charges = charges.drop(*ADDED)
    limits = usage(charges, reset).select("provider", "window_key", effective_limit(F.col("limit_value"), margin).alias("effective_limit"))
    keyed = charges.withColumn("window_key", window_key(F.col("ts"), reset)).withColumn("window", F.struct("provider", "window_key"))
    placed = numbered_within(keyed, "window", [F.col("ts"), F.col("event_id"), F.col("delta")], "place")
    units = F.greatest(F.coalesce(F.col("delta").cast("long"), F.lit(0)), F.lit(0).cast("long"))
    same = lambda a, b: F.col(f"{a}.provider").eqNullSafe(F.col(f"{b}.provider")) & F.col(f"{a}.window_key").eqNullSafe(F.col(f"{b}.window_key"))
    capped = placed.alias("c").join(limits.alias("l"), same("c", "l"), "left").select("c.*", "l.effective_limit")
    kept = materialize(capped.withColumn("slot", F.floor((F.col("place") - 1) / slot_rows)).withColumn("units", units), "charges")

    cap = lambda limit: UNCAPPED if limit is None or pd.isna(limit) else int(limit)

    def of_slot(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        begin, add = effect(rows.sort_values("place")["units"].tolist(), cap(rows["effective_limit"].iloc[0]))
        return pd.DataFrame({"provider": [key[0]], "window_key": [key[1]], "slot": [key[2]], "begin": [begin], "adds": [add]})

    def chain(key: tuple, slots: pd.DataFrame) -> pd.DataFrame:
        import bisect

        used, at = 0, []
        slots = slots.sort_values("slot")
        for begin, add in zip(slots["begin"], slots["adds"]):
            at.append(used)
            used += int(add[bisect.bisect_right(list(begin), used) - 1])
        return pd.DataFrame({"provider": key[0], "window_key": key[1], "slot": slots["slot"], "used": at})

    def replay(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        limit, used = cap(rows["effective_limit"].iloc[0]), int(rows["used"].iloc[0])
        before, taken = [], []
        for n in rows["units"].tolist():
            before.append(used)
            taken.append(used + n <= limit)
            used += n if taken[-1] else 0
        return pd.DataFrame({"provider": rows["provider"], "window_key": rows["window_key"], "place": rows["place"], "used_before": before, "admitted": taken})

    narrow = kept.select("provider", "window_key", "slot", "place", "units", "effective_limit")
    effects = narrow.groupBy("provider", "window_key", "slot").applyInPandas(of_slot, "provider string, window_key string, slot long, begin array<long>, adds array<long>")
    starts = materialize(effects.groupBy("provider", "window_key").applyInPandas(chain, "provider string, window_key string, slot long, used long"), "charge-slots")
    started = narrow.alias("n").join(starts.alias("s"), same("n", "s") & (F.col("n.slot") == F.col("s.slot"))).select("n.*", "s.used")
    done = started.groupBy("provider", "window_key", "slot").applyInPandas(replay, "provider string, window_key string, place long, used_before long, admitted boolean")
    out = kept.alias("k").join(done.alias("d"), same("k", "d") & (F.col("k.place") == F.col("d.place"))).select("k.*", "d.used_before", "d.admitted")
    left = F.when(F.col("effective_limit").isNotNull(), F.greatest(F.lit(0).cast("long"), F.col("effective_limit") - F.col("used_before")))
    return out.select(
        *charges.columns, "window_key", "effective_limit", "used_before", left.alias("remaining"), F.coalesce(F.col("units") > left, F.lit(False)).alias("would_exceed"), "admitted",
    )
