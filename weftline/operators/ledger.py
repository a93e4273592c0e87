"""Usage ledgers: windows, limits, budgets and pacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.dates import window_key
from weftline.operators.order import running_within

MARGIN = 0.8


def usage(charges: DataFrame, reset: str) -> DataFrame:
    """(provider, window_key, used, limit_value): sums, and the latest limit that isn't null."""
    key = window_key(F.col("ts"), reset).alias("window_key")
    known = F.col("limit_value").isNotNull()
    return charges.groupBy("provider", key).agg(F.sum("delta").alias("used"), F.max_by(F.when(known, F.col("limit_value")), F.when(known, F.struct("ts", "event_id"))).alias("limit_value"))


def effective_limit(limit: Column, margin: float = MARGIN) -> Column:
    return F.when(limit.isNotNull(), F.greatest(F.lit(1), F.floor(limit * margin)).cast("long"))


def fair_share(budget: Column, used: Column, day: Column) -> Column:
    """What a day may spend of a month's budget: what is left over the days left, rounded up."""
    left = F.day(F.last_day(day)) - F.day(day) + 1
    return F.ceil(F.greatest(F.lit(0), budget - used) / left).cast("long")


def budget_prefix(rows: DataFrame, group: str, order: str, cost: str, budget: int) -> DataFrame:
    """The rows of each group, in order, before the one that would take the running cost over the budget; costs aren't negative. A group may hold any part of the rows."""
    return running_within(rows, group, [F.col(order)], cost, "spent").where(F.col("spent") <= budget)


#: Widths of a sliding window in one slot of time.
SLOT_WIDTHS = 16


def slotted(rows: DataFrame, micros: Column, width: int) -> DataFrame:
    """rows with t (micros), own (their slot of time) and slot: those in the last window's width of a slot are in the next one too."""
    span = SLOT_WIDTHS * width
    into = F.pmod(F.col("t"), F.lit(span))
    own = F.col("t") - into
    slots = F.when(into >= span - width, F.array(own, own + span)).otherwise(F.array(own))
    return rows.withColumn("t", micros).withColumn("own", own).withColumn("slot", F.explode(slots))


def sliding_count(rows: DataFrame, key: str, ts: str, seconds: int) -> DataFrame:
    """rows with in_window: how many rows of the key lie in the seconds up to and including each.

    A key's rows are split into slots of time, so that a key may hold any part
    of them; rows in the last window's width of a slot count in the next one too.
    """
    width = seconds * 1_000_000
    placed = slotted(rows, F.unix_micros(F.col(ts).cast("timestamp")), width)
    w = Window.partitionBy(key, "slot").orderBy("t").rangeBetween(-width + 1, 0)
    return placed.withColumn("in_window", F.count("*").over(w)).where(F.col("slot").eqNullSafe(F.col("own"))).drop("t", "own", "slot")
