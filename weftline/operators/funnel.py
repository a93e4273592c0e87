"""Funnel reporting: one fact of stage entries, every figure an aggregate over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.dates import local_day


# Labels that stages had, and what they are called now.
ALIASES = {"Call Attempted": "No Pickup", "Call Attempted (retired)": "No Pickup", "Dead/Gmeet/Privacy Concerns": "Dead/GMeet/Privacy Concerns"}


def current_label(label: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv]), label), label)


def metric_events(history: DataFrame, stage_dim: DataFrame, metric_dim: DataFrame) -> DataFrame:
    """Distinct (deal_id, metric, day, actor) of stage entries made by people; a win counts whoever recorded it.

    Both dimensions are small tables of configuration; the history is filtered before the one shuffle that distinct takes.
    """
    entered = history.join(stage_dim.select("stage_id", "label", "is_won"), "stage_id").where(F.col("is_won") | (F.col("source_type") == "CRM_UI"))
    fact = entered.join(metric_dim, entered["label"] == metric_dim["stage_label"])
    return fact.select("deal_id", "metric", local_day(F.col("ts")).alias("day"), "actor").distinct()


def counts(fact: DataFrame, day_from: str, day_to: str) -> DataFrame:
    return fact.where(F.col("day").between(day_from, day_to)).groupBy("metric").agg(F.count("*").alias("n"))


def per_owner(fact: DataFrame, day_from: str, day_to: str) -> DataFrame:
    return fact.where(F.col("day").between(day_from, day_to)).groupBy("metric", "actor").agg(F.count("*").alias("n"))


def won_days(history: DataFrame, stage_dim: DataFrame) -> DataFrame:
    return history.join(stage_dim.where("is_won").select("stage_id"), "stage_id").select("deal_id", local_day(F.col("ts")).alias("day")).distinct()


def won_amount_by_week(history: DataFrame, stage_dim: DataFrame, deals: DataFrame) -> DataFrame:
    """(week, n_deals, amount): each deal once a week in which it was won on any day."""
    weeks = won_days(history, stage_dim).select("deal_id", F.date_trunc("week", F.col("day").cast("timestamp_ntz")).cast("date").alias("week")).distinct()
    return weeks.join(deals.select("deal_id", "amount"), "deal_id").groupBy("week").agg(F.count("*").alias("n_deals"), F.sum("amount").alias("amount"))
