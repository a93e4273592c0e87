"""Running numbers over whole tables without a task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.scratch import materialize


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with name: their place, from 1, in an order that should leave no ties.

    Rows are range-partitioned by the order and written once with the number of
    their range; each range counts its rows, and running sums over those counts,
    one row for each range, say where it begins.
    """
    kept = materialize(rows.repartitionByRange(*order).withColumn("range_id", F.spark_partition_id()), "ranges")
    counts = kept.groupBy("range_id").agg(F.count("*").alias("range_rows"))
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range_id", F.coalesce(F.sum("range_rows").over(before), F.lit(0)).alias("range_start"))
    place = F.row_number().over(Window.partitionBy("range_id").orderBy(*order)) + F.col("range_start")
    return kept.join(starts, "range_id").withColumn(name, place).drop("range_id", "range_start")


def numbered_within(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """rows with name: their place, from 1, among those of the same group; a group may hold any part of the rows."""
    placed = numbered(rows, [F.col(group), *order], name)
    first = placed.groupBy(F.col(group).alias("group_key")).agg(F.min(name).alias("group_start"))
    out = placed.join(first, F.col(group).eqNullSafe(F.col("group_key")))
    return out.withColumn(name, F.col(name) - F.col("group_start") + 1).drop("group_key", "group_start")


#: Rows of a group up to which they are numbered in one task.
WHOLE = 100_000


def numbered_each(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """What numbered_within gives, for rows whose groups are small but for some: those are dealt by group and sorted, only the rows of larger ones are numbered by ranges. Rows are gone through twice, so they should be cheap to read."""
    large = materialize(rows.groupBy(F.col(group).alias("group_key")).agg(F.count("*").alias("n")).where(F.col("n") > WHOLE).select("group_key"), "large-groups")
    each = lambda df: df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))
    if large.isEmpty():
        return each(rows)
    same = F.col(group).eqNullSafe(F.col("group_key"))
    return each(rows.join(large, same, "left_anti")).unionByName(numbered_within(rows.join(large, same, "left_semi"), group, order, name))


def running_within(rows: DataFrame, group: str, order: list[Column], value: str, name: str) -> DataFrame:
    """rows with name: the sum of value up to and including each, among those of the same group in an order that should leave no ties; a group may hold any part of the rows.

    Range partitions are summed by group, and running sums over those, one row for each range of a group, say what each range begins with.
    """
    kept = materialize(rows.repartitionByRange(F.col(group), *order).withColumn("range_id", F.spark_partition_id()), "ranges")
    sums = kept.groupBy(F.col(group).alias("range_group"), F.col("range_id").alias("range_of")).agg(F.sum(value).alias("range_sum"))
    before = Window.partitionBy("range_group").orderBy("range_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("range_group", "range_of", F.coalesce(F.sum("range_sum").over(before), F.lit(0)).alias("range_start"))
    here = Window.partitionBy("range_id", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = kept.withColumn(name, F.sum(value).over(here))
    out = summed.join(starts, F.col(group).eqNullSafe(F.col("range_group")) & (F.col("range_id") == F.col("range_of")))
    return out.withColumn(name, F.col(name) + F.col("range_start")).drop("range_id", "range_group", "range_of", "range_start")
