"""Ranks and running totals that survive a group holding a large part of all rows.

A window over raw rows sends each group to one task. Here a group is first reduced to one
row per distinct value (or per day) with map-side combining, the window runs over those few
rows, and the result is joined back to the rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyboard.operators.matching import join_groups


def value_ranks(rows: DataFrame, group: list[str], value: str, descending: bool = False) -> DataFrame:
    """One row per group and distinct value: its rank, its number of ties and the group's size."""
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_first(value)
    whole = W.partitionBy(*group)
    better = whole.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    ties = rows.groupBy(*group, value).agg(F.count("*").alias("tie_count"))
    return ties.select(
        *group,
        value,
        (F.coalesce(F.sum("tie_count").over(better), F.lit(0)) + 1).alias("place"),
        "tie_count",
        F.sum("tie_count").over(whole).alias("group_size"),
    )


def with_rank(rows: DataFrame, group: list[str], value: str, name: str, descending: bool = False) -> DataFrame:
    """Add the rank of each row's value in its group."""
    ranks = value_ranks(rows, group, value, descending).select(*group, value, F.col("place").alias(name))
    return join_groups(rows, ranks, [*group, value])


def running_totals(rows: DataFrame, group: list[str], day: str, amount: str, name: str, by_year: bool = False) -> DataFrame:
    """One row per group and day: the group's total up to and including the day, `by_year` since the year began.

    Rows of one day share the total, so the window needs one row per day and group: at most
    366 a year, however many rows a day has. The year follows from the day and is not carried along.
    """
    daily = rows.groupBy(*group, day).agg(F.sum(amount).alias("_day_total")).repartition(*group)
    whole = [*group, F.year(day)] if by_year else group
    so_far = W.partitionBy(*whole).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return daily.select(*group, day, F.sum("_day_total").over(so_far).alias(name))


def with_running_total(rows: DataFrame, group: list[str], day: str, amount: str, name: str) -> DataFrame:
    """Add the group's total up to and including each row's day."""
    return join_groups(rows, running_totals(rows, group, day, amount, name), [*group, day])
