"""Joins whose keys may be NULL and must still match, as window groups do."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Give every row the columns of its group; NULL keys form a group like any other.

    `groups` has one row per key, so a hot key is hot on the row side only and adaptive
    execution can split it.
    """
    renamed = groups.withColumnsRenamed({key: f"_group_{key}" for key in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_group_{key}")) for key in keys]
    )
    return rows.join(renamed, same, how).drop(*[f"_group_{key}" for key in keys])
