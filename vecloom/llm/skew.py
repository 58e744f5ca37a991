"""Joining rows with one row per key where a few keys may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 1024


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """`rows` left-joined with `groups`, which has one row for each key and knows its rows.

    `count` is the number (or more) of the rows of that key among the `total` rows. Keys with more than
    1/HEAVY of the total are at most HEAVY, so they are broadcast and their rows stay where they
    are; the other rows are shuffled by key. Both sides are read twice: pass written tables.
    """
    groups = groups.withColumn("__heavy", F.col(count) * HEAVY > F.lit(total))
    heavy = groups.where("__heavy").drop("__heavy")
    light = groups.where(~F.col("__heavy")).drop("__heavy")
    hot = rows.join(F.broadcast(heavy), keys)
    cold = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys, "left")
    return hot.unionByName(cold)
