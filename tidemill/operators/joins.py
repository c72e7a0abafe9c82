"""Joins: lookups, missing keys and interval lookups.

Joins on keys that may be hot are plain equality joins: the adaptive skew join splits a key's rows by what was counted
in the shuffle, without repeating the rows of cold keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def left_lookup(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], null_safe: bool = False
                ) -> DataFrame:
    """Left join to the projected right side. Repeated right keys repeat the left row.

    ``null_safe`` lets a missing key match a missing key.
    """
    wanted = right.select(F.col(key).alias("lookup_key"), *columns)
    same = F.col(key).eqNullSafe(F.col("lookup_key")) if null_safe else F.col(key) == F.col("lookup_key")
    return left.join(wanted, same, "left").drop("lookup_key")


def unknown_keys(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return requested.join(known.select(key), key, "left_anti")


def unmatched_report(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of ``df`` the dimension lacks, with their row counts; rows are counted before the join."""
    counts = df.groupBy(key).agg(F.count("*").alias("n_rows"))
    return unknown_keys(counts, dimension, key)


def interval_lookup(points: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, start: str, end: str,
                    width: int, how: str = "inner") -> DataFrame:
    """Joins points to the half-open intervals ``[start, end)`` that hold them.

    Both sides are cut into cells of ``width`` and joined on the cell, so a point meets only the intervals
    that reach into its own cell and never all intervals of its key. Choose ``width`` near the usual interval
    length: a longer interval is listed once per cell it touches. ``how='left'`` keeps points outside all
    intervals.
    """
    def cell_of(position: Column) -> Column:
        return F.floor(position / width)

    listed = intervals.filter(F.col(end) > F.col(start)).select(
        *[F.col(k).alias(f"interval_{k}") for k in keys],
        *[c for c in intervals.columns if c not in keys],
        F.explode(F.sequence(cell_of(F.col(start)), cell_of(F.col(end) - 1))).alias("interval_cell"),
    )
    placed = points.withColumn("cell", cell_of(F.col(point)))
    held = (F.col("cell") == F.col("interval_cell")) & (F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))
    for k in keys:
        held = held & (F.col(k) == F.col(f"interval_{k}"))
    return placed.join(listed, held, how).drop("cell", "interval_cell", *[f"interval_{k}" for k in keys])
