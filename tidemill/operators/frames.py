"""Projection, filters and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def describe_columns(df: DataFrame) -> DataFrame:
    """Column names, types and the row count: one row per column."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"))
        for i, f in enumerate(df.schema.fields)
    ])
    return df.agg(F.count("*").alias("n_rows")).select(F.explode(entries).alias("e"), "n_rows").select("e.*", "n_rows")


def head(df: DataFrame, n: int = 20, *order: str | Column) -> DataFrame:
    """First rows in a stated order; the limit is part of the plan, so nothing else is fetched."""
    return (df.orderBy(*order) if order else df).limit(n)


def columns_of_type(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.StringType)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def contains_text(column: Column, needle: str, literal: bool = False) -> Column:
    """Case-blind search; the needle is a regular expression unless ``literal``; null never matches."""
    hit = F.contains(F.lower(column), F.lit(needle.lower())) if literal else column.rlike("(?i)" + needle)
    return F.coalesce(hit, F.lit(False))


def latest_snapshot(df: DataFrame, date: str) -> DataFrame:
    """Rows of the latest date. The maximum is a scalar subquery, so no row is moved to find it."""
    newest = df.select(F.max(date)).scalar()
    return df.filter(F.col(date) == newest)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``reject_reason``: the first rule a row breaks, null for a valid row.

    A rule that is null counts as broken.
    """
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    return df.withColumn("reject_reason", reason)


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Missing values replaced with the mean of the column, read through a scalar subquery."""
    mean = df.select(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def entries(df: DataFrame, array: str | Column, name: str, *keep: str) -> DataFrame:
    """One row per entry of an array, null entries left out.

    A plain explode makes the optimizer test the array's size first, which computes a derived array once more
    for the test; the outer form with a null test after it does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def numbered_entries(df: DataFrame, array: str | Column, position: str, name: str, *keep: str) -> DataFrame:
    """One row per entry of an array with its position."""
    return df.select(*keep, F.posexplode_outer(array).alias(position, name)).filter(F.col(position).isNotNull())


FEW_SPLITS = 32  # a few gigabytes at the usual split size


def spread(df: DataFrame) -> DataFrame:
    """Shares a small table, of at most ``FEW_SPLITS`` splits and fewer than there are cores, among the cores, for work
    that is heavy per row. Larger tables pass through without a shuffle, on a cluster of any size."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(min(cores, 4 * FEW_SPLITS)) if splits < min(cores, FEW_SPLITS) else df


def append_partial(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Appends rows that lack some columns; those become null."""
    return df.unionByName(extra, allowMissingColumns=True)
