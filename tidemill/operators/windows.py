"""Ordered computations: moving values over report frames, and positions in tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.values import hash_order
from tidemill.session import written


def moving_average(daily: DataFrame, date: str, value: str, rows: int = 7, name: str = "moving_avg") -> DataFrame:
    """Mean of the last ``rows`` rows, null until that many exist.

    Takes a daily frame, whose rows are bounded by the calendar, so one ordered window holds all of it.
    """
    w = Window.orderBy(date).rowsBetween(-(rows - 1), 0)
    return daily.withColumn(name, F.when(F.count(F.col(value)).over(w) == rows, F.avg(value).over(w)))


def growth_rate(daily: DataFrame, date: str, value: str, name: str = "growth_pct") -> DataFrame:
    """Change against the row before in percent; null for the first row and after a zero."""
    before = F.lag(value).over(Window.orderBy(date))
    return daily.withColumn(name, (F.try_divide(F.col(value), before) - 1) * 100)


def last_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows by a top-n sort, which keeps n rows per task rather than ranking all."""
    return df.orderBy(F.desc(order)).limit(n)


def every_kth(daily: DataFrame, order: str, k: int) -> DataFrame:
    """Rows 0, k, 2k, … of a daily frame in order."""
    position = F.row_number().over(Window.orderBy(order)) - 1
    return daily.withColumn("position", position).filter(F.col("position") % k == 0)


def stacked_base(df: DataFrame, index: str, series: str, value: str, name: str = "base") -> DataFrame:
    """Height below each segment of a stacked bar: the sum of the earlier series at the same index."""
    w = Window.partitionBy(index).orderBy(series).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows per group. Each task cuts to k rows per group before the shuffle, so a hot group is
    never gathered whole. ``order`` must end in a unique column."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def ordered_index(df: DataFrame, *order: str | Column, name: str = "index", partitions: int | None = None
                  ) -> DataFrame:
    """Zero-based position of every row in a total order, without a window over all rows.

    Rows are range-partitioned by the order columns and written once with their position inside their
    partition; the partition sizes (one small row each) then give every partition its offset. The order must
    be unique for the numbering to be repeatable.
    """
    # Without a stated number of partitions Spark joins neighbouring ranges that turn out small.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    numbered = ranged.sortWithinPartitions(*order).withColumn("placed", F.monotonically_increasing_id())
    placed = written(numbered, "ordered").withColumns({"part": F.shiftright("placed", 33), "offset_in_part": F.col("placed").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition of the table: a few thousand at most, whatever the table's size.
    offsets = F.broadcast(sizes.select("part", F.coalesce(before, F.lit(0)).alias("part_start")))
    return (
        placed.join(offsets, "part")
        .withColumn(name, F.col("part_start") + F.col("offset_in_part"))
        .drop("placed", "part", "offset_in_part", "part_start")
    )


def batch_ids(df: DataFrame, order: Sequence[str | Column], size: int) -> DataFrame:
    """Adds ``index`` and ``batch_id``: consecutive batches of ``size`` rows, the last one short."""
    return ordered_index(df, *order).withColumn("batch_id", F.expr(f"index div {size}"))


def cyclic_batches(df: DataFrame, order: Sequence[str], size: int, n_batches: int, key: str,
                   shuffle_seed: int | None = None) -> DataFrame:
    """``n_batches`` full batches read from the rows in order, starting over when they run out.

    Row i of N fills the places i, i+N, i+2N, …; a place names its batch and slot. With a seed the slots
    inside each batch follow a repeatable shuffle; batches never exchange rows.
    """
    indexed = ordered_index(df, *order)
    n_rows = indexed.select(F.count("*")).scalar()
    total = size * n_batches
    placed = (
        indexed.withColumn("n_rows", n_rows)
        .filter(F.col("index") < total)
        .withColumn("place", F.explode(F.sequence(F.col("index"), F.lit(total - 1), F.col("n_rows"))))
        .withColumns({"batch_id": F.expr(f"place div {size}"), "slot": F.col("place") % size})
        .drop("n_rows", "place", "index")
    )
    if shuffle_seed is None:
        return placed
    w = Window.partitionBy("batch_id").orderBy(hash_order(F.col(key), shuffle_seed), "slot")
    return placed.withColumn("slot", (F.row_number().over(w) - 1).cast("bigint"))


def split_exact(df: DataFrame, key: str, fraction: float, seed: int = 100) -> DataFrame:
    """Repeatable shuffle and cut: the first ``floor(fraction * N)`` rows are ``train``, the rest ``val``."""
    indexed = ordered_index(df.withColumn("shuffle", hash_order(F.col(key), seed)), "shuffle", key)
    n_train = F.floor(indexed.select(F.count("*")).scalar() * F.lit(fraction))
    side = F.when(F.col("index") < n_train, "train").otherwise("val")
    return indexed.withColumn("split", side).drop("shuffle")


def running_total(df: DataFrame, group: str, position: str, value: Column, block: int = 10_000,
                  name: str = "running_total") -> DataFrame:
    """Running sum along an integer position inside each group, with no group held by one task.

    Groups are cut into blocks of positions; block sums are accumulated first and each block then runs on
    its own from its starting sum.
    """
    blocks = df.withColumns({"block": F.floor(F.col(position) / block), "step": value})
    sums = blocks.groupBy(group, "block").agg(F.sum("step").alias("block_sum"))
    earlier = Window.partitionBy(group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(group, "block", F.coalesce(F.sum("block_sum").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy(group, "block").orderBy(position)
    return (
        blocks.join(starts, [group, "block"])
        .withColumn(name, F.col("start") + F.sum("step").over(inside))
        .drop("block", "step", "start")
    )
