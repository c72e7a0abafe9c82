"""Exact quantiles, column profiles, correlations and box plots."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.aggregates import present
from tidemill.session import written

QUARTILES = (0.25, 0.5, 0.75)


def unpivoted(df: DataFrame, columns: Sequence[str], label: str = "column_name", value: str = "value") -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), label, value)


def counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, v, m, part), written: every known value with its count, range-partitioned by key and value.

    Equal values are added up before they travel. ``part`` numbers the ranges in order, so a group of any size lies
    in neighbouring ranges of bounded size.
    """
    known = df.select(*keys, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counts = known.groupBy(*keys, "v").agg(F.count("*").alias("m"))
    return written(counts.repartitionByRange(*keys, "v").withColumn("part", F.spark_partition_id()), "values")


def quantiles_of(values: DataFrame, keys: Sequence[str], probs: Sequence[float] = QUARTILES,
                 names: Sequence[str] = ("q1", "median", "q3")) -> DataFrame:
    """Group size and linearly interpolated quantiles per key from ``counted_values``.

    The sizes of the ranges, one row per key and range, tell in which ranges the wanted ranks lie; only those are
    ranked, each for itself.
    """
    keys = list(keys)
    ranges = values.groupBy(*keys, "part").agg(F.sum("m").alias("in_part"))
    along = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sized = ranges.withColumns({
        "start": F.coalesce(F.sum("in_part").over(along), F.lit(0)),
        "n": F.sum("in_part").over(Window.partitionBy(*keys)),
    })
    places = [F.col("n").cast("double") * p - p for p in probs]  # p * (n - 1)
    wanted = F.lit(False)
    for place in places:
        for rank in (F.floor(place), F.ceil(place)):
            wanted = wanted | ((F.col("start") <= rank) & (rank < F.col("start") + F.col("in_part")))
    held = values.join(sized.filter(wanted).drop("in_part"), [*keys, "part"])
    upto = Window.partitionBy(*keys, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = held.withColumn("last_rank", F.col("start") + F.sum("m").over(upto))
    picks = [F.max("n").alias("n")]
    for place, name in zip(places, names):
        # First value whose last rank passes the wanted zero-based rank.
        picks.append(F.min(F.when(F.col("last_rank") > F.floor(place), F.col("v"))).alias(f"{name}_low"))
        picks.append(F.min(F.when(F.col("last_rank") > F.ceil(place), F.col("v"))).alias(f"{name}_high"))
        picks.append(F.max(place - F.floor(place)).alias(f"{name}_part"))
    blended = [
        (F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * F.col(f"{n}_part")).alias(n) for n in names
    ]
    return ranked.groupBy(*keys).agg(*picks).select(*keys, "n", *blended)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float] = QUARTILES,
                    names: Sequence[str] = ("q1", "median", "q3")) -> DataFrame:
    """Group size, mean, deviation, ends and linearly interpolated quantiles per key."""
    keys = list(keys)
    known = df.select(*keys, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    summary = known.groupBy(*keys).agg(
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("lowest"), F.max("v").alias("highest"),
    )
    picked = quantiles_of(counted_values(df, keys, value), keys, probs, names)
    return summary.join(picked, keys).select(*keys, "n", "mean", "std", "lowest", "highest", *names)


def column_profile(df: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    """Count, mean, deviation, ends, quartiles and null rate of number columns, one row per column."""
    long = unpivoted(df, columns)
    n_rows = df.select(F.count("*")).scalar()
    stats = exact_quantiles(long, ["column_name"], "value")
    rounded = [F.round(F.col(c), places).alias(c) for c in ("mean", "std", "lowest", "q1", "median", "q3", "highest")]
    # Columns without a single value still get a row.
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(stats, "column_name", "left").select(
        "column_name",
        F.coalesce("n", F.lit(0)).alias("n_values"),
        *rounded,
        (n_rows - F.coalesce("n", F.lit(0))).alias("n_null"),
        (F.round(F.try_divide(n_rows - F.coalesce("n", F.lit(0)), n_rows), 4) * 100).alias("null_pct"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], places: int = 2) -> DataFrame:
    """Pearson correlations of all column pairs in long form, from one pass; null pairs are left out."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = list(combinations(columns, 2))
    one = numbers.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cell = lambda a, b, c: F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), c.alias("r"))
    cells = [cell(c, c, F.lit(1.0)) for c in columns]
    for a, b in pairs:
        r = F.col(f"`{a}|{b}`")
        cells += [cell(a, b, r), cell(b, a, r)]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.x", "c.y", F.round("c.r", places).alias("corr"))


def box_plot(df: DataFrame, keys: Sequence[str], value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends within ``reach`` interquartile ranges and the number of outliers per key."""
    keys = list(keys)
    values = counted_values(present(df, *keys), keys, value)
    fences = box_fences(values, keys, reach)
    within = F.col("v").between(F.col("low_fence"), F.col("high_fence"))
    whiskers = values.join(fences.select(*keys, "low_fence", "high_fence"), keys).groupBy(*keys).agg(
        F.min(F.when(within, F.col("v"))).alias("low_whisker"),
        F.max(F.when(within, F.col("v"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~within, F.col("m"))), F.lit(0)).alias("n_outliers"),
    )
    return fences.drop("low_fence", "high_fence").join(whiskers, keys)


def box_fences(values: DataFrame, keys: list[str], reach: float) -> DataFrame:
    spread = reach * (F.col("q3") - F.col("q1"))
    fences = quantiles_of(values, keys).select(
        *keys, "n", "q1", "median", "q3", (F.col("q1") - spread).alias("low_fence"),
        (F.col("q3") + spread).alias("high_fence"),
    )
    return written(fences, "fences")


def box_plot_outliers(df: DataFrame, keys: Sequence[str], value: str, reach: float = 1.5) -> DataFrame:
    """The rows outside the fences."""
    keys = list(keys)
    grouped = present(df, *keys)
    fences = box_fences(counted_values(grouped, keys, value), keys, reach).select(*keys, "low_fence", "high_fence")
    outside = ~F.col(value).cast("double").between(F.col("low_fence"), F.col("high_fence"))
    return grouped.join(fences, keys).filter(outside).drop("low_fence", "high_fence")
