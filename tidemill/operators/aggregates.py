"""Group aggregates, pivots and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.frames import numeric_columns, text_columns
from tidemill.session import written


def present(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose group keys are all known: a missing key forms no group."""
    return df.dropna(subset=list(keys))


def money_sum(name: str) -> Column:
    """Sum of a money column in exact decimals, so that it does not depend on the order of the rows."""
    return F.sum(F.col(name).cast("decimal(18,2)")).cast("double")


def money_mean(name: str) -> Column:
    return F.try_divide(money_sum(name), F.count(F.col(name)))


def total_and_peak(df: DataFrame, flow: str, level: str) -> DataFrame:
    return df.agg(F.sum(flow).alias(f"total_{flow}"), F.max(level).alias(f"max_{level}"))


def daily_totals(df: DataFrame, date: str, flows: Sequence[str], levels: Sequence[str] = ()) -> DataFrame:
    """Per date the sum of flow measures and the maximum of cumulative ones."""
    return present(df, date).groupBy(date).agg(
        *[F.sum(c).alias(c) for c in flows], *[F.max(c).alias(c) for c in levels]
    )


def daily_sums(df: DataFrame, date: str, measures: Sequence[str]) -> DataFrame:
    """Per date the sum of every measure, cumulative ones included."""
    return daily_totals(df, date, measures)


def mean_and_count(df: DataFrame, keys: Sequence[str], value: str, mean: str = "mean_value", count: str = "n_samples"
                   ) -> DataFrame:
    """Mean rounded half to even and the number of known values."""
    return present(df, *keys).groupBy(*keys).agg(
        F.bround(F.avg(value), 2).alias(mean), F.count(value).alias(count)
    )


def mean_and_std(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and sample deviation; a group of one row has no deviation."""
    return present(df, *keys).groupBy(*keys).agg(
        F.bround(F.avg(value), 2).alias("mean_value"), F.bround(F.stddev_samp(value), 2).alias("std_value")
    )


def total_with_attribute(df: DataFrame, key: str, flows: Sequence[str], attribute: str, order: str) -> DataFrame:
    """Sums per key and the attribute's first known value in the given order."""
    first_known = F.min_by(F.col(attribute), F.when(F.col(attribute).isNotNull(), F.col(order)))
    return present(df, key).groupBy(key).agg(
        *[F.sum(c).alias(c) for c in flows], first_known.alias(attribute)
    )


def frequency_table(df: DataFrame, *keys: str, count: str = "n_rows") -> DataFrame:
    """Rows per known key, most frequent first."""
    return present(df, *keys).groupBy(*keys).agg(F.count("*").alias(count)).orderBy(F.desc(count), *keys)


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


def date_range(df: DataFrame, date: str, key: str) -> DataFrame:
    """First and last date, number of rows and number of distinct keys."""
    return df.agg(
        F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count("*").alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
    )


def month_totals(df: DataFrame, date: str, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    month = F.date_format(date, "yyyy-MM").alias("month")
    return present(df, date, *keys).groupBy(month, *keys).agg(value.alias(name))


def pivot_table(df: DataFrame, index: Sequence[str], header: str, agg: Column, fill: object | None = None,
                values: Sequence[object] | None = None) -> DataFrame:
    """One column per header value found, or per stated one where ``values`` names them."""
    rows = present(df, *index)
    found = [v for (v,) in header_values(rows, [header])] if values is None else list(values)
    wide = rows.groupBy(*index).pivot(header, found).agg(agg)
    return wide if fill is None else wide.na.fill(fill, [str(v) for v in found])


def header_values(df: DataFrame, headers: Sequence[str]) -> list[tuple]:
    """The distinct header tuples in order. They become columns, so there are as many as a table can be wide."""
    return [tuple(r) for r in df.select(*headers).dropna().distinct().orderBy(*headers).collect()]


def dynamic_pivot(df: DataFrame) -> DataFrame:
    """First column as index, text columns as headers, mean of every number column, gaps as zero.

    Without a text column beyond the first the frame is returned as it is. ``means_by_header`` has the same means in
    long form, for headers too many to be columns.
    """
    index = df.columns[0]
    headers = [c for c in text_columns(df) if c != index]
    numbers = [c for c in numeric_columns(df) if c != index]
    if not headers:
        return df
    cells = []
    for values in header_values(df, headers):
        here = F.lit(True)
        for name, value in zip(headers, values):
            here = here & (F.col(name) == F.lit(value))
        for number in numbers:
            label = "_".join([number, *map(str, values)])
            cells.append(F.coalesce(F.avg(F.when(here, F.col(number))), F.lit(0.0)).alias(label))
    return present(df, index).groupBy(index).agg(*cells)


def means_by_header(df: DataFrame) -> DataFrame:
    """The mean of every number column per first column and text columns, one row for each combination found."""
    index = df.columns[0]
    headers = [c for c in text_columns(df) if c != index]
    numbers = [c for c in numeric_columns(df) if c != index]
    return present(df, index, *headers).groupBy(index, *headers).agg(*[F.avg(c).alias(c) for c in numbers])


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def share_percent(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Share of the column total. Meant for aggregated frames; the total is a scalar subquery."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value), total) * 100)


def fold_small_shares(df: DataFrame, label: str, value: str, threshold: float, other: str = "other") -> DataFrame:
    """Positive rows with their share; those below ``threshold`` percent are folded into one row."""
    shares = share_percent(df.filter(F.col(value) > 0), value, "share_pct")
    folded = F.when(F.col("share_pct") >= threshold, F.col(label)).otherwise(F.lit(other))
    return shares.groupBy(folded.alias(label)).agg(
        F.sum(value).alias(value), F.sum("share_pct").alias("share_pct"), F.count("*").alias("n_members")
    )


def kpi_summary(daily: DataFrame, date: str, flow: str, level: str, last: int = 30) -> DataFrame:
    """Total, latest level and daily mean over all days and over the last ``last`` days of a daily frame.

    The daily frame is numbered by one ordered window (its rows are bounded by the calendar), so that both
    spans come from a single pass over the data behind it.
    """
    numbered = daily.withColumn("back", F.row_number().over(Window.orderBy(F.desc(date))))
    recent = F.when(F.col("back") <= last, F.col(flow))
    return numbered.agg(
        F.sum(flow).alias("total"), F.max_by(level, date).alias("latest_level"),
        F.bround(F.avg(flow), 1).alias("daily_mean"), F.count("*").alias("n_days"),
        F.sum(recent).alias("last_total"), F.bround(F.avg(recent), 1).alias("last_daily_mean"),
        F.count(F.when(F.col("back") <= last, 1)).alias("last_days"),
    )


def with_extremes(df: DataFrame, measure: str) -> DataFrame:
    """Marks the rows of an aggregated frame that hold the highest and the lowest measure, ties included.

    The frame is written once, as its rows and its two ends are read separately.
    """
    kept = written(df, "extremes")
    highest, lowest = kept.select(F.max(measure)).scalar(), kept.select(F.min(measure)).scalar()
    return kept.withColumns({"is_highest": F.col(measure) == highest, "is_lowest": F.col(measure) == lowest})


def rank_by(df: DataFrame, measure: str, name: str = "rank") -> DataFrame:
    """Ranks with gaps, highest first; for aggregated frames of a few rows."""
    return df.withColumn(name, F.rank().over(Window.orderBy(F.desc(measure))))
