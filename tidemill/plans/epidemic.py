"""Daily and district reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.values import day_text, rate_per_100k
from tidemill.operators import aggregates as agg
from tidemill.operators import distribution, frames, windows
from tidemill.sources.sinks import parallel_lists_json, records_json
from tidemill.sources.tables import table


def money(name: str):
    return F.col(name).cast("decimal(18,2)")


def event_days(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.to_date("ts").alias("report_date"), F.col("event_type").alias("district"),
        money("value").alias("new_value"), F.col("event_id").alias("cumulative"),
    )


def order_days(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: date, new = 1, cumulative = order number."""
    return table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("report_date"), F.lit(1).alias("new_cases"),
        F.col("o_orderkey").alias("cum_cases"),
    )


def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    return agg.daily_totals(order_days(spark, folder), "report_date", ["new_cases"], ["cum_cases"])


def district_days(spark: SparkSession, folder: str) -> DataFrame:
    """Date, district, status and value of every order; the district is the customer's nation."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("district"))
    return (
        table(spark, folder, "orders")
        .select("o_custkey", F.to_date("o_orderdate").alias("report_date"), "o_orderstatus",
                money("o_totalprice").alias("value"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("report_date", "district", F.col("o_orderstatus").alias("risk"), "value")
    )


def populations(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("district"))
    return (
        table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("population"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("district", "population")
    )


def district_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The report table: one row per date and district with new and cumulative cases and the population."""
    days = district_days(spark, folder).groupBy("report_date", "district").agg(
        F.count("*").alias("new_cases"), F.sum("value").alias("value")
    )
    upto = Window.partitionBy("district").orderBy("report_date")
    return days.withColumn("cum_cases", F.sum("new_cases").over(upto)).join(populations(spark, folder), "district")


def daily_totals(spark, folder):
    days = agg.daily_totals(event_days(spark, folder), "report_date", ["new_value"], ["cumulative"])
    return days.withColumn("new_value", F.col("new_value").cast("double"))


def daily_sum_of_cumulative(spark, folder):
    days = agg.daily_sums(event_days(spark, folder), "report_date", ["new_value", "cumulative"])
    return days.withColumn("new_value", F.col("new_value").cast("double"))


def total_and_peak(spark, folder):
    return agg.total_and_peak(order_days(spark, folder), "new_cases", "cum_cases")


def moving_avg_7(spark, folder):
    moved = windows.moving_average(daily_orders(spark, folder), "report_date", "new_cases", 7)
    return moved.select("report_date", "new_cases", F.round("moving_avg", 6).alias("moving_avg"))


def growth_rate(spark, folder):
    """Moving average and growth of a day, gaps shown as zero."""
    daily = daily_orders(spark, folder)
    both = windows.growth_rate(windows.moving_average(daily, "report_date", "new_cases"), "report_date", "new_cases")
    return both.select(
        "report_date", "cum_cases",
        F.round(F.coalesce("moving_avg", F.lit(0.0)), 6).alias("moving_avg"),
        F.round(F.coalesce("growth_pct", F.lit(0.0)), 6).alias("growth_pct"),
    )


def last_30_days_kpi(spark, folder):
    return agg.kpi_summary(daily_orders(spark, folder), "report_date", "new_cases", "cum_cases", 30)


def last_30_days(spark, folder):
    return windows.last_rows(daily_orders(spark, folder), "report_date", 30)


def every_kth_day(spark, folder):
    return windows.every_kth(daily_orders(spark, folder), "report_date", 15).select(
        F.col("position").cast("bigint").alias("position"), "report_date", "new_cases"
    )


def district_rate_per_100k(spark, folder):
    totals = agg.total_with_attribute(
        district_daily(spark, folder), "district", ["new_cases"], "population", "report_date"
    )
    return totals.withColumn("rate_100k", rate_per_100k(F.col("new_cases"), F.col("population"))).orderBy(
        F.asc_nulls_last("rate_100k"), "district"
    )


def latest_snapshot(spark, folder):
    days = table(spark, folder, "events").withColumn("report_date", F.to_date("ts"))
    return frames.latest_snapshot(days, "report_date").select(
        "report_date", "event_id", "user_id", "event_type", F.col("value").cast("double").alias("value")
    )


def share_with_other_bucket(spark, folder):
    totals = district_days(spark, folder).groupBy("district").agg(F.sum("value").alias("value"))
    folded = agg.fold_small_shares(totals, "district", "value", 4.0)
    return folded.select("district", F.col("value").cast("double").alias("value"),
                         F.round(F.col("share_pct").cast("double"), 4).alias("share_pct"), "n_members")


def risk_value_counts(spark, folder):
    return agg.frequency_table(table(spark, folder, "orders").select(F.col("o_orderpriority").alias("risk")), "risk")


def district_risk_counts(spark, folder):
    return agg.frequency_table(district_days(spark, folder), "district", "risk")


def district_risk_pivot(spark, folder):
    return agg.pivot_table(district_days(spark, folder), ["district"], "risk", F.count(F.lit(1)), fill=0)


def month_district_pivot(spark, folder):
    days = district_days(spark, folder)
    monthly = agg.month_totals(days, "report_date", ["district"], F.count("*"), "new_cases")
    return agg.pivot_table(monthly, ["district"], "month", F.sum("new_cases"))


def month_totals(spark, folder):
    days = district_days(spark, folder)
    return agg.month_totals(days, "report_date", ["district"], F.sum("value").cast("double"), "value")


def top_10_days(spark, folder):
    days = agg.daily_totals(event_days(spark, folder), "report_date", ["new_value"])
    return frames.head(days, 10, F.desc_nulls_last("new_value"), "report_date").select(
        "report_date", F.col("new_value").cast("double").alias("new_value")
    )


def report_range(spark, folder):
    return agg.date_range(district_days(spark, folder), "report_date", "district")


def district_list(spark, folder):
    return agg.sorted_distinct(district_days(spark, folder), "district")


def daily_payload(spark, folder):
    days = daily_orders(spark, folder).withColumn("day", day_text(F.col("report_date")))
    return parallel_lists_json(days, "report_date", {"dates": "day", "new_cases": "new_cases",
                                                     "total_cases": "cum_cases"})


def district_payload(spark, folder):
    latest = frames.latest_snapshot(district_daily(spark, folder), "report_date")
    shaped = latest.select(F.col("district").alias("name"), F.col("new_cases").alias("value"),
                           F.col("cum_cases").alias("total"), "population")
    return records_json(shaped, {"value": "int", "total": "int", "population": "int"})


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


def column_profile(spark, folder):
    numbers = frames.spread(table(spark, folder, "lineitem").select(*NUMBERS))
    return distribution.column_profile(numbers, NUMBERS, places=3)


def correlation_matrix(spark, folder):
    return distribution.correlation_matrix(table(spark, folder, "lineitem"), NUMBERS)


QUERIES = {
    "daily_totals": daily_totals,
    "daily_sum_of_cumulative": daily_sum_of_cumulative,
    "total_and_peak": total_and_peak,
    "moving_avg_7": moving_avg_7,
    "growth_rate": growth_rate,
    "last_30_days": last_30_days,
    "last_30_days_kpi": last_30_days_kpi,
    "every_kth_day": every_kth_day,
    "district_rate_per_100k": district_rate_per_100k,
    "latest_snapshot": latest_snapshot,
    "share_with_other_bucket": share_with_other_bucket,
    "risk_value_counts": risk_value_counts,
    "district_risk_counts": district_risk_counts,
    "district_risk_pivot": district_risk_pivot,
    "month_district_pivot": month_district_pivot,
    "month_totals": month_totals,
    "top_10_days": top_10_days,
    "report_range": report_range,
    "district_list": district_list,
    "daily_payload": daily_payload,
    "district_payload": district_payload,
    "column_profile": column_profile,
    "correlation_matrix": correlation_matrix,
}
