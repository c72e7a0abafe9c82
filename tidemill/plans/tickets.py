"""Ticket sales: line items as ticket orders, part name as the ticket code, nation as province."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.values import whole_number_text
from tidemill.operators import aggregates as agg
from tidemill.operators import frames, windows
from tidemill.session import written
from tidemill.sources.tables import register_views, sql_scan, table, target_scan


def ticket_orders(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("SKU"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_shipdate").alias("order_time"), F.col("l_returnflag").alias("sales_channel"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("order_value"),
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def ticket_weekly_sales(spark, folder):
    """Two kinds of tickets per week of one spring."""
    spring = ticket_orders(spark, folder).filter(
        (F.col("order_time") >= F.lit("1997-04-01").cast("timestamp_ntz"))
        & (F.col("order_time") < F.lit("1997-07-01").cast("timestamp_ntz"))
    )
    week = F.to_date(F.date_trunc("week", "order_time")).alias("week")
    return spring.groupBy(week).agg(
        agg.sum_where(F.col("SKU").like("small%"), F.col("quantity")).alias("one_day"),
        agg.sum_where(F.col("SKU").like("large%"), F.col("quantity")).alias("two_day"),
    )


def visitors_by_province(spark, folder):
    """Customers with an order in one month, by nation."""
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1997-06-01", "1997-07-01"))
    orders = table(spark, folder, "orders")
    month = orders.filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)).select("o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    return (
        month.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("province").agg(F.count("*").alias("n_orders"), F.count_distinct("o_custkey").alias("n_visitors"))
    )


def channel_rank(spark, folder):
    """Channels by order value within seven days."""
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1997-06-01", "1997-06-08"))
    lines = table(spark, folder, "lineitem").filter((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
    sums = lines.groupBy(F.col("l_returnflag").alias("channel")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount")
    )
    return agg.rank_by(sums, "amount").withColumn("amount", F.col("amount").cast("double"))


def top_5_entities(spark, folder):
    return frames.head(table(spark, folder, "supplier"), 5, F.desc("s_acctbal"), "s_suppkey").select(
        "s_suppkey", "s_name", "s_acctbal", whole_number_text(F.col("s_acctbal")).alias("balance_text")
    )


def channel_months(spark, folder):
    lines = table(spark, folder, "lineitem")
    return agg.month_totals(lines, "l_shipdate", ["l_returnflag", "l_linestatus"], F.sum("l_quantity"), "quantity")


def stacked_series_base(spark, folder):
    series = channel_months(spark, folder).withColumn("series", F.concat_ws("-", "l_returnflag", "l_linestatus"))
    return windows.stacked_base(series, "month", "series", "quantity").select("month", "series", "quantity", "base")


def dynamic_pivot_mean(spark, folder):
    """Months down, the channel and status pairs found in the data across."""
    # Read twice, for the headers and for the cells.
    wide = agg.dynamic_pivot(written(channel_months(spark, folder), "series"))
    return wide.select("month", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


def parameterised_query(spark, folder):
    register_views(spark, folder, ["events"], prefix="ticket_")
    return sql_scan(
        spark,
        "SELECT event_id, user_id, value FROM ticket_events WHERE event_type = :kind AND value > :least",
        kind="purchase", least=50.0,
    )


def target_column_scan(spark, folder):
    return target_scan(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"],
                       "l_extendedprice", ("l_extendedprice", "l_quantity"))


QUERIES = {
    "ticket_weekly_sales": ticket_weekly_sales,
    "visitors_by_province": visitors_by_province,
    "channel_rank": channel_rank,
    "top_5_entities": top_5_entities,
    "stacked_series_base": stacked_series_base,
    "dynamic_pivot_mean": dynamic_pivot_mean,
    "parameterised_query": parameterised_query,
    "target_column_scan": target_column_scan,
}
