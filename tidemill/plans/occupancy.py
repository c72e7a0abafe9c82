"""Hospital occupancy reports: supplier as hospital, part type as department, region as district."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates as agg
from tidemill.operators import distribution
from tidemill.operators.frames import spread
from tidemill.operators.joins import left_lookup
from tidemill.sources.tables import table



def usage(spark, folder):
    """hospital_id, department_id, timestamp and occupancy rate as recorded."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("hospital_id"), F.col("l_partkey").alias("department_id"),
        F.col("l_shipdate").alias("timestamp"), F.col("l_quantity").alias("occupancy_rate"),
    )


def hospitals(spark, folder):
    supplier, nation, region = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("hospital_id"), F.col("s_name").alias("hospital_name"),
                F.col("r_name").alias("hospital_district"))
    )


def departments(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("department_id"), F.col("p_type").alias("department_name")
    )


def named_usage(spark, folder):
    return usage(spark, folder).join(hospitals(spark, folder), "hospital_id").join(
        departments(spark, folder), "department_id"
    )


def occupancy_by_hospital(spark, folder):
    # Names are attached after the aggregate, to one row per hospital.
    means = agg.mean_and_count(usage(spark, folder), ["hospital_id"], "occupancy_rate")
    return left_lookup(means, hospitals(spark, folder), "hospital_id", ["hospital_name"])


def occupancy_by_dept(spark, folder):
    rows = usage(spark, folder).join(departments(spark, folder), "department_id")
    means = agg.mean_and_count(rows, ["hospital_id", "department_name"], "occupancy_rate")
    return left_lookup(means, hospitals(spark, folder), "hospital_id", ["hospital_name"])


def mean_std_by_district(spark, folder):
    rows = usage(spark, folder).join(hospitals(spark, folder), "hospital_id")
    return agg.mean_and_std(rows, ["hospital_district"], "occupancy_rate")


def mean_std_by_dept(spark, folder):
    rows = usage(spark, folder).join(departments(spark, folder), "department_id")
    return agg.mean_and_std(rows, ["department_name"], "occupancy_rate").orderBy("mean_value", "department_name")


def dept_district_pivot(spark, folder):
    return agg.pivot_table(named_usage(spark, folder), ["department_name"], "hospital_district",
                           F.bround(F.avg("occupancy_rate"), 2))


def time_trend(spark, folder):
    trend = usage(spark, folder).groupBy("timestamp").agg(F.avg("occupancy_rate").alias("m"))
    return trend.select("timestamp", F.round("m", 6).alias("mean_rate"))


def trend_by_district(spark, folder):
    rows = usage(spark, folder).join(hospitals(spark, folder), "hospital_id")
    return agg.pivot_table(rows, ["timestamp"], "hospital_district", F.round(F.avg("occupancy_rate"), 6))


def boxplot_stats(spark, folder):
    prices = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("hospital_id"), F.col("l_extendedprice").alias("rate")
    )
    rows = spread(prices).join(hospitals(spark, folder), "hospital_id")
    stats = distribution.box_plot(rows, ["hospital_district"], "rate")
    return stats.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


def boxplot_by_hospital(spark, folder):
    stats = distribution.box_plot(usage(spark, folder), ["hospital_id"], "occupancy_rate")
    return stats.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


def boxplot_outliers(spark, folder):
    """Customers whose balance measure lies outside the fences of their segment."""
    balances = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal").withColumn(
        "size", F.pow(F.col("c_acctbal") / 1000, 3)
    )
    return distribution.box_plot_outliers(balances, ["c_mktsegment"], "size", reach=0.5).select(
        "c_custkey", "c_mktsegment", "c_acctbal"
    )


def left_join_quarter_score(spark, folder):
    """Every customer with the mean order price of one quarter; customers without orders keep an empty score."""
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1997-10-01", "1998-01-01"))
    scores = (
        table(spark, folder, "orders").filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
        .groupBy("o_custkey").agg(agg.money_mean("o_totalprice").alias("score"))
        .withColumnsRenamed({"o_custkey": "employee_id"})
    )
    staff = table(spark, folder, "customer").select(F.col("c_custkey").alias("employee_id"),
                                                    F.col("c_name").alias("name"))
    merged = left_lookup(staff, scores, "employee_id", ["score"])
    return merged.withColumnsRenamed({"score": "score_1997_q4"})


QUERIES = {
    "occupancy_by_hospital": occupancy_by_hospital,
    "occupancy_by_dept": occupancy_by_dept,
    "mean_std_by_district": mean_std_by_district,
    "mean_std_by_dept": mean_std_by_dept,
    "dept_district_pivot": dept_district_pivot,
    "time_trend": time_trend,
    "trend_by_district": trend_by_district,
    "boxplot_stats": boxplot_stats,
    "boxplot_by_hospital": boxplot_by_hospital,
    "boxplot_outliers": boxplot_outliers,
    "left_join_quarter_score": left_join_quarter_score,
}
