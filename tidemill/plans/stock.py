"""Inventory: line items as stock in bins, parts as articles, suppliers as bins, orders as demand."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.values import normalize_quality, split_sku_argument
from tidemill.operators import inventory
from tidemill.operators.joins import unmatched_report
from tidemill.sources.tables import table


def quality_of(flag):
    return F.when(flag == "A", "合格").when(flag == "N", "残次").otherwise("待检")


def named_stock(spark, folder, *keys):
    """Stock added up per article, quality and further keys of the lines, by the keys as stored; the article's name and
    codes are joined to the sums."""
    qty = F.col("l_quantity").cast("bigint")
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity", *keys)
    sums = lines.groupBy("l_partkey", "l_returnflag", *keys).agg(
        F.count("*").alias("n_rows"), F.sum(qty).alias("qty"),
        F.sum(F.when(F.col("l_linestatus") == "O", qty).otherwise(F.lit(0))).alias("occupied"),
    )
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("skuName"))
    return sums.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("skuCode"), "skuName",
        normalize_quality(quality_of(F.col("l_returnflag"))).alias("quality"), *keys, "n_rows", "qty", "occupied",
    )


def physical(spark, folder):
    """Stock per line: the article by part, the bin by supplier, open lines count as occupied."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    qty = F.col("l_quantity").cast("bigint")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("skuCode"),
        F.col("p_name").alias("skuName"),
        normalize_quality(quality_of(F.col("l_returnflag"))).alias("quality"),
        F.concat(F.lit("L-"), F.col("l_suppkey").cast("string")).alias("binCode"),
        F.col("p_brand").alias("areaCode"),
        F.col("p_type").alias("areaName"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("produceDate"),
        F.concat(F.lit("D"), F.col("l_linenumber").cast("string")).alias("productionNo"),
        qty.alias("qty"),
        F.when(F.col("l_linestatus") == "O", qty).otherwise(F.lit(0)).alias("occupied"),
    )


def inventory_overview(spark, folder):
    return inventory.overview(named_stock(spark, folder))


def inventory_search(spark, folder):
    found = inventory.search(physical(spark, folder), sku="small (ring|rod)", quality="残次", area="brand#1")
    return inventory.physical_response(found).select(
        "skuCode", "skuName", "quality", "binCode", "areaCode", "areaName",
        F.col("batchInfo.produceDate").alias("produceDate"), F.col("batchInfo.productionNo").alias("productionNo"),
        "qty", "occupied", "available",
    )


def inventory_search_all_fields(spark, folder):
    return inventory.search(physical(spark, folder), sku="anvil", quality="合格", bin_code="L-7", area="ECONOMY",
                            production_no="D1")


def inventory_search_made(spark, folder):
    """Stock made on one day."""
    return inventory.search(physical(spark, folder), sku="anvil", produce_date="1997-03-24")


def sku_availability(spark, folder):
    """Every article of the part table, stocked or not."""
    wanted = table(spark, folder, "part").select(F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku"))
    return inventory.requested_availability(wanted, inventory_overview(spark, folder))


def sku_availability_status(spark, folder):
    """Articles asked for by customer number, good stock only; most customer numbers are no article."""
    wanted = table(spark, folder, "customer").select(
        F.concat(F.lit("SKU"), (F.col("c_custkey") * 3).cast("string")).alias("sku")
    )
    return inventory.requested_availability(wanted, inventory_overview(spark, folder), "status", ["合格"])


def sku_not_found(spark, folder):
    wanted = table(spark, folder, "orders").select(
        F.concat(F.lit("SKU"), (F.col("o_custkey") * 2).cast("string")).alias("skuCode")
    )
    return unmatched_report(wanted, inventory_overview(spark, folder).select("skuCode").distinct(), "skuCode")


def sku_bin_status(spark, folder):
    """One ``"sku,bin"`` request text per customer."""
    text = F.concat(F.lit(" SKU"), F.col("c_custkey").cast("string"), F.lit(" ,"),
                    F.when(F.col("c_nationkey") > 5, F.concat(F.lit(" L-"), F.col("c_nationkey").cast("string")))
                    .otherwise(F.lit("")))
    asked = table(spark, folder, "customer").select(split_sku_argument(text).alias("a")).select("a.sku", "a.bin")
    stock = named_stock(spark, folder, "l_suppkey")
    return inventory.bin_status(asked, stock.withColumn("binCode", F.concat(F.lit("L-"), F.col("l_suppkey").cast("string"))))


def order_lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.concat(F.lit("SKU"), F.col("l_partkey").cast("string")).alias("sku"),
        (F.col("l_quantity") * 12).cast("bigint").alias("qty"),
    )


def order_feasibility(spark, folder):
    free = inventory.availability(inventory_overview(spark, folder), ["合格"])
    return inventory.order_feasibility(order_lines(spark, folder), free)


def sku_table_function(spark, folder):
    physical(spark, folder).createOrReplaceTempView("stock_physical")
    inventory_overview(spark, folder).createOrReplaceTempView("stock_overview_rows")
    inventory.register_table_functions(spark, "stock_overview_rows", "stock_physical")
    return spark.sql("""
        SELECT o.quality, count(*) AS n_rows, sum(o.qty) AS qty, sum(o.occupied) AS occupied
        FROM stock_overview('gear') o GROUP BY o.quality
        UNION ALL
        SELECT 'bins', count(*), sum(qty), sum(occupied) FROM stock_bins(area => 'brand#2', lot => 'D3')
        UNION ALL
        SELECT 'one article', 1, totalQty, totalOccupied FROM sku_overview('small ring')
    """)


QUERIES = {
    "inventory_overview": inventory_overview,
    "inventory_search": inventory_search,
    "inventory_search_all_fields": inventory_search_all_fields,
    "inventory_search_made": inventory_search_made,
    "sku_availability": sku_availability,
    "sku_availability_status": sku_availability_status,
    "sku_not_found": sku_not_found,
    "sku_bin_status": sku_bin_status,
    "order_feasibility": order_feasibility,
    "sku_table_function": sku_table_function,
}
