"""Inventory rules and joins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill.functions.values import normalize_quality, split_sku_argument
from tidemill.operators import inventory, joins

# A small stock.
PHYSICAL = [
    ("APPLE001", "红富士苹果", "GENIUNE", "L-01-05", "N01", "冷藏区A", "2024-01-15", "D123456", 50, 10),
    ("APPLE001", "红富士苹果", "DEFECTIVE", "L-01-06", "N01", "冷藏区A", "2024-01-16", "D123457", 50, 10),
    ("BANANA001", "香蕉", "GENIUNE", "L-02-01", "N02", None, "2024-01-20", "D123458", 200, 30),
    ("A.C", None, "GRADE", "L-03-01", "N03", "库(1)", "2024-01-21", "D1", 5, 5),
]


@pytest.fixture
def physical(spark):
    from tidemill.sources.schemas import INVENTORY_PHYSICAL

    return spark.createDataFrame(PHYSICAL, INVENTORY_PHYSICAL)


@pytest.fixture
def stock(physical):
    return inventory.overview(physical)


def skus(df):
    return sorted(r["skuCode"] + "/" + r["binCode"] for r in df.collect())


def test_each_predicate(physical):
    assert skus(inventory.search(physical)) == skus(physical)
    assert skus(inventory.search(physical, sku="apple")) == ["APPLE001/L-01-05", "APPLE001/L-01-06"]
    assert skus(inventory.search(physical, sku="香蕉")) == ["BANANA001/L-02-01"]
    assert skus(inventory.search(physical, quality="残次")) == ["APPLE001/L-01-06"]
    assert skus(inventory.search(physical, bin_code="L-02-01")) == ["BANANA001/L-02-01"]
    assert skus(inventory.search(physical, area="冷藏")) == ["APPLE001/L-01-05", "APPLE001/L-01-06"]
    assert skus(inventory.search(physical, produce_date="2024-01-21")) == ["A.C/L-03-01"]
    assert skus(inventory.search(physical, production_no="D1")) == ["A.C/L-03-01"]
    assert skus(inventory.search(physical, sku="", quality="")) == skus(physical)
    assert skus(inventory.search(physical, quality="unheard")) == []


def test_search_text_is_a_pattern_unless_literal(physical):
    assert skus(inventory.search(physical, sku="a.*1")) == ["APPLE001/L-01-05", "APPLE001/L-01-06", "BANANA001/L-02-01"]
    assert skus(inventory.search(physical, sku="a.c", literal=True)) == ["A.C/L-03-01"]
    assert skus(inventory.search(physical, area="库(1", literal=True)) == ["A.C/L-03-01"]


def test_response_rows(physical):
    row = inventory.physical_response(physical).filter("binCode = 'L-02-01'").first()
    assert (row["available"], row["batchInfo"]["productionNo"]) == (170, "D123458")


def test_unknown_article_zero_or_status(spark, stock):
    asked = spark.createDataFrame([("APPLE001",), ("香蕉",), ("NONE",)], "sku string")
    zero = {r["skuCode"]: tuple(r)[1:] for r in inventory.requested_availability(asked, stock).collect()}
    assert zero == {"APPLE001": ("红富士苹果", 100, 20, 80), "香蕉": ("香蕉", 200, 30, 170), "NONE": ("NONE", 0, 0, 0)}
    status = {r["skuCode"]: r["status"] for r in inventory.requested_availability(asked, stock, "status").collect()}
    assert status == {"APPLE001": "FOUND", "香蕉": "FOUND", "NONE": "NO_SKU"}
    good = inventory.requested_availability(asked, stock, qualities=["合格"]).filter("skuCode = 'APPLE001'").first()
    assert good["availableQty"] == 40


def test_bin_status(spark, physical):
    asked = spark.createDataFrame(
        [("APPLE001", "L-01-05"), ("APPLE001", "X"), ("APPLE001", None), ("NONE", "X")], "sku string, bin string"
    )
    got = {(r["sku"], r["bin"]): (r["status"], r["n_rows"]) for r in inventory.bin_status(asked, physical).collect()}
    assert got == {("APPLE001", "L-01-05"): ("FOUND", 1), ("APPLE001", "X"): ("NO_BIN", 0),
                   ("APPLE001", None): ("FOUND", 2), ("NONE", "X"): ("NO_SKU", 0)}


def test_one_failing_line_rejects_the_order(spark, stock):
    lines = spark.createDataFrame(
        [(1, "APPLE001", 60), (1, "APPLE001", 30), (2, "BANANA001", 170), (3, "BANANA001", 1), (3, "NONE", 1)],
        "order_id int, sku string, qty int",
    )
    got = {r["order_id"]: r["accepted"] for r in inventory.order_feasibility(lines, inventory.availability(stock)).collect()}
    assert got == {1: False, 2: True, 3: False}


def test_quality_names_and_arguments(spark):
    df = spark.createDataFrame([("合格",), ("odd",), ("",), (None,)], "q string")
    assert [r[0] for r in df.select(normalize_quality(F.col("q"))).collect()] == ["GENIUNE", "odd", None, None]
    args = spark.createDataFrame([(" a , b ",), ("a",), ("a,",)], "t string")
    assert [tuple(r[0]) for r in args.select(split_sku_argument(F.col("t"))).collect()] == [
        ("a", "b"), ("a", None), ("a", None)]


def test_table_functions(spark, physical, stock):
    physical.createOrReplaceTempView("t_physical")
    stock.createOrReplaceTempView("t_overview")
    inventory.register_table_functions(spark, "t_overview", "t_physical", "t_")
    assert tuple(spark.sql("SELECT * FROM t_sku_overview('NONE')").first()) == ("NONE", "NONE", 0, 0, 0)
    assert spark.sql("SELECT * FROM t_sku_bins('APPLE001')").count() == 2
    assert spark.sql("SELECT * FROM t_sku_bins('APPLE001', 'L-01-05')").count() == 1
    assert spark.sql("SELECT * FROM t_stock_overview(grade => 'GENIUNE')").count() == 2


def test_left_lookup_fans_out_and_matches_nulls_on_request(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, v string")
    plain = sorted((tuple(r) for r in joins.left_lookup(left, right, "k", ["v"]).collect()), key=str)
    assert plain == [(1, "a"), (1, "b"), (2, None), (None, None)]
    safe = {tuple(r) for r in joins.left_lookup(left, right, "k", ["v"], null_safe=True).collect()}
    assert (None, "n") in safe


def test_a_hot_article_is_split_by_the_adaptive_join(spark, request):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    request.addfinalizer(lambda: [spark.conf.set(k, v) if v else spark.conf.unset(k) for k, v in before.items()])
    for key, value in settings.items():
        spark.conf.set(key, value)
    hot = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id")))
    lines = spark.range(0, 200_000, 1, 16).select(F.xxhash64("id").alias("order_id"), hot.alias("sku"), F.lit(1).alias("qty"))
    free = spark.range(1, 200_000, 2).select(F.concat(F.lit("s"), F.col("id")).alias("skuCode"), F.lit(5).alias("availableQty"))
    joined = inventory.order_lines_status(lines, free).select("order_id", "line_ok", F.spark_partition_id().alias("task")).toPandas()
    assert len(joined) == 200_000 and joined["line_ok"].sum() == 100_000
    assert joined["task"].value_counts().max() < 30_000


def test_interval_lookup_equals_brute_force(spark):
    spans = [(d, s, s + 37, s // 37) for d in (1, 2) for s in range(0, 370, 37)]
    points = [(d, p) for d in (1, 2, 3) for p in range(0, 400, 11)]
    intervals = spark.createDataFrame(spans, "d int, a int, b int, page int")
    asked = spark.createDataFrame(points, "d int, p int")
    got = {(r["d"], r["p"]): r["page"]
           for r in joins.interval_lookup(asked, intervals, ["d"], "p", "a", "b", 50, "left").collect()}
    for d, p in points:
        hit = [page for dd, a, b, page in spans if dd == d and a <= p < b]
        assert got[d, p] == (hit[0] if hit else None)
