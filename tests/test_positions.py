"""Positions, batches, splits and running sums against plain Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill.functions.values import hash_order
from tidemill.operators import windows


@pytest.mark.parametrize("partitions", [None, 7])
def test_ordered_index_equals_sorting(spark, partitions):
    data = [((i * 7919) % 1000, f"w{i % 13}") for i in range(1000)]
    df = spark.createDataFrame(data, "k int, w string").repartition(5)
    got = windows.ordered_index(df, F.desc("w"), F.col("k"), partitions=partitions).collect()
    expected = sorted(data, key=lambda r: (r[1], -r[0]), reverse=True)
    assert [(r["k"], r["w"]) for r in sorted(got, key=lambda r: r["index"])] == expected
    assert sorted(r["index"] for r in got) == list(range(1000))


def test_last_batch_is_short(spark):
    sizes = windows.batch_ids(spark.range(10), ["id"], 4).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in sizes] == [(0, 4), (1, 4), (2, 2)]


def test_cyclic_batches_start_over(spark):
    got = windows.cyclic_batches(spark.range(15).withColumnRenamed("id", "k"), ["k"], 6, 5, "k").collect()
    placed = {(r["batch_id"], r["slot"]): r["k"] for r in got}
    assert [placed[divmod(i, 6)] for i in range(30)] == [i % 15 for i in range(30)]


def test_shuffled_batches_keep_their_rows(spark):
    rows = spark.range(15).withColumnRenamed("id", "k")
    plain = windows.cyclic_batches(rows, ["k"], 6, 5, "k")
    mixed = windows.cyclic_batches(rows, ["k"], 6, 5, "k", shuffle_seed=100)
    contents = lambda df: sorted((r["batch_id"], r["k"]) for r in df.collect())
    assert contents(plain) == contents(mixed)
    assert sorted(r["slot"] for r in mixed.filter("batch_id = 0").collect()) == list(range(6))


def test_split_is_exact_and_repeatable(spark):
    rows = spark.range(99).withColumnRenamed("id", "k")
    one = {r["k"]: r["split"] for r in windows.split_exact(rows, "k", 0.6).collect()}
    two = {r["k"]: r["split"] for r in windows.split_exact(rows.repartition(7), "k", 0.6).collect()}
    assert one == two and list(one.values()).count("train") == 59


def test_hash_order_depends_on_the_seed(spark):
    r = spark.range(1).select(hash_order(F.col("id"), 1).alias("a"), hash_order(F.col("id"), 2).alias("b")).first()
    assert r["a"] != r["b"] and 0 <= r["a"] < 2**32


def test_running_total_over_blocks_of_a_hot_group(spark):
    data = [("hot", i, i % 3) for i in range(500)] + [("b", 2, 5)]
    df = spark.createDataFrame(data, "g string, p int, v int").repartition(6)
    got = {(r["g"], r["p"]): r["total"]
           for r in windows.running_total(df, "g", "p", F.col("v"), block=16, name="total").collect()}
    total = 0
    for i in range(500):
        total += i % 3
        assert got["hot", i] == total
    assert got["b", 2] == 5


def test_top_k_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    best = windows.top_k(df, ["g"], [F.desc("v")], 2)
    assert sorted(tuple(r) for r in best.select("g", "v").collect()) == [(0, 96), (0, 98), (1, 97), (1, 99)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
