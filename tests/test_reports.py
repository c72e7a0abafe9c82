"""Aggregates and windows on frames with gaps, ties and zeros."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregates as agg
from tidemill.operators import distribution, frames, windows

DAY = [dt.date(2024, 1, d) for d in range(1, 31)]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", None), (None, 5.0), ("b", 2.5), ("b", 3.5), ("c", None)], "k string, v double"
    )


def test_missing_keys_form_no_group(gaps):
    assert rows(agg.frequency_table(gaps, "k")) == [("a", 2), ("b", 2), ("c", 1)]


def test_mean_counts_known_values_and_rounds_half_to_even(spark, gaps):
    assert sorted(rows(agg.mean_and_count(gaps, ["k"], "v"))) == [("a", 1.0, 1), ("b", 3.0, 2), ("c", None, 0)]
    halves = spark.createDataFrame([("x", 0.125), ("y", 0.375)], "k string, v double")
    assert sorted(rows(agg.mean_and_count(halves, ["k"], "v"))) == [("x", 0.12, 1), ("y", 0.38, 1)]


def test_deviation_of_one_row_is_missing(gaps):
    assert sorted(rows(agg.mean_and_std(gaps, ["k"], "v"))) == [("a", 1.0, None), ("b", 3.0, 0.71), ("c", None, None)]


def test_first_known_attribute_follows_the_order(spark):
    df = spark.createDataFrame([("a", 3, 10, 1), ("a", 1, None, 1), ("a", 2, 20, 1)], "k string, d int, p int, n int")
    assert rows(agg.total_with_attribute(df, "k", ["n"], "p", "d")) == [("a", 3, 20)]


def test_moving_average_needs_all_rows(spark):
    df = spark.createDataFrame([(DAY[i], i) for i in range(8)], "d date, v int")
    got = {r["d"]: r["moving_avg"] for r in windows.moving_average(df, "d", "v").collect()}
    assert [got[d] for d in DAY[:6]] == [None] * 6
    assert got[DAY[6]] == 3.0 and got[DAY[7]] == 4.0


def test_growth_after_zero_is_missing(spark):
    df = spark.createDataFrame([(DAY[0], 4), (DAY[1], 0), (DAY[2], 5), (DAY[3], 10)], "d date, v int")
    assert [r["growth_pct"] for r in windows.growth_rate(df, "d", "v").orderBy("d").collect()] == [None, -100.0, None, 100.0]


def test_every_kth_and_last_rows(spark):
    df = spark.createDataFrame([(d, i) for i, d in enumerate(DAY)], "d date, v int")
    assert [r["v"] for r in windows.every_kth(df, "d", 7).orderBy("d").collect()] == [0, 7, 14, 21, 28]
    assert [r["v"] for r in windows.last_rows(df, "d", 2).collect()] == [29, 28]


def test_kpi_summary_of_few_days(spark):
    df = spark.createDataFrame([(DAY[0], 1, 5), (DAY[1], 2, 9)], "d date, v int, c int")
    got = agg.kpi_summary(df, "d", "v", "c").first().asDict()
    assert got == {"total": 3, "latest_level": 9, "daily_mean": 1.5, "n_days": 2, "last_total": 3,
                   "last_daily_mean": 1.5, "last_days": 2}


def test_small_shares_fold_and_nothing_to_fold(spark):
    df = spark.createDataFrame([("a", 97), ("b", 2), ("c", 1), ("d", 0)], "k string, v int")
    folded = {r["k"]: (r["v"], r["n_members"]) for r in agg.fold_small_shares(df, "k", "v", 2).collect()}
    assert folded == {"a": (97, 1), "b": (2, 1), "other": (1, 1)}
    even = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    assert {r["k"] for r in agg.fold_small_shares(even, "k", "v", 2).collect()} == {"a", "b"}


def test_dynamic_pivot_means_and_gaps(spark):
    df = spark.createDataFrame([("m1", "x", 2.0), ("m1", "x", 4.0), ("m2", "y", 1.0)], "m string, c string, v double")
    got = agg.dynamic_pivot(df).orderBy("m")
    assert got.columns == ["m", "v_x", "v_y"]
    assert rows(got) == [("m1", 3.0, 0.0), ("m2", 0.0, 1.0)]
    assert rows(agg.means_by_header(df).orderBy("m")) == [("m1", "x", 3.0), ("m2", "y", 1.0)]


def test_pivots_take_every_header_found(spark):
    df = spark.createDataFrame([("a", f"{y}-{m:02d}", 1) for y in range(1980, 2040) for m in range(1, 13)] + [("b", "1980-01", 2)],
                               "k string, month string, v int")
    got = agg.pivot_table(df, ["k"], "month", agg.F.sum("v"), fill=0)
    assert len(got.columns) == 1 + 60 * 12
    assert {r["k"]: (r["1980-01"], r["2039-12"]) for r in got.collect()} == {"a": (1, 1), "b": (2, 0)}
    wide = agg.dynamic_pivot(spark.createDataFrame([("k", f"h{i}", 1.0) for i in range(600)], "k string, h string, v double"))
    assert len(wide.columns) == 601


def test_stacked_base(spark):
    df = spark.createDataFrame([("m", "a", 1), ("m", "b", 2), ("m", "c", 3)], "m string, s string, v int")
    assert [r["base"] for r in windows.stacked_base(df, "m", "s", "v").orderBy("s").collect()] == [0, 1, 3]


def test_extremes_keep_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "k string, v int")
    got = {r["k"]: (r["is_highest"], r["is_lowest"]) for r in agg.with_extremes(df, "v").collect()}
    assert got == {"a": (False, True), "b": (True, False), "c": (True, False)}


def test_snapshot_fill_and_validation(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (2, 4.0)], "d int, v double")
    assert frames.latest_snapshot(df, "d").count() == 2
    assert sorted(rows(frames.fill_with_mean(df, "v"))) == [(1, 2.0), (2, 3.0), (2, 4.0)]
    checked = frames.split_valid(df, {"no_v": F.col("v").isNotNull(), "small": F.col("v") > 3})
    assert sorted(rows(checked), key=str) == [(1, 2.0, "small"), (2, 4.0, None), (2, None, "no_v")]


def test_appended_row_lacks_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "k string, v int, w double")
    extra = spark.createDataFrame([("other", 3)], "k string, v int")
    assert sorted(rows(frames.append_partial(df, extra))) == [("a", 1, 2.0), ("other", 3, None)]


def test_column_kinds(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "k string, v int, w double")
    assert frames.numeric_columns(df) == ["v", "w"] and frames.text_columns(df) == ["k"]
    assert [r["column_name"] for r in frames.describe_columns(df).collect()] == ["k", "v", "w"]


def test_empty_input_keeps_the_schema(spark):
    empty = spark.createDataFrame([], "d date, v int")
    assert windows.moving_average(empty, "d", "v").columns == ["d", "v", "moving_avg"]
    assert distribution.exact_quantiles(empty, ["d"], "v").collect() == []
    profile = distribution.column_profile(empty, ["v"]).first()
    assert (profile["column_name"], profile["n_values"], profile["median"]) == ("v", 0, None)


def quantile(values, p):
    values = sorted(values)
    place = p * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_quantiles_of_a_hot_group_are_exact(spark, request, coalesced):
    """One group with most rows spread over ranges, one value with a third of them."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    request.addfinalizer(lambda: spark.conf.unset(setting))
    spark.conf.set(setting, coalesced)
    draw = random.Random(7)
    data = [("hot", round(draw.lognormvariate(0, 2), 3) if i % 3 else 1.0) for i in range(6000)]
    data += [("small", float(i)) for i in range(4)] + [("one", 7.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r for r in distribution.exact_quantiles(df, ["k"], "v").collect()}
    for key in ("hot", "small", "one"):
        values = [v for k, v in data if k == key]
        for p, name in zip((0.25, 0.5, 0.75), ("q1", "median", "q3")):
            assert got[key][name] == pytest.approx(quantile(values, p), abs=1e-9), (key, name)
        assert got[key]["n"] == len(values)
    assert got["hot"]["std"] == pytest.approx(statistics.stdev(v for k, v in data if k == "hot"))


def test_box_plot_whiskers_and_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [(None, 1.0)], "k string, v double")
    box = distribution.box_plot(df, ["k"], "v").first().asDict()
    assert (box["low_whisker"], box["high_whisker"], box["n_outliers"], box["median"]) == (1.0, 4.0, 1, 3.0)
    assert rows(distribution.box_plot_outliers(df, ["k"], "v")) == [("a", 100.0)]
