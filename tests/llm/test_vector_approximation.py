"""Search over approximations against all products."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.llm import vector_approximation as va

NAN, INF = float("nan"), float("inf")


def plain(rows, k, every):
    whole = [(i, n, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for i, n, q in whole:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0)
                        for j, m, v in whole if m != n and len(v) == len(q))
        found += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k])]
    return sorted(found, key=str)


def table(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return docs.withColumn("v", F.lit("x")).withColumn("row", F.lit(1)).withColumn("gid", F.lit(None).cast("int"))


def rows_of(n, seed=1, dims=6):
    draw = random.Random(seed)
    centre = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + draw.gauss(0, 0.2) for c in draw.choice(centre)]) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same) for i in range(n // 2)]  # a third of all are one vector
    rows += [(0, rows[7][1]), (None, same), (None, rows[5][1]), (5000, None), (5005, [NAN] * dims), (5010, [0.0, None] * 3),
             (5015, [INF] * dims), (5020, []), (5025, []), (5030, [1.0, 2.0]), (5035, [0.0] * dims), (5040, [1e3] * dims),
             (5045, [-1e9] + [0.0] * (dims - 1))]
    return rows


@pytest.mark.parametrize(("cells", "rows", "queries", "field"), [(64, 2048, 512, 64), (4, 7, 3, 2)])
def test_against_all_products(spark, monkeypatch, cells, rows, queries, field):
    for name, value in {"CELLS": cells, "ROWS": rows, "QUERIES_AT_ONCE": queries, "FIELD": field}.items():
        monkeypatch.setattr(va, name, value)
    data = rows_of(60)
    found = va.search(table(spark, data), F.col("vec_id") % 5 == 0, 4).collect()
    assert sorted(map(tuple, found), key=str) == plain(data, 4, 5)


def test_few_exact_vectors_are_read(spark, monkeypatch):
    read = []
    keep = va.read_in_order

    def counted(found, entries, k):
        read.append(found.count())
        return keep(found, entries, k)

    monkeypatch.setattr(va, "read_in_order", counted)
    draw = random.Random(2)
    data = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(1500)]
    found = va.search(table(spark, data), F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(map(tuple, found), key=str) == plain(data, 5, 50)
    assert read[0] < 0.05 * 30 * 1500


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (50, [3.0, -1.0])]
    found = va.search(table(spark, rows), F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, 5, 50)
    assert va.search(table(spark, rows[:1]), F.col("vec_id") % 50 == 0).collect() == []
    assert va.search(table(spark, rows).limit(0), F.col("vec_id") % 50 == 0).collect() == []
