"""Packing: the best boundaries against all choices, and what batches must satisfy."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemill.llm import packing


def test_bounds_are_the_best():
    draw = random.Random(1)
    for _ in range(150):
        lengths = sorted(draw.sample(range(30), draw.randint(1, 9)))
        counts = [draw.randint(1, 20) for _ in lengths]
        buckets = draw.randint(1, 5)

        def padding(bounds, lengths=lengths, counts=counts):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))
        choices = [(*c, lengths[-1]) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k)]
        found = packing.best_bounds(np.array(lengths), np.array(counts), buckets)
        assert len(found) <= buckets and padding(found) == min(map(padding, choices))


def check(rows, texts, max_length, buckets, budget):
    spans, batches = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.piece, r.first_token, r.n_tokens))
        batches[r.batch_id].append(r)
    for doc_id, text in texts.items():
        total = sum(-(-len(w) // 8) for w in (text or "").encode().split())
        ends = [(i, i * max_length, min(max_length, total - i * max_length)) for i in range(max(1, -(-total // max_length)))]
        assert sorted(spans[doc_id]) == ends
    assert sorted(batches) == list(range(len(batches)))
    assert len({r.bucket for r in rows}) <= buckets
    for held in batches.values():
        assert len({(r.bucket, r.padded_length) for r in held}) == 1
        assert sorted(r.slot for r in held) == list(range(len(held)))
        assert len(held) == 1 or sum(r.padded_length for r in held) <= budget
        assert all(r.n_tokens <= r.padded_length for r in held)
    by_bucket = defaultdict(list)
    for held in batches.values():
        by_bucket[held[0].bucket].append(len(held))
    for sizes in by_bucket.values():  # all but the last batch of a bucket are full
        assert len(set(sizes)) <= 2 and sorted(sizes)[1:] == [max(sizes)] * (len(sizes) - 1)


def test_batches(spark):
    draw = random.Random(3)
    texts = {i: " ".join("w" for _ in range(draw.choice([0, 1, 3, 10, 25, 60]))) for i in range(150)}
    texts |= {900: None, 901: "", None: "a b", 902: "w " * 50_000, 903: "字" * 999, 904: "x" * 17 + " y"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"piece": F.lit(1), "index": F.lit(2)})
    check(packing.pack(docs, 20, 4, 100).collect(), texts, 20, 4, 100)


def test_query(spark, small):
    texts = dict(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()))
    check(packing.op6_packing(spark, small).collect(), texts, packing.MAX_LENGTH, packing.BUCKETS, packing.TOKEN_BUDGET)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted(r.slot for r in packing.pack(docs).collect()) == [0, 1]
    assert packing.pack(docs.limit(0)).collect() == []
