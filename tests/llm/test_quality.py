"""Quality classifier: held-out accuracy, exact votes, edge cases."""

from __future__ import annotations

import binascii

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import quality
from tidemill.llm.common import identified, text_bytes


@pytest.fixture(scope="module")
def model(spark, small):
    return quality.fitted(spark, spark.read.parquet(f"{small}/documents.parquet"), small)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = quality.op10_quality(spark, folder).collect()
    for row in found:
        assert row.held_out == (binascii.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert row.predicted == int(row.score >= 0.5) and 0 <= row.score <= 1
    unseen = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in unseen]) > 0.95
    assert np.mean([p for p, y in unseen if y]) > 0.97


def test_only_allowed_labels_are_read(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    ids = {r.doc_id for r in quality.learnable(labels).collect()}
    assert {i for i in range(60) if binascii.crc32(str(i).encode()) % 3 != 1} == ids - {None}


def test_votes(model):
    texts = ["plain words of a text", "", "WORDS!! WORDS!! WORDS!!", "a" * 5000]
    counts = quality.features(*text_bytes(pa.array(texts)))
    placed = quality.unit(quality.weighted(counts, model.rarity) @ model.directions)
    for vector, score in zip(placed, model.scores(counts), strict=True):
        likeness = np.round(model.vectors @ vector, 9)
        best = sorted(range(len(likeness)), key=lambda i: (-likeness[i], i))[: model.neighbours]
        weight = np.maximum(likeness[best], 0) ** 4
        expected = (weight @ model.labels[best] + quality.PRIOR_WEIGHT * model.prior) / (weight.sum() + quality.PRIOR_WEIGHT)
        assert abs(score - expected) < 2e-6


def test_features_of_blocks_and_batches(monkeypatch):
    texts = ["one two two one two " * 50, "", "x", "É1!" * 40]
    whole = quality.features(*text_bytes(pa.array(texts)))
    monkeypatch.setattr(quality, "BLOCK", 64)
    assert np.array_equal(quality.run_counts(*text_bytes(pa.array(texts)), 3, 7), whole[:, : quality.HALF])
    for i, text in enumerate(texts):
        monkeypatch.setattr(quality, "BLOCK", 1 << 20)
        assert np.array_equal(quality.features(*text_bytes(pa.array([text])))[0], whole[i])


def test_edge_rows(spark, model):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "words " * 40_000), (2, "same"), (2, "same")], "doc_id long, text string")
    docs = docs.withColumns({"score": F.lit("x"), "n_chars": F.lit(1)})
    found = quality.score(docs, model).collect()
    assert len(found) == 5 and len({r.score for r in found if r.doc_id == 1}) == 1
    assert len({r.score for r in found if r.doc_id == 2}) == 1
    assert quality.score(docs.limit(0), model).collect() == []


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    assert quality.fit(docs, none).scores(np.zeros((1, quality.WIDTH))).tolist() == [0.5]
    ones = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, ones)).collect()} == {1.0}


def test_rarity_counts_all_documents(spark):
    texts = ["plain words here", "other words there"] * 3 + ["zzz 123"] * 40 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    having = (quality.features(*text_bytes(pa.array([t or "" for t in texts]))) > 0).sum(axis=0)
    expected = np.log((1 + len(texts)) / (1 + having)) + 0.1
    assert np.array_equal(quality.fit(identified(docs), labels).rarity, expected)
