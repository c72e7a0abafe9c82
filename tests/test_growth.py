"""Steps whose tables and memory must not grow faster than their input."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.functions.splitting import SEPARATORS, chunks_of
from tidemill.operators import chunking, corpus, vectors, wordvectors
from tidemill.session import written


@pytest.fixture
def rows_written(monkeypatch):
    """The numbers of rows of the tables that a module writes, by name."""
    seen = {}

    def watch(module):
        def noted(df, name):
            table = written(df, name)
            seen[name] = max(seen.get(name, 0), table.count())
            return table

        monkeypatch.setattr(module, "written", noted)
        return seen

    return watch


def test_cosine_search_writes_no_row_for_a_pair(spark, rows_written):
    """One term in every document: each query meets each document."""
    raw = {d: {"all": 1.0, f"t{d % 7}": 1 + d % 5, f"u{d % 11}": 2.0} for d in range(300)}
    data = {d: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for d, v in raw.items()}
    weights = spark.createDataFrame([(d, t, w) for d, v in data.items() for t, w in v.items()], "d bigint, term string, weight double")
    seen = rows_written(corpus)
    found = corpus.cosine_topk(weights, weights.select("d"), "d", 5).collect()
    assert max(seen.values()) <= weights.count()
    for q in (0, 5, 299):
        scores = sorted((-round(sum(w * data[q].get(t, 0) for t, w in v.items()), 9), d) for d, v in data.items() if d != q)[:5]
        assert [r.d for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])] == [d for _, d in scores]


@pytest.mark.parametrize("rows", [1, 3])
def test_cosine_search_in_blocks_of_any_size(spark, monkeypatch, rows):
    monkeypatch.setattr(corpus, "BLOCK_TERMS", 2)
    monkeypatch.setattr(corpus, "BLOCK_ROWS", rows)
    weights = spark.createDataFrame([(d, f"t{t}", 0.5) for d in range(8) for t in range(d, d + 4)], "d bigint, term string, weight double")
    found = corpus.cosine_topk(weights, spark.createDataFrame([(0,)], "d bigint"), "d", 10).collect()
    assert [(r.d, r.cosine) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 0.75), (2, 0.5), (3, 0.25)]


@pytest.mark.parametrize(("share", "held"), [(1e-9, 1 << 17), (2.0, 1), (2.0, 1 << 17), (1 / 200, 50)])
def test_products_of_blocks(monkeypatch, share, held):
    """Rare terms are no columns of a matrix of all vectors; the result is the same whichever way a term goes."""
    monkeypatch.setattr(corpus, "FULL_SHARE", share)
    monkeypatch.setattr(corpus, "HITS_HELD", held)
    draw = np.random.default_rng(4)
    columns = []
    keep = corpus.dense
    monkeypatch.setattr(corpus, "dense", lambda block, at: (columns.append(len(at)), keep(block, at))[1])

    def block(n, first):
        rows = np.where(draw.random((n, 500)) < np.where(np.arange(500) < 5, 0.9, 0.01), draw.random((n, 500)), 0.0)
        rows[0] = 0.0
        terms, owners = np.nonzero(rows.T)
        held_terms, starts = np.unique(terms, return_index=True)
        return rows, (np.arange(first, first + n), held_terms, np.append(starts, len(terms)), owners, rows.T[terms, owners])

    (a, one), (b, two) = block(60, 0), block(80, 60)
    found = corpus.block_products(one, two)
    assert np.allclose(found, a @ b.T) and ((found == 0) == (a @ b.T == 0)).all()
    assert sum(columns) == {1e-9: 2 * len(np.intersect1d(one[1], two[1])), 2.0: 0, 1 / 200: 10}[share]
    for k in (1, 7, 80, 100):
        assert ((found >= corpus.kth_reached(found, k)[:, None]).sum(axis=1) >= min(k, 80)).all()


def test_only_grams_of_frequent_words_are_counted(spark):
    """Rare words and what holds them end in their task; lists of words serve like texts."""
    texts = [(d, f"common words always r{d} x{d} y{d} z{d} common words") for d in range(50)] + [(50, None), (51, "")]
    df = spark.createDataFrame(texts, "d bigint, text string")
    lists = corpus.word_lists(df, "text", "d")
    pairs = corpus.gram_documents(lists, ["always", "common", "words"], []).collect()
    assert {(r.code, r.df) for r in pairs} == {(0 * 3 + 1, 0), (1 * 3 + 2, 50), (2 * 3 + 0, 50)} - {(1, 0)}
    terms = corpus.fit_terms(lists, "words", min_share=0.5)
    assert sorted(r.term for r in terms.collect()) == ["always", "common", "common words", "common words always", "words", "words always"]
    found = {(r.d, r.term): r.weight for r in corpus.tfidf(lists, "d", "words", terms).collect()}
    assert found == {(r.d, r.term): r.weight for r in corpus.tfidf(df, "d", "text", terms).collect()}
    assert len(found) == 300


def test_blocks_of_vectors_are_full(spark):
    """However many tasks read the vectors, a cell is as few blocks as it can be."""
    rows = spark.range(0, 600, 1, 12).select("id", F.array(F.col("id") % 3 * 10.0, F.lit(1.0)).alias("vector"))
    pivots = np.array([[0.0, 1.0], [10.0, 1.0], [20.0, 1.0]])
    blocks = vectors.cells_of(rows, pivots, "l2").select("cell", F.size("ids").alias("n")).collect()
    # A border between two ranges may cut a cell.
    assert len(blocks) <= 3 + blocks_cut(spark) and sum(r.n for r in blocks) == 600


def blocks_cut(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions")) - 1


def test_chunks_leave_memory_as_they_are_made(monkeypatch):
    monkeypatch.setattr(chunking, "CHUNK_BATCH", 5000)
    texts = [None, "", "a b " * 900, "x" * 2500, "one. two " * 700] * 6
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(texts)], ["d", "whole"])
    made = list(chunking.chunk_batches(batch, 1000, 200, SEPARATORS))
    assert len(made) > 6 and all(sum(map(len, b.column(3).to_pylist())) < 5000 + 10_000 for b in made)
    found = [tuple(r.values()) for b in made for r in b.to_pylist()]
    assert found == [(i, n, c["start"], c["text"]) for i, t in enumerate(texts) for n, c in enumerate(chunks_of(t))]


def test_only_frequent_words_make_pairs(spark, monkeypatch):
    """What is counted and shuffled for pairs grows with the frequent words; rare ones keep their places."""
    counted = []
    keep = wordvectors.pair_counts

    def noted(located, window):
        found = keep(located, window)
        counted.append(found.count())
        return found

    monkeypatch.setattr(wordvectors, "pair_counts", noted)
    df = spark.createDataFrame([(["a", f"r{i}", "b", "b", f"x{i}", f"y{i}", "a"],) for i in range(40)] + [(None,), ([],)], "t array<string>")
    found = {(r.word, r.context): r.n for r in wordvectors.cooccurrences(df, "t", 3, 2).collect()}
    assert found == {("a", "b"): 120, ("b", "a"): 120, ("b", "b"): 80} | {("a", "b"): 40 * 3, ("b", "a"): 40 * 3}
    assert counted == [2]
