"""Word vectors from counts: counts by hand, the decomposition against numpy, planted synonyms."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from tidemill.operators import wordvectors as wv
from tidemill.operators.vectors import nearest_or_unknown


def texts():
    draw = random.Random(5)
    topics = {"pet": ["cat", "feline"], "car": ["automobile", "vehicle"], "food": ["bread", "loaf"]}
    around = {t: [f"{t}{i}" for i in range(8)] for t in topics}
    rows = []
    for _ in range(400):
        topic = draw.choice(list(topics))
        rows.append([draw.choice(around[topic]) if draw.random() < 0.75 else draw.choice(topics[topic]) for _ in range(12)])
    return rows + [[], ["alone"], ["rare", "cat"], None]


@pytest.fixture(scope="module")
def counts(spark):
    return wv.cooccurrences(spark.createDataFrame([(t, 1) for t in texts()], "t array<string>, word int"), "t", 3, 2)


def test_counts_and_weights(counts):
    often = {w for w, n in Counter(w for t in texts() if t for w in t).items() if n >= 2}
    expected = Counter()
    for t in filter(None, texts()):
        for i, a in enumerate(t):
            for b in t[i + 1: i + 4]:
                if a in often and b in often:
                    expected[a, b] += 1
                    expected[b, a] += 1
    assert {(r.word, r.context): r.n for r in counts.collect()} == dict(expected)
    sums, total = Counter(), sum(expected.values())
    for (a, _), n in expected.items():
        sums[a] += n
    weights = {k: math.log(n * total / sums[k[0]] / sums[k[1]]) for k, n in expected.items()}
    found = {(r.word, r.context): r.ppmi for r in wv.positive_association(counts).collect()}
    assert found == pytest.approx({k: w for k, w in weights.items() if w > 0})


def test_decomposition(counts):
    table = wv.positive_association(counts)
    rows = table.collect()
    words = sorted({r.word for r in rows})
    matrix = np.zeros((len(words), len(words)))
    for r in rows:
        matrix[words.index(r.word), words.index(r.context)] = r.ppmi
    found = {r.word: r.vector for r in wv.svd_vectors(table, dimension=6, more=10).collect()}
    vectors = np.array([found[w] for w in words])
    values, basis = np.linalg.eigh(matrix)
    main = np.argsort(-np.abs(values))[:6]
    expected = (basis[:, main] * np.abs(values[main])) @ basis[:, main].T
    assert np.abs(vectors @ vectors.T - expected).max() < 0.05 * np.abs(expected).max()


@pytest.mark.parametrize("cell", [40, 1 << 19])
def test_products_of_cells(spark, counts, monkeypatch, cell):
    monkeypatch.setattr(wv, "CELL", cell)
    monkeypatch.setattr(wv, "STEP", 7)
    table = wv.positive_association(counts)
    numbered, cells, width = wv.grid(table)
    number = {r.word: r.number for r in numbered.collect()}
    assert sorted(number.values()) == list(range(len(number)))
    n_blocks = -(-len(number) // width)
    assert cells.count() <= n_blocks * (n_blocks + 1) // 2 and (n_blocks > 1) == (cell == 40)
    matrix = np.zeros((len(number), len(number)))
    for r in table.collect():
        matrix[number[r.word], number[r.context]] = r.ppmi
    rows = np.random.default_rng(3).normal(size=(len(number), 3))
    given = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "number long, row array<double>")
    found = {r.number: r.row for r in wv.applied(cells, given, width, 3).collect()}
    assert np.allclose([found[i] for i in range(len(rows))], matrix @ rows)


def test_numbers_stand_for_words(spark, counts, monkeypatch):
    """Pairs as numbers, once each and met as arrays, give the same counts, weights and vectors as pairs of words."""
    expected = {(r.word, r.context): r.n for r in counts.collect()}
    table = wv.positive_association(counts)
    weights = {(r.word, r.context): r.ppmi for r in table.collect()}
    vectors = {r.word: r.vector for r in wv.svd_vectors(table, dimension=6, more=20).collect()}
    # Few words are kept by the tasks, arrays are short and cells small; one frequent word is in no pair.
    for name, few in (("HELD_WORDS", 5), ("PAIRS_HELD", 50), ("BUCKETS", 16), ("WEIGHTS_HELD", 100), ("CELL", 40)):
        monkeypatch.setattr(wv, name, few)
    times = Counter(w for t in texts() if t for w in t) | {"never near": 9}
    often = wv.often_words(spark.createDataFrame(list(times.items()), "word string, times long"), 2)
    name = {r.number: r.word for r in often.collect()}
    assert sorted(name) == list(range(len(name))) and set(name.values()) == {w for w, n in times.items() if n >= 2}
    pairs = wv.cooccurrences(spark.createDataFrame([(t,) for t in texts()], "t array<string>"), "t", 3, 2, often)
    found = {(r.word, r.context): r.n for r in pairs.collect()}
    assert len(found) == pairs.count() and all(a <= b for a, b in found)
    assert {(name[i], name[j]): n for a, b in found for n in [found[a, b]] for i, j in ((a, b), (b, a))} == expected
    weighed = wv.positive_association(pairs, once=True)
    assert {(name[i], name[j]): r.ppmi for r in weighed.collect() for i, j in ((r.word, r.context), (r.context, r.word))} == pytest.approx(weights)
    placed = {r.word: r.vector for r in wv.svd_vectors(weighed, dimension=6, more=20, often=often).collect()}
    assert placed.keys() == vectors.keys()
    words = sorted(vectors)
    one, other = (np.array([x[w] for w in words]) for x in (vectors, placed))
    assert np.allclose(one @ one.T, other @ other.T, atol=1e-6 * np.abs(one @ one.T).max())


def test_no_row_is_shuffled_for_a_pair(spark):
    """Counts of pairs meet as arrays: a row for each part and task is shuffled, and Spark keeps no entry for a pair."""
    lists = spark.createDataFrame([(list(range(i, i + 3000)),) for i in range(2)], "words array<int>").coalesce(1)
    pairs = wv.pair_counts(lists, 5)
    assert pairs.count() == 5 * 3001 - 15
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and "hashpartitioning(code" not in plan and "Aggregate" not in plan


def test_planted_synonyms_are_neighbours(spark, counts):
    vectors = wv.svd_vectors(wv.positive_association(counts), dimension=8)
    names = {r.word: i for i, r in enumerate(vectors.select("word").orderBy("word").collect())}
    numbered = spark.createDataFrame(list(names.items()), "word string, vec_id long")
    known = vectors.join(numbered, "word").withColumnRenamed("vector", "embedding")
    pairs = {"cat": "feline", "automobile": "vehicle", "bread": "loaf"}
    asked = spark.createDataFrame([(names[w],) for w in pairs], "vec_id long")
    back = {i: w for w, i in names.items()}
    topic = {"cat": "pet", "automobile": "car", "bread": "food"}
    for r in nearest_or_unknown(asked, known, 5).collect():
        word, near = back[r.query_id], back[r.id]
        assert near == pairs[word] or near.startswith(topic[word])


def test_no_words(spark):
    none = wv.cooccurrences(spark.createDataFrame([([],)], "t array<string>"), "t")
    assert wv.svd_vectors(wv.positive_association(none)).collect() == []
