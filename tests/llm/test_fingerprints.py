"""Fingerprints: every step against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import fingerprints


def sample():
    draw = random.Random(2)
    texts = [bytes(draw.choice(b"abcdefgh  ") for _ in range(draw.choice([0, 3, 63, 64, 65, 80, 300, 900]))) for _ in range(30)]
    return [*texts, b"a" * 500, draw.randbytes(3000)]


def plain_class(window):
    total = int(sum(fingerprints.TERMS[c] for c in Counter(window).values()))
    return int(float(fingerprints.LARGEST - total) * ((fingerprints.CLASSES - 1) / fingerprints.LARGEST))


def plain_places(text, ranks):
    rank = [int(ranks[plain_class(text[i: i + 64])]) for i in range(len(text) - 63)]
    popular = Counter()
    for start in range(-63, len(rank)):
        inside = [(rank[i], i) for i in range(max(0, start), min(len(rank), start + 64))]
        if inside and min(inside)[0] < fingerprints.CLASSES:
            popular[min(inside)[1]] += 1
    return sorted(p for p, n in popular.items() if n >= 16)


def test_entropy_ranks_and_features(monkeypatch):
    texts = sample()
    counts = Counter(plain_class(t[i: i + 64]) for t in texts for i in range(len(t) - 63))
    found = fingerprints.class_counts(texts)
    assert {i: n for i, n in enumerate(found.tolist()) if n} == dict(counts)
    ranks = fingerprints.ranks_of(found)
    for core in (1 << 16, 400):
        monkeypatch.setattr(fingerprints, "CORE", core)
        for text in texts:
            x, starts, sizes = fingerprints.joined([text])
            places = fingerprints.chosen(x, fingerprints.window_places(starts, sizes, len(x)), ranks) - fingerprints.PAD
            assert places.tolist() == plain_places(text, ranks)


def test_digests_do_not_depend_on_neighbours():
    texts = sample()
    ranks = fingerprints.ranks_of(fingerprints.class_counts(texts))
    together = fingerprints.digests(texts, ranks)
    for text, chain in zip(texts, together, strict=True):
        assert np.array_equal(chain, fingerprints.digests([text], ranks)[0])
        assert len(chain) == 0 if not text else len(chain) >= 1
        assert fingerprints.likeness(chain, chain) == 1
    assert fingerprints.likeness(together[-1], together[-2]) < 0.1


def table(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    result = []
    for i, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        result.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return result


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_edited_texts(spark, ranges):
    draw = random.Random(1)
    rows = [(draw.randint(-9, 10**6), "é漢ab c"[draw.randint(0, 3):] * draw.randint(0, 40)) for _ in range(60)]
    rows = list(dict(rows).items()) + [(None, "missing id"), (10**7, None), (10**7 + 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "range": F.lit(2)})
    found = fingerprints.fingerprint(docs, ranges=ranges).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == sorted(table(rows), key=str)
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))


def test_query(spark, small):
    rows = list(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()))
    found = fingerprints.op3_fingerprints(spark, small).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(table(rows))
    prints = {}
    for row in found:
        prints.setdefault(dict(rows)[row.doc_id], set()).add(row.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    long = [r for r in found if r.n_chars > 2000]
    assert np.mean([r.near_edited for r in long]) > 0.4 > 0.1 > np.mean([r.near_next for r in long])


@pytest.mark.parametrize(("low", "high"), [(24, 47), (48, 63), (64, 95), (96, 200), (200, 1000)])
def test_short_texts_resemble_their_edited_forms(low, high):
    draw = random.Random(low)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 9))) for _ in range(500)]
    texts = []
    while len(texts) < 60:
        text = " ".join(draw.choices(words, k=draw.randint(3, 160)))
        texts += [text] if low <= len(text) <= high else []
    ranks = fingerprints.ranks_of(fingerprints.class_counts([t.encode() for t in texts]))
    after = [*texts[1:], texts[0]]
    edited = [t[: len(t) - len(t) // 4] + a[: len(t) // 4] for t, a in zip(texts, after, strict=True)]
    own, other, following = (fingerprints.digests([t.encode() for t in x], ranks) for x in (texts, edited, after))
    near = [fingerprints.likeness(a, b) for a, b in zip(own, other, strict=True)]
    far = [fingerprints.likeness(a, b) for a, b in zip(own, following, strict=True)]
    assert min(near) > 0.15 and np.mean(near) > 0.4 and np.mean(far) < 0.1
    assert sum(a > b for a, b in zip(near, far, strict=True)) == len(texts)


def test_very_long_text(spark):
    draw = random.Random(9)
    text = "".join(draw.choices("abcdefgh ", k=300_000))
    found = fingerprints.fingerprint(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).collect()
    row = next(r for r in found if r.doc_id == 1)
    assert row.n_chars == 300_000 and row.edited_sha256 == hashlib.sha256((text[:225_000] + "x").encode()).hexdigest()
    assert row.near_edited > 0.5


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(3, "ab"), (3, "ab")], "doc_id long, text string")
    assert [(r.doc_id, r.near_next) for r in fingerprints.fingerprint(docs).collect()] == [(3, 1.0), (3, 1.0)]
    assert fingerprints.fingerprint(docs.limit(0)).collect() == []
