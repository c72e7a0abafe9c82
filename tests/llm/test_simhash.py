"""SimHash components against all pairs."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemill.llm import simhash
from tidemill.llm.components import connected


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(w[i: i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def texts():
    draw = random.Random(2)
    base = " ".join(draw.choice("abcdefghij") * 3 for _ in range(900)).split()
    rows = [(i, " ".join(w if draw.random() > 0.004 else "zz" for w in base)) for i in range(10, 50)]
    return rows + [(1, None), (2, ""), (3, "One"), (4, "one"), (5, "one two"), (6, "one two"), (7, base[0]), (7, base[0])]


@pytest.mark.parametrize("crowd", [64, 1])
def test_components(spark, crowd):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1))
    found = simhash.near_duplicates(docs, crowd=crowd).collect()
    prints = {i: brute(t) for i, t in rows}
    expected = roots(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in found) == sorted((i, prints[i], expected[i]) for i, _ in rows)
    assert len(set(expected.values())) < len(prints) - 5  # some really are linked
    kept = [r.doc_id for r in simhash.kept_documents(docs).collect()]
    assert sorted(kept) == sorted(set(expected.values()))


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 50)
    assert simhash.fingerprint(text) == whole == simhash.fingerprint(text.upper())
    assert whole % 2**64 == brute(text)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(0, 30)] + [(7, 7), (300, 200), (200, 300)]
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == (
        dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 130), 100) | {200: 200, 300: 200})


def test_missing_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "b c"), (4, "a")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} == {(None, 4), (4, 4), (None, None)}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
