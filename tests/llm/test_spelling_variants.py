"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.llm import spelling_variants as sv
from tidemill.session import written


def plain_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 3 and len(w) >= 5}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts):
    forms, near = {}, {}
    for w in counts:
        near[w] = [x for x in counts if one_apart(w, x)]
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(rows)


def texts():
    draw = random.Random(4)
    base = ["".join(draw.choice("abÀÿé÷z") for _ in range(draw.choice([4, 5, 5, 6, 7, 9, 40]))) for _ in range(60)]
    base += ["aaaaaa", "aaaaab", "baaaaa", "x" * 700, "x" * 701, "aaaaaaa"]

    def bent(w):
        if draw.random() < 0.7:
            return w
        i = draw.randrange(len(w))
        return draw.choice([w[:i] + w[i + 1:], w[:i] + draw.choice("abÿz") + w[i:], w[:i] + draw.choice("abÿz") + w[i + 1:]])

    rows = [(i, " ".join(bent(draw.choice(base)) for _ in range(90)).replace("a", "A", 3)) for i in range(120)]
    rows += [(7, "aaaaaa " * 3000), (None, "aaaaaa baaaaa, ZZZZZ-zzzzz\nzzZzz"), (500, None), (501, ""), (7, rows[7][1])]
    return rows


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs.withColumn("word", F.lit("x")).withColumn("n", F.lit(1))


@pytest.mark.parametrize(("read", "edits", "bits", "held"), [(1 << 20, 1 << 18, 1 << 20, 1 << 18), (10, 50, 256, 20)])
def test_against_all_pairs(spark, monkeypatch, read, edits, bits, held):
    for name, value in {"READ": read, "EDITS_AT_ONCE": edits, "HELD_WORDS": held}.items():
        monkeypatch.setattr(sv, name, value)
    rows = texts()
    found = sv.group_spellings(frame(spark, rows), bits=bits).collect()
    expected = plain(plain_counts(rows))
    assert sorted(map(tuple, found)) == expected
    assert sum(r[1] is not None for r in expected) > 10 and any(r[2] != r[0] and r[2] != r[1] for r in expected)


def test_chains_of_forms(spark):
    words = ["a" * i + "b" for i in range(6, 60)]
    counts = {w: 3 << i for i, w in enumerate(words)}
    vocabulary = written(spark.createDataFrame(list(counts.items()), "word string, n long"), "vocabulary")
    assert sorted(map(tuple, sv.variants(vocabulary).collect())) == plain(counts)


def test_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_counts(rows)
    found = {r.word: r for r in sv.op12_spelling_variants(spark, small).collect()}
    assert {w: r.n for w, r in found.items()} == counts
    for word in sorted(counts)[::40]:
        near = [x for x in counts if one_apart(word, x)]
        assert found[word].n_near == len(near)
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        assert found[word].form == (best if best and counts[best] >= 2 * counts[word] else None)


def test_no_rows(spark):
    assert sv.group_spellings(frame(spark, [(1, None)])).collect() == []
    assert sv.group_spellings(frame(spark, [(1, "a")]).limit(0)).collect() == []
