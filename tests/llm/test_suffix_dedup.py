"""Repeated passages against a table of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import suffix_dedup


def brute(rows, length, keep):
    """{doc_id: (bytes, removed, spans, hash of the rest)} for rows in the order of their ids."""
    counts, first = Counter(), {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            counts[data[i: i + length]] += 1
            first.setdefault(data[i: i + length], (doc_id, i))
    found = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, dtype=bool)
        for i in range(len(data) - length + 1):
            window = data[i: i + length]
            if counts[window] > 1 if keep == "none" else first[window] != (doc_id, i):
                cover[i: i + length] = True
        rest = bytes(np.frombuffer(data, np.uint8)[~cover[:-1]])
        found[doc_id] = (len(data), int(cover.sum()), int((np.diff(cover.astype(int)) == -1).sum()), hashlib.sha256(rest).hexdigest())
    return found


def rest_of_characters(text, spans):
    """The characters of which some byte lies outside all spans."""
    at, kept = 0, []
    for c in text or "":
        size = len(c.encode())
        if not any(s.start <= at and at + size <= s.end for s in spans):
            kept.append(c)
        at += size
    return "".join(kept)


def summary(found):
    return {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
            for r in found.collect()}


def test_longest_previous_factors():
    draw = random.Random(3)
    for _ in range(150):
        text = bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 40)))

        def common(a, b, text=text):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            return n
        order = sorted(range(len(text)), key=lambda i: text[i:])
        lcp = np.array([0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)])
        expected = [max((common(i, j) for j in range(i)), default=0) for i in order]
        assert suffix_dedup.longest_previous(np.array(order), lcp).tolist() == expected


def passages():
    draw = random.Random(6)
    shared = ["".join(draw.choice("abcdé ") for _ in range(n)) for n in (45, 60, 90, 200)]
    rows = []
    for i in range(60):
        parts = [draw.choice(shared) if draw.random() < 0.5 else "".join(draw.choice("xyzü ") for _ in range(draw.randint(0, 60)))
                 for _ in range(draw.randint(0, 5))]
        rows.append((i, "".join(parts)))
    return [*rows, (70, None), (71, ""), (72, "ab" * 300), (73, "q" * 500), (74, rows[3][1])]


@pytest.mark.parametrize(("length", "anchor", "crowd", "keep", "windows"), [
    (40, 8, 256, "none", 20), (40, 8, 2, "first", 20_000), (41, 41, 1, "none", 20_000), (50, 16, 256, "first", 300)])
def test_passages(spark, monkeypatch, length, anchor, crowd, keep, windows):
    monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": F.lit(1), "anchor": F.lit(2), "spans": F.lit(3)})
    found = suffix_dedup.deduplicate(docs.repartition(3), length, keep, anchor=anchor, crowd=crowd)
    assert summary(found) == brute(rows, length, keep)
    texts = dict(rows)
    assert all(r.text == rest_of_characters(texts[r.doc_id], r.spans) for r in found.collect())


def test_windows_sorted_in_pieces(monkeypatch):
    draw = random.Random(8)
    core = b"anchor in the middle of all"
    texts = [draw.choice([b"left one ", b"left two "]) + core + draw.choice([b" right one", b" right two"]) for _ in range(40)]
    reach = np.full(len(texts), 9)
    whole = suffix_dedup.matched_windows(texts, reach, 30)
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 50)
    assert len(list(suffix_dedup.pieces_of(reach[whole[0]] - whole[1]))) > 3
    for a, b in zip(whole, suffix_dedup.matched_windows(texts, reach, 30), strict=True):
        assert np.array_equal(a, b)


def test_blocks(spark, monkeypatch):
    raw = np.frombuffer(b"".join(t.encode() for _, t in passages()[:30]), np.uint8)
    offsets = np.array([0, 700, len(raw)])
    whole = {(t, w) for t, a, b, *_ in suffix_dedup.anchored(raw, offsets, 40, 8) for t, x, y in zip(t, a, b, strict=True) for w in range(x, y + 1)}
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    cut = {(t, w) for t, a, b, *_ in suffix_dedup.anchored(raw, offsets, 40, 8) for t, x, y in zip(t, a, b, strict=True) for w in range(x, y + 1)}
    assert whole == cut == {(0, w) for w in range(661)} | {(1, w) for w in range(700, len(raw) - 39)}


def test_query(spark, small):
    rows = sorted(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()))
    result = suffix_dedup.op7_suffix_dedup(spark, small)
    assert result.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    found = {r[0]: tuple(r)[1:5] for r in result.collect()}
    assert found == brute(rows, 400, "none")
    assert all(len(r.text.encode()) >= r.n_bytes - r.n_removed for r in result.collect())


def test_cleaned_documents_stay_readable(spark):
    text = "é" * 300 + "end"
    docs = spark.createDataFrame([(None, text, 1), (2, "x" + text, 2), (3, None, 0), (3, None, 0)], "doc_id long, text string, n_chars int")
    found = suffix_dedup.cleaned_documents(docs, 101)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows[0][1].startswith("xé") and rows[0][1].endswith("nd") and rows[0][2] == len(rows[0][1]) < 200
    assert rows[1:3] == [(3, None, None), (3, None, None)] and rows[3][0] is None and rows[3][2] == len(rows[3][1])


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a" * 1000), (1, "a" * 1000), (2, "b" * 399)], "doc_id long, text string")
    assert sorted((r.doc_id, len(r.kept)) for r in suffix_dedup.deduplicate(docs, keep="none").collect()) == [(1, 0), (1, 0), (2, 399)]
    assert sorted((r.doc_id, len(r.kept)) for r in suffix_dedup.deduplicate(docs).collect()) == [(1, 1), (1, 1), (2, 399)]
    assert suffix_dedup.deduplicate(docs.limit(0)).collect() == []
