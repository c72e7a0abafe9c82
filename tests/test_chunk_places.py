"""Chunks found by places against a plain splitter that walks from piece to piece."""

from __future__ import annotations

import random
from collections import deque

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.functions.splitting import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, chunks_of
from tidemill.operators import chunking


def plain_pieces(text, low, high, separator):
    marks, at = [low], text.find(separator, low, high)
    while at != -1:
        marks += [at] if at > low else []
        at = text.find(separator, at + len(separator), high)
    return [(a, b) for a, b in zip(marks, marks[1:] + [high], strict=True) if a < b]


def plain_packed(pieces, size, overlap):
    out, held = [], deque()
    for low, high in pieces:
        if held and high - held[0][0] > size:
            out.append((held[0][0], held[-1][1]))
            while held and (low - held[0][0] > overlap or high - held[0][0] > size):
                held.popleft()
        held.append((low, high))
    return out + ([(held[0][0], held[-1][1])] if held else [])


def plain_spans(text, low, high, separators, size, overlap):
    for i, separator in enumerate(separators):
        if separator == "":
            return [(s, min(s + size, high)) for s in range(low, max(high - overlap, low + 1), size - overlap)]
        if text.find(separator, low, high) == -1:
            continue
        out, short = [], []
        for piece in plain_pieces(text, low, high, separator):
            if piece[1] - piece[0] < size:
                short.append(piece)
                continue
            out += plain_packed(short, size, overlap) + plain_spans(text, *piece, separators[i + 1:], size, overlap)
            short = []
        return out + plain_packed(short, size, overlap)
    return [(low, high)]


def plain(text, size=CHUNK_SIZE, overlap=CHUNK_OVERLAP, separators=SEPARATORS):
    found = []
    for low, high in plain_spans(text, 0, len(text), separators, size, overlap) if text else []:
        part = text[low:high]
        if part.strip():
            found.append({"start": low + len(part) - len(part.lstrip()), "text": part.strip()})
    return found


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=120), st.integers(4, 30), st.integers(0, 3))
def test_small_chunks(text, size, overlap):
    assert chunks_of(text, size, overlap) == plain(text, size, overlap)


@pytest.mark.parametrize("separators", [SEPARATORS, ("\n\n", " "), ("\n\n\n", ". ", "")])
def test_long_texts(separators):
    draw = random.Random(4)
    for _ in range(20):
        text = "".join(draw.choices(["word", " ", " ", ". ", "\n", "\n\n", "é🙂", "x" * 1200, "\n\n\n"], [30, 20, 20, 5, 3, 1, 5, 0.3, 0.5], k=2000))
        assert chunks_of(text, separators=separators) == plain(text, separators=separators)


def test_every_document_of_a_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    found = sorted(map(tuple, chunking.recursive_chunks(rows, "doc_id").collect()))
    expected = [(r.doc_id, i, c["start"], c["text"]) for r in rows.collect() for i, c in enumerate(plain(r.text))]
    assert found == sorted(expected)


def test_a_very_long_text():
    text = "some words here. " * 200_000
    assert chunks_of(text)[:50] == plain(text[:100_000])[:50]
