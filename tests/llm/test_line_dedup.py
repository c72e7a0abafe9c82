"""Line deduplication against comparing every line with all before it."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import line_dedup
from tidemill.llm.common import text_bytes, word_spans


def brute(rows):
    """{doc_id: (lines, removed numbers)} for rows in the order of their ids."""
    seen, holders, found = [], defaultdict(set), {}
    for doc_id, text in rows:
        gone = []
        lines = (text or "").split("\n")
        for i, line in enumerate(lines):
            words = frozenset(line.encode().lower().split())
            near = {j for w in words for j in holders[w]}
            if any(5 * len(words & seen[j]) >= 4 * len(words | seen[j]) for j in near):
                gone.append(i)
            for w in words:
                holders[w].add(len(seen))
            seen.append(words)
        found[doc_id] = (len(lines), gone)
    return found


def variants():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    base = [[draw.choice(words) for _ in range(draw.randint(1, 25))] for _ in range(12)]

    def changed(line):
        line = [w if draw.random() > 0.08 else draw.choice(words) for w in line]
        return " ".join(line).title() if draw.random() < 0.3 else "\t".join(line)
    rows = [(i, "\n".join(changed(draw.choice(base)) if draw.random() < 0.8 else draw.choice(["", " ", "\r"])
                          for _ in range(draw.randint(1, 6)))) for i in range(120)]
    return [*rows, (150, "x y\ny x x"), (151, ""), (152, None), (153, "é " * 30_000), (154, "é")]


@pytest.mark.parametrize("crowd", [64, 2])
def test_removed_lines(spark, crowd):
    rows = variants()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"line": F.lit(1), "n": F.lit(2), "set": F.lit(3)})
    found = line_dedup.deduplicate(docs, crowd=crowd)
    expected = brute(rows)
    assert {r.doc_id: (r.n_lines, r.removed_lines) for r in found.collect()} == expected
    texts = dict(rows)
    cleaned = {r.doc_id: r.text for r in line_dedup.cleaned(docs, found).select("doc_id", "text").collect()}
    for doc_id, (_, gone) in expected.items():
        lines = (texts[doc_id] or "").split("\n")
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        assert cleaned[doc_id] == (kept if gone else texts[doc_id])


def test_whole_table(spark, small):
    rows = sorted(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()))
    found = {r.doc_id: (r.n_lines, r.removed_lines) for r in line_dedup.op1_line_dedup(spark, small).collect()}
    assert found == brute(rows)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, None), (None, "a b"), (1, "a b\n\nA  b"), (1, "a b\n\nA  b")], "doc_id long, text string")
    found = [(r.doc_id, r.n_lines, r.removed_lines) for r in line_dedup.deduplicate(docs).collect()]
    assert sorted(found, key=str) == [(1, 3, [2]), (1, 3, [2]), (None, 1, [0]), (None, 1, [])]
    assert line_dedup.deduplicate(docs.limit(0)).collect() == []


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_words_have_one_hash_wherever_blocks_fall(block):
    draw = random.Random(9)
    texts = ["".join(draw.choice("ab \n") if draw.random() < 0.2 else "x" for _ in range(draw.choice([0, 3, 64, 90])))
             for _ in range(40)]
    raw, offsets = text_bytes(pa.array([*texts, "y" * block, "y" * block, "z" * (2 * block + 1), *texts]))
    found = [np.concatenate(x).tolist() for x in zip(*word_spans(raw, offsets, block), strict=True)]
    whole = [np.concatenate(x).tolist() for x in zip(*word_spans(raw, offsets, 1 << 20), strict=True)]
    assert found == whole
    words = [raw[a:b].tobytes() for a, b in zip(found[1], found[2], strict=True)]
    assert words == [w for t in [*texts, "y" * block, "y" * block, "z" * (2 * block + 1), *texts] for w in t.encode().split()]
    assert len(set(zip(words, found[3], strict=True))) == len(set(words)) == len(set(found[3]))


def test_lines_without_spaces_longer_than_a_block(spark):
    """Copies of one word go wherever they stand among others; short texts without spaces stay whole words."""
    sizes = [line_dedup.BLOCK + d for d in (-1, 0, 1)] + [2 * line_dedup.BLOCK + 5]
    rows = [(i, "q" * 1000 + str(i % 400)) for i in range(800)]
    rows += [(1000 + 10 * i + k, ["", "lead word\n", "other\n"][k] + chr(97 + i) * size) for i, size in enumerate(sizes) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: (r.n_lines, r.removed_lines) for r in line_dedup.deduplicate(docs).collect()}
    assert found == brute(rows)
    assert sum(len(gone) for _, gone in found.values()) == 400 + 8 + 6


@pytest.mark.parametrize("crowd", [64, 2])
def test_classes_and_all_their_links(spark, crowd):
    rows = variants()
    words = [f"common{i}" for i in range(30)]
    rows += [(200 + i, " ".join(words[:i % 30] + [f"own{i}"] + words[i % 30 + 1:])) for i in range(90)]  # one word changed
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {}
    for doc_id, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if line.split():
                sets.setdefault(frozenset(line.encode().lower().split()), []).append((doc_id, i))
    near = {a: sum(a != b and 5 * len(a & b) >= 4 * len(a | b) for b in sets) for a in sets}
    expected = {place: (holders[0], near[a]) for a, holders in sets.items() for place in holders if len(holders) > 1 or near[a]}
    found = [(r.doc_id, x.line, x["class"], x.links) for r in line_dedup.deduplicate(docs, crowd=crowd).collect() for x in r.line_classes]
    first = {}
    for doc_id, line, kind, _ in sorted(found):
        first.setdefault(kind, (doc_id, line))
    assert {(doc_id, line): (first[kind], n) for doc_id, line, kind, n in found} == expected
    assert len(found) == len(expected) and max(near.values()) >= 89


def test_long_lines_meet_only_where_they_share_enough_rare_words(spark, monkeypatch):
    """Lines of 150 words that share one rare word are no candidates, similar ones are; cells of few lines find the same."""
    draw = random.Random(11)
    usual = [f"u{i}" for i in range(140)]
    base = [draw.sample(usual, 120) + [f"rare{i // 2}"] + [f"own{i}_{k}" for k in range(29)] for i in range(60)]
    near = [[w if draw.random() > 0.05 else f"new{i}_{k}" for k, w in enumerate(words)] for i, words in enumerate(base)]
    rows = [(i, " ".join(words)) for i, words in enumerate(base + near)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    sets = line_dedup.lines_of(texts, line_dedup.SHARE).filter("line >= 0").withColumns(
        {"id": F.col("doc_id"), "first": F.struct(F.lit(False).alias("unnamed"), "doc_id", "text_key", "line")})
    monkeypatch.setattr(line_dedup, "LINES", 7)
    met = line_dedup.prefixes(sets).withColumns({"key": F.col("word").cast("long"), "own": F.lit(-1)})
    found = {(r.a, r.b) for r in line_dedup.pairs_of_words(met, line_dedup.SHARE).collect()}
    words = [set(w) for w in base + near]
    similar = {(a, b) for b in range(120) for a in range(b) if 5 * len(words[a] & words[b]) >= 4 * len(words[a] | words[b])}
    assert len(similar) >= 55 and similar <= found and len(found) <= len(similar) + 5
    linked = line_dedup.links(texts, sets, line_dedup.SHARE, 3).collect()
    expected = {i: (sum(i in pair for pair in similar), any(i == b for _, b in similar)) for pair in similar for i in pair}
    assert {r.id: (r.links, r.goes) for r in linked} == expected


def test_a_set_never_meets_itself(spark):
    """Two words of a set may have one 32-bit number."""
    rows = [(1, 0, [5, 5, 7]), (2, 0, [9]), (3, 0, [9])]
    sets = spark.createDataFrame([(i, bits, 10, prefix) for i, bits, prefix in rows], "id long, bits long, n int, prefix array<int>")
    met = line_dedup.prefixes(sets).withColumns({"key": F.col("word").cast("long"), "own": F.lit(-1)})
    assert [tuple(r) for r in line_dedup.pairs_of_words(met, line_dedup.SHARE).collect()] == [(2, 3)]


def test_no_row_for_a_pair_of_near_copies(spark, monkeypatch):
    """Every table written on the way has some rows for a line, also where all lines resemble each other."""
    base = [f"base{k}" for k in range(30)]
    rows = [(i, " ".join([*base[:i % 31], f"own{i}", *base[i % 31:]])) for i in range(400)]
    counts, write = {}, line_dedup.written

    def counting(df, name):
        table = write(df, name)
        counts[name] = table.count()
        return table

    monkeypatch.setattr(line_dedup, "written", counting)
    monkeypatch.setattr(line_dedup, "LINES", 64)
    found = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), crowd=100).collect()
    assert {x.links for r in found for x in r.line_classes} == {399} and sum(r.n_removed for r in found) == 399
    assert max(counts.values()) <= 40 * len(rows)
