"""The pipeline, stage by stage, against plain versions of each."""

from __future__ import annotations

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute as simhash_of
from tests.llm.test_simhash import roots
from tidemill.llm import packing, quality
from tidemill.llm.common import text_bytes
from tidemill.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), f"test-{name.replace(' ', '-')}")
        frames.append(docs)
    return frames


def rows_of(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "suffix-array dedup", "packing"]
    assert all(frame.columns == COLUMNS for frame in stages[:-1])


def test_quality(spark, stages, small):
    texts = rows_of(stages[0])
    model = quality.fitted(spark, stages[0], small)
    scores = {i: model.scores(quality.features(*text_bytes(pa.array([t]))))[0] for i, t in texts.items()}
    assert rows_of(stages[1]) == {i: t for i, t in texts.items() if scores[i] >= 0.5}


def test_copies(stages):
    best = {}
    for doc_id, text in sorted(rows_of(stages[1]).items()):
        best.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc_id)
    assert set(rows_of(stages[2])) == set(best.values())


def test_near_copies(stages):
    prints = {i: simhash_of(t) for i, t in rows_of(stages[2]).items()}
    groups = roots(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert set(rows_of(stages[3])) == set(groups.values())


def test_passages(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    seen = set()
    for doc_id, text in sorted(before.items()):
        data, size = text.encode(), corpus_pipeline.PASSAGE
        cover = bytearray(len(data))
        windows = [data[i: i + size] for i in range(len(data) - size + 1)]
        for i, window in enumerate(windows):
            if window in seen:
                cover[i: i + size] = b"\1" * size
            seen.add(window)
        ends, place = [], 0
        for char in text:
            ends.append((place, place + len(char.encode())))
            place = ends[-1][1]
        assert after[doc_id] == "".join(c for c, (a, b) in zip(text, ends, strict=True) if not all(cover[a:b]))
    assert {r.n_chars - len(r.text) for r in stages[4].collect()} == {0}


def test_packed(stages):
    check(stages[5].collect(), rows_of(stages[4]), packing.MAX_LENGTH, packing.BUCKETS, packing.TOKEN_BUDGET)


def test_odd_rows_go_through(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(30)
    odd = docs.limit(1).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long")})
    copies = docs.limit(2)
    docs = docs.unionByName(odd).unionByName(copies).withColumns({"kept": F.lit(1), "spans": F.lit("x"), "score": F.lit(0.1)})
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), f"odd-{name.replace(' ', '-')}")
        docs.count()


def test_no_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), f"none-{name.replace(' ', '-')}")
    assert docs.count() == 0


def test_passages_of_short_words(spark):
    """51 words repeat in 101 to 203 bytes, whatever stands around them; 50 words stay."""
    passage = {size: [" ".join(f"{(i * 7 + size) % 1000:03}"[:size] for i in range(n)) for n in (51, 50)] for size in (1, 2, 3)}
    rows = [(0, " \n".join(p for pair in passage.values() for p in pair))]
    rows += [(10 * size, f"before{size} {long} after{size}") for size, (long, _) in passage.items()]
    rows += [(10 * size + 1, f"early{size} {short} late{size}") for size, (_, short) in passage.items()]
    rows += [(50, f"{passage[3][0]}\t{passage[2][0]}"), (None, passage[1][0]), (60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    after = corpus_pipeline.without_repeated_passages(spark, docs.repartition(3), "")
    found = {r.doc_id: r.text for r in after.collect()}
    seen, expected = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        places = [(m.start(), m.end()) for m in re.finditer(r"\S+", text or "")]
        cover = [False] * len(text or "")
        for (a, _), (_, b) in zip(places, places[50:], strict=False):
            if text[a:b] in seen:
                cover[a:b] = [True] * (b - a)
            seen.add(text[a:b])
        expected[doc_id] = None if text is None else "".join(c for c, x in zip(text, cover, strict=True) if not x)
    assert found == expected
    assert found[20] == "before2  after2" and found[21] == rows[5][1]
