"""Exact deduplication: edge cases, colliding digests, state over several micro-batches."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidemill.llm import exact_dedup

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (None, "a b"), (1, None), (2, ""), (7, "c"), (7, "c"), (8, "x" * 200_000),
        (6, "a b"), (None, "only"), (4, "A b")]


def weak_digest(text):
    return F.encode(F.substring(text, 1, 1), "utf-8")


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    result = []
    for ids in groups.values():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        result += [(i, keep, len(ids)) for i in ids]
    return sorted(result, key=str)


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    return frame.withColumns({"kept": F.lit("x"), "keep_id": F.lit(0), "digest": F.lit("y")}).repartition(3)


@pytest.mark.parametrize("options", [{}, {"digest": weak_digest}, {"files_per_batch": 1}])
def test_groups_and_kept_rows(docs, options):
    found = exact_dedup.deduplicate(docs, **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == expected(ROWS)
    assert sum(r.kept for r in found) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in ROWS})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_kept_documents_keep_their_columns(docs):
    found = exact_dedup.kept_documents(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id for r in found.collect()), key=str) == sorted([3, 1, 7, 8, 6, None, 4], key=str)


def test_state_goes_on_where_it_stopped(spark, tmp_path):
    seen, state = str(tmp_path / "seen"), str(tmp_path / "state")
    entry = F.struct(F.lit(False).alias("unnamed"), F.col("id").alias("doc_id"), F.lit("f").alias("file"),
                     F.col("id").alias("place"))
    for low in (10, 0):  # the smaller identifiers arrive later
        rows = spark.range(low, low + 5).select((F.col("id") % 5).cast("string").cast("binary").alias("digest"),
                                                entry.alias("entry"))
        rows.write.mode("append").parquet(seen)
        with exact_dedup.state_on_disk(spark):
            exact_dedup.add_to_state(spark, seen, state)
            held = exact_dedup.held_classes(spark, state).collect()
    assert sorted((r.first.doc_id, r.n) for r in held) == [(i, 2) for i in range(5)]


CALLS = [[(5, "a b"), (6, "c"), (7, "a one"), (None, "only")], [(3, "a\tb"), (8, "a two"), (9, "new"), (10, "c")],
         [(1, "a two"), (2, "a three"), (11, "a one"), (12, "new"), (13, "only")], []]


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, weak_digest])
def test_several_calls_with_one_state(spark, tmp_path, digest):
    state, seen = str(tmp_path / "state"), {}
    for number, rows in enumerate(CALLS):
        path = str(tmp_path / f"call {number}")
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
        docs = spark.read.parquet(path)
        if number == 1:  # a call that stopped before its state was written
            with pytest.raises(RuntimeError), pytest.MonkeyPatch.context() as patch:
                def fails(*args):
                    raise RuntimeError

                patch.setattr(exact_dedup, "add_to_state", fails)
                exact_dedup.deduplicate(docs, digest=digest, state=state)
        found = exact_dedup.deduplicate(docs, digest=digest, state=state, call=number if number == 1 else None).collect()
        groups = {}
        for doc_id, text in rows:
            groups.setdefault(re.sub(r"\s+", " ", text), []).append(doc_id)
        expected = []
        for text, ids in groups.items():
            keep, n = seen.get(text, (min(ids, key=lambda i: (i is None, i)), 0))
            expected += [(i, keep, n + len(ids), text not in seen and i == keep) for i in ids]
            seen[text] = (keep, n + len(ids))
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found), key=str) == sorted(expected, key=str)


def test_no_rows(docs):
    assert exact_dedup.deduplicate(docs.limit(0)).collect() == []
