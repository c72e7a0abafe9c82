"""Segmentation against a plain search of all paths, and words planted in a corpus."""

from __future__ import annotations

import itertools
import random

import pytest

from tidemill.operators import segmentation as sg


def all_paths(run, weights):
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        words, start = [], 0
        for i, cut in enumerate([*cuts, 1], 1):
            if cut:
                words.append(run[start:i])
                start = i
        if any(len(w) > 4 or (len(w) > 1 and w not in weights) for w in words):
            continue
        score = sum(weights.get(w, sg.UNKNOWN) for w in words)
        order = (score, [len(w) for w in reversed(words)])
        if best is None or order > best[0]:
            best = (order, words)
    return best[1]


def test_best_paths(spark):
    draw = random.Random(1)
    letters = "天地人大小中"
    weights = {"".join(draw.choices(letters, k=draw.randint(1, 4))): -draw.randint(1, 9) * sg.UNIT for _ in range(60)}
    runs = ["".join(draw.choices(letters + "龍", k=draw.randint(1, 10))) for _ in range(80)]
    docs = spark.createDataFrame([(i, f"x {a} y{b}。", 0) for i, (a, b) in enumerate(zip(runs[::2], runs[1::2], strict=True))]
                                 + [(100, "no words", 0), (101, None, 0)], "d int, text string, words int")
    table = spark.createDataFrame(list(weights.items()), "word string, weight long")
    found = {r.d: r.words for r in sg.segment(docs, "d", "text", table).collect()}
    assert found[100] == [] == found[101]
    for i, (a, b) in enumerate(zip(runs[::2], runs[1::2], strict=True)):
        assert found[i] == all_paths(a, weights) + all_paths(b, weights)


def test_a_long_run(spark):
    text = "天地人" * 700
    docs = spark.createDataFrame([(1, text)], "d int, text string")
    table = spark.createDataFrame([("天地", -1), ("人", -1), ("天", -5), ("地", -5)], "word string, weight long")
    assert sg.segment(docs, "d", "text", table).first()["words"] == ["天地", "人"] * 700


def test_planted_words_are_found(spark):
    draw = random.Random(2)
    filler = [chr(0x4E00 + i) for i in range(200)]
    planted = ["葡萄", "蝴蝶", "巧克力"]
    rows = [(i, "".join(draw.choice(planted) if draw.random() < 0.2 else draw.choice(filler) for _ in range(30))) for i in range(150)]
    docs = spark.createDataFrame(rows, "d int, text string")
    dictionary = sg.corpus_dictionary(docs, "d", "text", min_count=10)
    assert {r.word for r in dictionary.filter("cohesion IS NOT NULL").collect()} == set(planted)
    words = [w for r in sg.segment(docs, "d", "text", dictionary).collect() for w in r.words]
    assert "".join(sorted("".join(words))) == "".join(sorted("".join(t for _, t in rows)))
    assert sum(w in planted for w in words) == sum(t.count(w) for _, t in rows for w in planted)


def test_no_text(spark):
    docs = spark.createDataFrame([], "d int, text string")
    assert sg.corpus_dictionary(docs, "d", "text").collect() == []
    assert sg.segment(docs, "d", "text", spark.createDataFrame([], "word string, weight long")).collect() == []


@pytest.mark.parametrize("held", [0, 1, 3])
def test_words_and_runs_no_task_keeps(spark, held):
    """However few words and runs a task keeps, the cuts are the same; nothing is a row of its own that a task keeps."""
    table = spark.createDataFrame([("天", -9 * sg.UNIT), ("地", -9 * sg.UNIT), ("天地", -7 * sg.UNIT), ("人", -5 * sg.UNIT), ("地人", -8 * sg.UNIT)],
                                  "word string, weight long")
    docs = spark.createDataFrame([(1, "天地人 x 人人"), (2, "龙天地"), (3, "none"), (4, None), (5, "人人, 天地人, 地人 人人")], "d int, text string")
    found = {r.d: r.words for r in sg.segment(docs, "d", "text", table, held=held).collect()}
    assert found == {1: ["天地", "人", "人", "人"], 2: ["龙", "天地"], 3: [], 4: [], 5: ["人", "人", "天地", "人", "地人", "人", "人"]}
    assert found == {r.d: r.words for r in sg.segment(docs, "d", "text", table).collect()}
