"""Averages kept by a stream against the whole computed at once, for files in any order."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from tidemill.streaming import averages

START = dt.date(2024, 1, 1)


def plain(rows, size):
    counts = {}
    for series, day in rows:
        if series is not None and day is not None:
            counts.setdefault(series, {}).setdefault(day, []).append(1)
    found = {}
    for series, days in counts.items():
        ordered = sorted(days)
        n = [len(days[d]) for d in ordered]
        for i, d in enumerate(ordered):
            found[series, d] = (n[i], sum(n[i - size + 1: i + 1]) / size if i + 1 >= size else None,
                                (n[i] / n[i - 1] - 1) * 100 if i else None)
    return found


@pytest.mark.parametrize("size", [1, 3, 7])
def test_updates_touch_few_rows_and_are_whole(size):
    draw = random.Random(size)
    held, rows, sent = {}, [], {}
    for _ in range(40):
        new = {}
        for day in draw.sample(range(60), draw.randint(1, 3)):
            new[day] = draw.randint(1, 4)
            rows += [("a", START + dt.timedelta(day))] * new[day]
        shifted = {(START - dt.date(1970, 1, 1)).days + d: n for d, n in new.items()}
        held, frame = averages.updated(held, shifted, size)
        assert len(frame) <= max(size, 2) * len(new)
        for r in frame.itertuples():
            sent["a", r.day] = (r.n, None if np.isnan(r.moving_avg) else r.moving_avg, None if np.isnan(r.growth_pct) else r.growth_pct)
    expected = plain(rows, size)
    assert sent.keys() == expected.keys()
    assert all(sent[k] == pytest.approx(expected[k]) for k in sent)


def test_files_in_any_order(spark, tmp_path):
    draw = random.Random(4)
    rows = [(draw.choice(["a", "a", "b", None]), draw.choice([None, *[dt.datetime(2024, 1, 1) + dt.timedelta(draw.randint(0, 25), 3600)] * 9]))
            for _ in range(400)]
    for i in range(4):
        spark.createDataFrame(rows[i::4], "kind string, at timestamp_ntz").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if i % 2:
            stream = spark.readStream.schema("kind string, at timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            averages.keep_averages(stream, "kind", "at", str(tmp_path / "state"), str(tmp_path / "out"), 3)
    found = {(r.series, r.day): (r.n, r.moving_avg, r.growth_pct) for r in averages.current_averages(spark, str(tmp_path / "out")).collect()}
    expected = plain([(s, None if t is None else t.date()) for s, t in rows], 3)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k]) for k in found)
