"""License scanning against a scan word by word."""

from __future__ import annotations

import re

import pytest

from tidemill.llm import license_scan

TEXTS = [
    None, "", "license", "MIT License, mit-license; MIT\nLICENSE", "the GNU General Public License and a public license",
    "Apache License apache license general public license mit license", "é mit license", "mit x license",
    "Licensed under the very Apache License, Version 2.0.", "released under the mit license " * 3000,
    "Licensed under CC BY-NC 4.0.", "general public licenses", "mit0 license mit licenseé",
]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i if i else None, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "2 AS label", "3 AS row")
    return license_scan.scan(docs).collect()


def test_base_places(found):
    assert len(found) == len(TEXTS) + 1
    for row in found:
        w = words(TEXTS[row.doc_id or 0])
        places = sorted((i, label) for label, phrase in license_scan.BASE_PHRASES for i in range(len(w))
                        if w[i: i + len(phrase.split())] == phrase.split())
        assert (row.n_words, row.n_base) == (len(w), len(places))
        assert (row.first_word, row.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_phrases_with_words_put_in(found):
    by_id = {r.doc_id: r for r in found}
    assert "apache-2.0" in by_id[8].labels and 0.8 <= by_id[8].score
    assert by_id[10].labels == "cc-by-nc-4.0" and by_id[10].base_labels == ""
    assert by_id[7].labels == "" and by_id[11].base_labels == ""


def test_whole_license_texts(spark):
    label, text = license_scan.TEMPLATES[0]
    assert len(words(text)) > 150
    bent = words(text)
    bent[20:20], bent[90] = ["kindly", "do"], "wares"
    half = words(text)[:60]
    rows = [(1, f"Copyright somebody.\n\n{text.upper()}\n\nint main() {{}}"), (2, "x " * 500 + " ".join(bent)), (3, " ".join(half)),
            (4, " ".join(reversed(words(text)))), (5, text + " and " + license_scan.TEMPLATES[2][1])]
    found = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert label in found[1].labels.split(",") and found[1].score == 1
    whole = [s for s in found[1].spans if s.end - s.start == len(words(text))]
    assert [(s.label, s.start) for s in whole] == [(label, 2)]
    assert label in found[2].labels.split(",") and any(s.start == 500 and s.end > 650 for s in found[2].spans)
    assert not any(s.end - s.start > 100 for s in [*found[3].spans, *found[4].spans])
    assert {"mit", "bsd"} <= set(found[5].labels.split(","))


def test_no_rows(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
