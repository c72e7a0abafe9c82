"""Language identification: recall on the tables, and each source of evidence on its own."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.llm import language_id

KNOWN = [("en", "the house is on the hill and the river runs to the sea with the wind " * 8),
         ("de", "das haus steht auf dem berg und der fluss läuft zum meer mit dem wind " * 8),
         ("en-GB", "there is a light in the window of the old house that was there " * 8), (None, "nothing"), ("x!", "junk"),
         ("fr", None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(KNOWN, "lang string, text string")


def pages_of(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.withColumns({"host": F.lit("x"), "vote": F.lit(1), "declared": F.lit("zz")})


def test_hidden_text_is_left_out():
    page = "<style>a{}</style>one<!-- two --><script>three()</SCRIPT > f&amp;ur<p title='x'>five<script>open <b>six"
    assert language_id.visible(page).split() == ["one", "f&ur", "five"]


def test_sources_of_evidence(spark, docs):
    english, german = KNOWN[0][1], KNOWN[1][1]
    rows = [(i, f"https://a{i}.x.de/p", f"<html lang='de'><p>{german}") for i in range(12)]
    rows += [(20 + i, f"http://b{i}.y.com", f"<html lang=en-US>{english}") for i in range(12)]
    rows += [(40, "https://user@a3.x.de:80/q", ""), (41, "http://z.de", None), (42, "http://z.com/", "<HTML class=x LANG=\"DE\">"),
             (43, None, None), (44, "junk", f"<p>{english * 200}"), (45, "http://b1.y.com/", f"<html lang=en>{german}"), (45, "http://b1.y.com/", f"<html lang=en>{german}")]
    found = {r.page_id: r for r in language_id.identify(pages_of(spark, rows), docs).collect()}
    assert {found[i].lang for i in range(12)} == {"de"} and {found[20 + i].lang for i in range(12)} == {"en"}
    assert found[40].host == "a3.x.de" and found[40].lang == "de"  # its host alone
    assert found[41].lang == "de" and found[42].lang == "de"  # suffix; declaration
    assert found[43].lang is not None and found[43].host == "" and found[43].declared is None
    assert found[44].lang == "en" and found[45].lang == found[45].text_lang == "de"  # a clear text outweighs the rest
    assert all(0 < r.confidence <= 1 for r in found.values())


def test_pages_of_the_table(spark, small):
    found = {r.page_id: r.lang for r in language_id.op8_language_id(spark, small).collect()}
    urls = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url").collect()
    truth = {i: m[1] for i, u in urls if (m := re.search(r"//[^/]+/(en|de|fr|es)/", u or ""))}
    assert len(found) == len(urls) and len(truth) > 20
    assert sum(found[i] == x for i, x in truth.items()) >= 0.98 * len(truth)


def test_nothing_known_and_no_pages(spark, docs):
    pages = pages_of(spark, [(1, "http://a.de", "<p>x")])
    assert [r.lang for r in language_id.identify(pages, docs.limit(0)).collect()] == [None]
    assert language_id.identify(pages.limit(0), docs).collect() == []


def bucket(a, b, c):
    key = 0
    for byte in (a, b, c):
        key = (key ^ byte) * 0x01000193 % 2**32
    key ^= key >> 15
    return (key * 0x2C1B3C6D % 2**32) >> 18


def trigrams(text):
    data = text.encode().lower()
    return Counter(bucket(*data[i: i + 3]) for i in range(len(data) - 2))


def share(logs):
    top = max(logs)
    weights = [math.exp(x - top) for x in logs]
    return [w / sum(weights) for w in weights]


def plain(pages, docs):
    """(page_id, text_lang, lang, confidence) with one dictionary for each count."""
    counts = {}
    for tag, text in docs:
        m = re.match(r"^\s*([a-z]{2,3})([-_].*)?\s*$", (tag or "").lower(), re.S)
        if m and text is not None:
            counts.setdefault(m[1], Counter()).update(trigrams(text))
    names = sorted(x for x in counts if counts[x])
    likely = [{b: math.log((counts[x][b] + 0.5) / (sum(counts[x].values()) + 0.5 * 2**14)) for b in range(2**14)} for x in names]
    rows = []
    for page_id, url, markup in pages:
        found = trigrams(language_id.visible(markup or ""))
        n = sum(found.values())
        logs = [sum(k * table[b] for b, k in found.items()) * min(n, 60) / max(n, 1) for table in likely]
        host = (re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", url or "") or ["", ""])[1].lower()
        declared = (re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", markup or "", re.I) or ["", ""])[1].lower()
        suffix = (re.search(r"\.([a-z][a-z0-9\-]*)$", host) or ["", ""])[1]
        rows.append((page_id, logs, share(logs), host, ".".join(host.split(".")[-2:]), declared, suffix))

    def voted(place):
        sums = {}
        for r in rows:
            sums.setdefault(r[place], []).append(r[2])
        return {k: [sum(x) for x in zip(*v, strict=True)] for k, v in sums.items()}

    whole = [sum(r[2][i] for r in rows) for i in range(len(names))]
    overall = [(x + 0.5) / (sum(whole) + len(names) * 0.5) for x in whole]
    hosts, domains, marks, ends = (voted(i) for i in (3, 4, 5, 6))

    def heard(table, key):
        values = len(table) + 1
        return [math.log((c + 2 / values) / (w + 2)) for c, w in zip(table[key], whole, strict=True)]

    def leaning(own, vote, above):
        others = [max(c - v, 0.0) for c, v in zip(own, vote, strict=True)]
        return [(c + 5 * p) / (sum(others) + 5) for c, p in zip(others, above, strict=True)]

    result = []
    for page_id, logs, vote, host, domain, declared, suffix in rows:
        prior = leaning(hosts[host], vote, leaning(domains[domain], vote, overall))
        fused = share([a + b + c + math.log(d) for a, b, c, d in zip(logs, heard(marks, declared), heard(ends, suffix), prior, strict=True)])

        def best(chances):
            rounded = [round(x, 9) for x in chances]
            return names[rounded.index(max(rounded))]

        result.append((page_id, best(vote), best(fused), round(max(fused), 4)))
    return sorted(result)


def test_against_plain_counts(spark, docs, small):
    english, german = KNOWN[0][1][:90], KNOWN[1][1][:60]
    made = [(i, f"https://a{i % 5}.x.{'de' if i % 3 else 'com'}/p", f"<html lang='{'de' if i % 4 else 'en-US'}'><p>{german[i:] if i % 2 else english[i:]}")
            for i in range(40)] + [(50, None, None), (51, "http://z.de", "<p>of"), (51, "http://z.de", "<p>of")]
    docs_of = list(map(tuple, spark.read.parquet(f"{small}/documents.parquet").select("lang", "text").collect()))
    pages = list(map(tuple, spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()))
    for rows, known in ((made, KNOWN), (pages, docs_of)):
        labelled = spark.createDataFrame(known, "lang string, text string")
        found = language_id.identify(pages_of(spark, rows), labelled).collect()
        expected = plain(rows, known)
        got = sorted((r.page_id, r.text_lang, r.lang, r.confidence) for r in found)
        assert [r[:3] for r in got] == [r[:3] for r in expected]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in expected], abs=1e-4)


def test_very_long_page(spark, docs):
    page = f"<html><p>{KNOWN[1][1] * 3000}<script>{'the house ' * 20_000}"
    assert language_id.identify(pages_of(spark, [(1, None, page)]), docs).first()["lang"] == "de"
