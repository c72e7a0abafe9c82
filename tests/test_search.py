"""TF-IDF, BM25, vectors and chunks against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.splitting import chunks_of
from tidemill.functions.text import word_tokens
from tidemill.operators import chunking, corpus, vectors, vocabulary
from tidemill.operators.frames import spread

WORDS = [f"w{i:02d}" for i in range(30)]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    docs = [(i, " ".join(draw.choice(WORDS[: 3 + i % 28]) for _ in range(draw.randint(1, 25)))) for i in range(60)]
    return docs + [(60, docs[0][1]), (61, "the of"), (62, docs[0][1])]


@pytest.fixture(scope="module")
def documents(spark, texts):
    return spark.createDataFrame(texts, "d bigint, text string")


def grams(text):
    words = [w for w in text.split() if len(w) > 1 and w not in ("the", "of")]
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_tfidf(texts, share):
    counts = {d: {} for d, _ in texts}
    for d, text in texts:
        for g in grams(text):
            counts[d][g] = counts[d].get(g, 0) + 1
    df = {}
    for c in counts.values():
        for g in c:
            df[g] = df.get(g, 0) + 1
    n = len(texts)
    out = {}
    for d, c in counts.items():
        raw = {g: k * (math.log((1 + n) / (1 + df[g])) + 1) for g, k in c.items() if df[g] >= share * n}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out[d] = {g: x / norm for g, x in raw.items()}
    return out


def test_tfidf_and_neighbours(documents, texts):
    rows = documents
    weights = corpus.tfidf(rows, "d", "text", corpus.fit_terms(rows, "text", min_share=0.05))
    expected = brute_tfidf(texts, 0.05)
    got = {(r["d"], r["term"]): r["weight"] for r in weights.collect()}
    flat = {(d, g): w for d, c in expected.items() for g, w in c.items()}
    assert got.keys() == flat.keys()
    assert all(got[k] == pytest.approx(flat[k]) for k in flat)
    best = corpus.similar_documents(weights, weights.filter("d IN (0, 5)"), "d", 4).collect()
    for query in (0, 5):
        scores = sorted(
            (-round(sum(w * expected[query].get(g, 0) for g, w in c.items()), 9), d)
            for d, c in expected.items() if d != query and any(g in expected[query] for g in c)
        )[:4]
        assert [r["d"] for r in sorted(best, key=lambda r: r["rank"]) if r["query_id"] == query] == [d for _, d in scores]
    # Copies of the query come first, in order of their number, and the query itself never appears.
    assert [r["d"] for r in sorted(best, key=lambda r: r["rank"]) if r["query_id"] == 0][:2] == [60, 62]


def test_first_document_of_a_repeated_name(spark):
    df = spark.createDataFrame([("a", 5), ("a", 2), ("b", 9), (None, 1)], "n string, d int")
    assert sorted(tuple(r) for r in corpus.first_of_each_name(df, "n", "d").collect()) == [("a", 2), ("b", 9)]


def brute_bm25(queries, texts, k):
    tokens = {d: [w for w in t.split() if len(w) > 1] for d, t in texts}
    n, mean = len(tokens), sum(map(len, tokens.values())) / len(tokens)
    out = {}
    for q, text in queries:
        scores = {}
        for word in text.split():
            df = sum(word in t for t in tokens.values())
            for d, t in tokens.items():
                tf = t.count(word)
                if tf:
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    scores[d] = scores.get(d, 0) + idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t) / mean))
        out[q] = [d for _, d in sorted((-round(s, 6), d) for d, s in scores.items())[:k]]
    return out


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_bm25_with_and_without_broadcast(spark, request, documents, texts, threshold):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    request.addfinalizer(lambda: spark.conf.unset(setting))
    spark.conf.set(setting, threshold)
    asked = [(1, "w01 w02 w02"), (2, "w29 the"), (3, "unheard")]
    queries = spark.createDataFrame(asked, "q bigint, text string")
    got = corpus.bm25(queries, documents, "q", "d", 5).collect()
    for q, expected in brute_bm25(asked, texts, 5).items():
        assert [r["d"] for r in sorted(got, key=lambda r: r["rank"]) if r["q"] == q] == expected


def test_texts_are_not_shuffled(spark, tmp_path, texts):
    """Tables of many splits are read where they lie: no exchange carries the text column."""
    path = str(tmp_path / "docs")
    rows = spark.createDataFrame([(d, t, "en") for d, t in texts], "doc_id bigint, text string, lang string")
    rows.repartition(40).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # one split per file
    try:
        read = spark.read.schema("doc_id bigint, text string, lang string").parquet(path)
        assert spread(read).rdd.getNumPartitions() == read.rdd.getNumPartitions() > 8
        counted = corpus.with_terms(spread(read), "text", 1, 3, "doc_id")
        terms = corpus.fit_terms(spread(read), "text")
        tokens = read.select("doc_id", word_tokens(F.col("text")).alias("tokens"))
        words = vocabulary.build_vocabulary(tokens, "tokens")
        plans = [counted, terms, vocabulary.index_matrix(tokens, "doc_id", "tokens", words, 10)]
        asked = spark.createDataFrame([(1, "w01")], "q bigint, text string")
        corpus.bm25(asked, read, "q", "doc_id", 2).collect()
        for plan in plans:
            text = plan._jdf.queryExecution().executedPlan().toString()
            for line in text.splitlines():
                assert "Exchange" not in line or "text#" not in line
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rerank_with_a_scorer_of_ones_own(spark):
    queries = spark.createDataFrame([(1, "red blue")], "q bigint, text string")
    docs = spark.createDataFrame([(1, "red"), (2, "red blue"), (3, "green")], "d bigint, text string")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "q bigint, d bigint")
    by_overlap = corpus.rerank(pairs, queries, docs, "q", "d", 2).collect()
    assert [(r["d"], r["score"]) for r in sorted(by_overlap, key=lambda r: r["rank"])] == [(2, 1.0), (1, 0.5)]

    @F.pandas_udf("double")
    def length(query, passage):
        return passage.str.len().astype("float64")

    assert corpus.rerank(pairs, queries, docs, "q", "d", 1, scorer=length).first()["d"] == 2


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("max_values", [10_000, 9])
def test_nearest_equals_brute_force(spark, metric, max_values):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(300, 8))
    points[17] = points[3]
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")
    queries = rows.filter("vec_id IN (3, 40, 299)").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), F.array(F.lit(40)).alias("excluded"))
    got = vectors.nearest(rows.repartition(5), queries, 4, metric, max_values=max_values).collect()
    for q in (3, 40, 299):
        if metric == "l2":
            score = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        else:
            score = -(points @ points[q]) / np.linalg.norm(points, axis=1) / np.linalg.norm(points[q])
        score = np.round(score, 12)
        order = [i for i in np.lexsort((np.arange(300), score)) if i != 40][:4]
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == order


def test_analogy_leaves_out_its_inputs(spark):
    rows = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [1.0, 1.0]), (4, [-1.0, 0.0])],
                                 "vec_id bigint, embedding array<float>")
    examples = spark.createDataFrame([(9, 1, 1.0), (9, 2, 1.0)], "query_id bigint, vec_id bigint, sign double")
    asked = vectors.analogy_queries(spark, examples, rows)
    assert asked.first()["query_vector"] == pytest.approx([0.5, 0.5])
    best = vectors.nearest(rows, asked, 1, "cosine").first()
    assert (best["id"], best["score"]) == (3, pytest.approx(1.0))


def test_unknown_word_is_reported(spark):
    rows = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id bigint, embedding array<float>")
    asked = spark.createDataFrame([(1,), (8,)], "vec_id bigint")
    got = {r["query_id"]: (r["id"], r["status"]) for r in vectors.nearest_or_unknown(asked, rows, 3).collect()}
    assert got == {1: (2, "FOUND"), 8: (None, "UNKNOWN")}


SAMPLES = ["", "short", "x" * 2500, "a b " * 900, "one. two\nthree\n\n" * 200, "p" * 999 + "\n\n" + "q" * 1001, " \n ",
           "".join(random.Random(1).choices("ab .\n", k=9000))]


@pytest.mark.parametrize("text", SAMPLES, ids=range(len(SAMPLES)))
def test_recursive_chunks(text):
    chunks = chunks_of(text)
    covered = [False] * len(text)
    for chunk in chunks:
        start, end = chunk["start"], chunk["start"] + len(chunk["text"])
        assert text[start:end] == chunk["text"] and 0 < len(chunk["text"]) <= 1000
        covered[start:end] = [True] * (end - start)
    assert all(c or text[i].isspace() for i, c in enumerate(covered))
    ends = [(c["start"], c["start"] + len(c["text"])) for c in chunks]
    assert ends == sorted(ends)
    assert all(a[1] - b[0] <= 200 for a, b in zip(ends, ends[1:]))


def test_chunks_end_at_the_coarsest_border():
    first, second = "a" * 600, "b" * 600
    assert [c["text"] for c in chunks_of(f"{first}\n\n{second}")] == [first, second]


@pytest.mark.parametrize("n", [1, 1000, 1001, 1800, 1801])
def test_stride_chunks_equal_the_recursive_ones_on_solid_text(spark, n):
    df = spark.createDataFrame([(1, "z" * n), (2, "")], "d int, text string")
    stride = sorted((r["start"], r["text"]) for r in chunking.stride_chunks(df, "d").collect())
    assert stride == [(c["start"], c["text"]) for c in chunks_of("z" * n)]


def test_pages_of_chunks(spark):
    pages = spark.createDataFrame([(1, 1, "aaa\nbbb"), (1, 2, ""), (1, 3, "ccc")], "d int, page int, text string")
    spans = chunking.page_spans(pages, "d")
    assert sorted(tuple(r)[1:] for r in spans.collect()) == [(1, 0, 8), (2, 8, 9), (3, 9, 13)]
    chunks = spark.createDataFrame([(1, 0, 0), (1, 1, 7), (1, 2, 8), (1, 3, 9), (1, 4, 99), (2, 0, 0)],
                                   "d int, chunk_no int, start int")
    got = {(r["d"], r["chunk_no"]): r["page"] for r in chunking.attribute_pages(chunks, spans, "d").collect()}
    assert got == {(1, 0): "1", (1, 1): "1", (1, 2): "2", (1, 3): "3", (1, 4): "未知", (2, 0): "未知"}
