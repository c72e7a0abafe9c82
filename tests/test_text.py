"""Text functions, labels, word indexes and tool calls."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemill.functions import text as tx
from tidemill.functions import values
from tidemill.functions.toolcalls import extract_tool_calls
from tidemill.operators import vocabulary as voc


def one(spark, text, function, *args):
    return spark.createDataFrame([(text,)], "t string").select(function(F.col("t"), *args).alias("x")).first()["x"]


def test_clean_english_joins_words_around_line_breaks(spark):
    assert one(spark, "The Grand\nHotel, at/the {PIER}; don't wait!", tx.clean_english) == "grandhotel pier dont wait"


def test_keep_cjk_and_character_tokens(spark):
    assert one(spark, "abc 你好 x 世界!", tx.keep_cjk) == "你好 世界"
    assert one(spark, "a你好", tx.character_tokens) == ["你", "好"]
    assert one(spark, "abc", tx.character_tokens) == []
    assert one(spark, "abc", tx.character_tokens, []) == [""]
    assert one(spark, "你a好", tx.clean_labelled_line) == "你 好"
    assert one(spark, "a\nb", tx.space_characters) == "a \n b "


def test_stop_words_keep_order_and_repeats(spark):
    assert one(spark, "b the b a_1 of x9", tx.content_words) == ["a_1", "x9"]
    assert one(spark, "hot hot the pool", tx.content_words) == ["hot", "hot", "pool"]


def test_segment_kinds(spark):
    assert one(spark, "Ab cd", tx.segment, "word", ["cd"]) == ["Ab"]
    with pytest.raises(ValueError):
        tx.segment(F.lit("x"), "line")


@pytest.mark.parametrize("n", [0, 1, 3, 4])
def test_padding(spark, n):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert df.select(tx.pad_tokens(F.col("w"), 3)).first()[0] == (words + ["<PAD>"] * 3)[:3]


@pytest.mark.parametrize("words", [[], ["a"], ["a", "b"], ["a", "b", "c", "a"]])
def test_ngrams(spark, words):
    df = spark.createDataFrame([(words,)], "w array<string>")
    expected = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert df.select(tx.ngrams(F.col("w"), 1, 3)).first()[0] == expected
    assert df.select(tx.ngrams(F.col("w"), 3)).first()[0] == [g for g in expected if g.count(" ") == 2]


def test_blank_lines_and_quoting(spark):
    assert one(spark, "  a \r\n\n \t\n b", tx.strip_blank_lines) == "a\nb"
    assert one(spark, "a b/你~*", tx.url_quote) == "a%20b/%E4%BD%A0~%2A"


def test_dates_codes_and_numbers(spark):
    df = spark.createDataFrame([("2023-02-01", "Sunday", "Cool Summer", 1234567.0)], "d string, w string, e string, x double")
    row = df.select(
        values.days_since(F.col("d").cast("date")), values.weekday_number(F.col("w")), values.event_code(F.col("e")),
        values.event_code(F.lit("none")), values.whole_number_text(F.col("x")), values.one_decimal_text(F.lit(2.25)),
        values.rate_per_100k(F.lit(1), F.lit(0)), values.ratio_percent(F.lit(1), F.lit(4)),
    ).first()
    assert tuple(row) == (31, 7, 3, 0, "1,234,567", row[5], None, 25.0) and row[5] in ("2.2", "2.3")


def test_labels_round_trip_with_unknown(spark):
    df = spark.createDataFrame([("星座",), ("AA",), ("财经",), ("教育",)], "l string")
    names = ["星座", "财经", "教育"]
    coded = df.select("l", values.encode_label(F.col("l"), names).alias("c"))
    assert [r["c"] for r in coded.collect()] == [0, -1, 1, 2]
    assert [r[0] for r in coded.select(values.decode_label(F.col("c"), names)).collect()] == ["星座", "unknow", "财经", "教育"]
    assert coded.select(values.one_hot(F.col("c"), 3)).collect()[2][0] == [0, 1, 0]


@pytest.fixture
def tokens(spark):
    return spark.createDataFrame([(1, ["a", "b", "a", "zz"]), (2, ["b", "a"]), (3, [])], "k int, t array<string>")


def test_vocabulary_and_index_rows(spark, tokens):
    vocabulary = voc.build_vocabulary(tokens, "t", 2)
    assert sorted((r["index"], r["word"], r["n"]) for r in vocabulary.collect()) == [(0, "a", 3), (1, "b", 2)]
    matrix = voc.index_matrix(tokens, "k", "t", vocabulary, 3)
    assert {r["k"]: r["idx"] for r in matrix.collect()} == {1: [0, 1, 0], 2: [1, 0, 0], 3: [0, 0, 0]}
    odd = spark.createDataFrame([(1, [1, 9, -1])], "k int, idx array<int>")
    assert voc.words_of_indexes(odd, "k", "idx", vocabulary, 3).first()["words"] == ["b", "<PAD>", "<PAD>"]


@pytest.mark.parametrize("held", [0, 2, 100])
def test_index_rows_of_words_no_task_keeps(spark, held):
    """However few words a task keeps, only words it lacks are rows of a join."""
    rows = [(i, [f"w{(i * j) % 9}" for j in range(i % 7)] + [None, "rare"][: i % 3]) for i in range(40)] + [(40, None), (7, ["w1", "w2"])]
    lists = spark.createDataFrame(rows, "k int, t array<string>")
    vocabulary = voc.build_vocabulary(lists.filter("k < 40"), "t", 2)
    index = {r["word"]: r["index"] for r in vocabulary.collect()}
    word = {i: w for w, i in index.items()}
    matrix = voc.index_matrix(lists, "k", "t", vocabulary, 6, held=held)
    got = {r["k"]: r["idx"] for r in matrix.collect()}
    for k, words in rows:
        if k != 7:
            found = [index.get(w, 0) for w in (words or [])[:6]]
            assert got[k] == found + [0] * (6 - len(found))
    assert len(got) == 41 and sorted(got[7]) == sorted([index["w1"], index["w2"], 0, 0, 0, 0])
    back = voc.words_of_indexes(spark.createDataFrame([(k, [*x, -1, 99, None]) for k, x in got.items()], "k int, idx array<int>"),
                                "k", "idx", vocabulary, 9, held=held)
    for r in back.collect():
        assert r["words"] == [word[i] for i in got[r["k"]]] + ["<PAD>"] * 3
    plan = matrix._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate posexplode" not in plan


def test_unknown_key_has_a_zero_vector(spark):
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "k int, v array<float>")
    got = {r["k"]: (r["v"], r["known"]) for r in voc.vectors_of_keys(keys, vectors, "k", "v", 2).collect()}
    assert got == {1: ([1.0, 2.0], True), 2: ([0.0, 0.0], False)}


CALLS = {
    "object": ('say <tool> {"name":"weather_tools.now","arguments":{"city":"x"}} </tool>', "now", '{"city":"x"}', "ok"),
    "text": ('<tool>{"name":"now","arguments":"{\\"city\\": \\"x\\"}"}</tool>', "now", '{"city": "x"}', "ok"),
    "first of two": ('<tool>{"name":"a","arguments":{}}</tool><tool>{"name":"b"}</tool>', "a", "{}", "ok"),
    "malformed": ("<tool>{name: }</tool>", None, None, "malformed"),
    "no end": ('<tool>{"name":"a"}', None, None, "none"),
    "no call": ("hello", None, None, "none"),
}


@pytest.mark.parametrize("case", CALLS)
def test_tool_calls(spark, case):
    content, name, arguments, status = CALLS[case]
    row = extract_tool_calls(spark.createDataFrame([(content,)], "content string")).first()
    assert (row["tool_name"], row["arguments"], row["call_status"]) == (name, arguments, status)


def test_structured_call_wins_over_the_tag(spark):
    df = spark.createDataFrame([("<tool>{}</tool>", '{"name":"f","arguments":{"a":1}}')], "content string, first string")
    row = extract_tool_calls(df, first_call="first").first()
    assert (row["tool_name"], row["arguments"], row["call_status"]) == ("f", '{"a":1}', "ok")
