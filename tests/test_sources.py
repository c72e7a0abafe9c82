"""Files, payloads, sinks, the stream and the models."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemill import session
from tidemill.operators import models
from tidemill.plans import payloads as payload_plans
from tidemill.sources import files, payloads, schemas, sinks, tables
from tidemill.streaming import daily


@pytest.fixture
def corpus(tmp_path):
    for label, name, text in (("sport", "a.txt", " one \n\n two"), ("sport", "b.txt", "x"), ("news", "c.txt", "y"),
                              ("news", "d.md", "z")):
        folder = tmp_path / label
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_listing(spark, corpus):
    names = [r["file_name"] for r in files.list_files(spark, corpus, "*.txt").collect()]
    assert names == ["c.txt", "a.txt", "b.txt"]
    assert files.count_files(spark, corpus).first()["n_files"] == 4
    assert files.count_files(spark, corpus + "/news", "txt", recursive=False).first()["n_files"] == 1
    assert files.read_file(spark, corpus, "b.txt").first()["content"] == "x"
    assert files.read_file(spark, corpus, "none.txt").count() == 0


def test_labelled_documents(spark, corpus):
    docs = files.read_labelled_corpus(spark, corpus)
    assert {(r["label"], r["content"]) for r in docs.collect()} == {
        ("sport", "one\ntwo"), ("sport", "x"), ("news", "y"), ("news", "z")}
    assert [tuple(r) for r in files.label_counts(docs).collect()] == [("news", 2), ("sport", 2)]


def test_lines_and_sides(spark, corpus):
    assert [r["line"] for r in files.read_lines(spark, corpus + "/sport/a.txt").collect()] == [" one", "", " two"]
    assert [r["line"] for r in files.read_lines(spark, corpus + "/sport/a.txt", "both").collect()] == ["one", "", "two"]
    sides = files.read_positive_negative(spark, corpus + "/sport/b.txt", corpus + "/news/c.txt")
    assert {(r["value"], tuple(r["label"])) for r in sides.collect()} == {("x", (0, 1)), ("y", (1, 0))}


def test_page_lines(spark):
    pages = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, "c")], "page int, text string")
    assert [(r["page"], r["line"]) for r in files.page_lines(pages).collect()] == [(1, "a"), (1, "b"), (3, "c")]


def test_latin_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "hotels.csv"
    path.write_bytes('name,desc\n"Café","two\nlines"\n'.encode("latin-1"))
    assert tuple(files.read_csv(spark, str(path), schemas.HOTEL).first()) == ("Café", "two\nlines")


PAYLOADS = {
    "full": ({"status": "1", "location": [{"id": "7"}, {"id": "8"}], "now": {"temp": "3"}, "lives": [{"city": "x"}]},
             "7", "x"),
    "no location": ({"status": "1", "lives": [{"city": "x"}]}, None, "x"),
    "empty lives": ({"status": "1", "location": [], "lives": []}, None, None),
    "wrong status": ({"status": "0", "lives": [{"city": "x"}]}, None, None),
}


@pytest.mark.parametrize("case", PAYLOADS)
def test_payloads(spark, case):
    body, location, city = PAYLOADS[case]
    row = payloads.parse_payloads(spark.createDataFrame([(json.dumps(body),)], "payload string")).first()
    assert (row["location_id"], row["live"]["city"] if row["live"] else None) == (location, city)


def test_broken_payload(spark):
    assert payloads.parse_payloads(spark.createDataFrame([("{no",)], "payload string")).first()["location_id"] is None


def test_parsed_and_chunked_documents(spark, tmp_path):
    pages = [{"page_num": 1, "content": [{"text": "ab", "font-size": 8, "token": 2},
                                         {"table": "|a|None|\n|b|c|", "token": 4}]}]
    (tmp_path / "doc").write_text(json.dumps(pages, indent=1), encoding="utf-8")
    blocks = payloads.document_blocks(payloads.read_parsed_documents(spark, str(tmp_path / "doc")))
    assert [(r["page_num"], r["block_no"], r["text"], r["font_size"], r["token"]) for r in blocks.collect()] == [
        (1, 0, "ab", 8, 2), (1, 1, None, None, 4)]
    profile = payloads.page_profile(blocks).first()
    assert (profile["n_blocks"], profile["n_tables"], profile["n_tokens"], profile["max_font"]) == (2, 1, 6, 8)
    cells = payloads.table_cells(blocks, keys=("page_num",)).collect()
    assert [(r["row_no"], r["col_no"], r["cell"]) for r in cells] == [(0, 0, "a"), (0, 1, None), (1, 0, "b"), (1, 1, "c")]
    chunked = {"url": "u", "title": "t", "raw": [{"content": "c", "token": 1, "metadata": {"chunk_id": 0}}]}
    (tmp_path / "chunked").write_text(json.dumps(chunked), encoding="utf-8")
    assert tuple(payloads.read_chunked_documents(spark, str(tmp_path / "chunked")).first()) == ("u", "t", "c", 0, 1)


def test_sheets_reports_and_lists(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    sinks.write_sheets({"one": a, "two": a.limit(1)}, str(tmp_path / "book"))
    read = tables.sheets(spark, {s: (f"{tmp_path}/book/{s}", "k int, v string") for s in ("one", "two")})
    assert {tuple(r) for r in tables.sheet_row_counts(read).collect()} == {("one", 2), ("two", 1)}
    sinks.write_report(a, "%d=%s", str(tmp_path / "report"))
    assert {r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()} == {"1=x", "2=y"}
    lists = sinks.parallel_lists_json(a.orderBy(F.desc("k")), "k", {"ks": "k", "vs": "v"}).first()["payload"]
    assert json.loads(lists) == {"ks": [1, 2], "vs": ["x", "y"]}


def test_matrix_files_are_bounded(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("label"), F.array(F.lit(1)).alias("idx"),
                                F.lit("train").alias("split"), F.lit(0).alias("batch_id")).coalesce(1)
    sinks.write_matrix(df, str(tmp_path / "m"), rows_per_file=20)
    assert files.count_files(spark, str(tmp_path / "m"), "parquet").first()["n_files"] == 3


def test_queries_with_parameters_and_targets(spark):
    spark.createDataFrame([(1, "a"), (2, "b' OR 1=1")], "k int, v string").createOrReplaceTempView("param_rows")
    assert tables.sql_scan(spark, "SELECT k FROM param_rows WHERE v = :v", v="b' OR 1=1").first()["k"] == 2
    with pytest.raises(ValueError):
        tables.target_scan(spark.table("param_rows"), ["k"], "k; DROP", ("v",))
    assert "param_rows" in tables.catalog_frames(spark)


class FakeSession:
    """A session with a chosen setting, context folder and master."""

    def __init__(self, setting=None, folder=None, master="spark://host:7077"):
        self.conf = self.sparkContext = self
        self.setting, self.folder, self.master = setting, folder, master

    def get(self, name, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder():
    assert session.shared_folder(FakeSession("hdfs://x/shared/")) == "hdfs://x/shared"
    assert session.shared_folder(FakeSession(folder="hdfs://x/context")) == "hdfs://x/context"
    with pytest.raises(ValueError):
        session.shared_folder(FakeSession())
    local = FakeSession(master="local[8]")
    assert session.shared_folder(local) == session.shared_folder(local) == local.folder


def event(i, day, hour=1):
    return (i, dt.datetime(2024, 1, day, hour), 1, "click", float(i), "{}")


def days_of(totals):
    return {r["day"].day: r["n_events"] for r in totals.collect()}


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    columns = schemas.TABLES["events"]
    stream = lambda: daily.event_stream(spark, source, "*.parquet")
    spark.createDataFrame([event(i, 1 + i // 4) for i in range(12)], columns).write.mode("append").parquet(source)
    daily.run_daily_totals(stream(), state)
    assert days_of(daily.current_totals(spark, state)) == {1: 4, 2: 4, 3: 4}
    more = [event(20, 3), event(21, 9), event(22, 1)]  # days long past count as well
    spark.createDataFrame(more, columns).write.mode("append").parquet(source)
    daily.run_daily_totals(stream(), state)
    assert days_of(daily.current_totals(spark, state)) == {1: 5, 2: 4, 3: 5, 9: 1}


def test_stream_takes_files_in_any_order_and_number(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    columns = schemas.TABLES["events"]
    for day in (9, 2, 1):  # newest days first, one file each
        rows = spark.createDataFrame([event(10 * day + i, day) for i in range(4)], columns).coalesce(1)
        rows.write.mode("append").parquet(source)
    daily.run_daily_totals(daily.event_stream(spark, source, "*.parquet", files_per_trigger=1), state)
    batch = spark.read.schema(columns).parquet(source).groupBy(F.to_date("ts").alias("day")).agg(*daily.totals())
    streamed = daily.current_totals(spark, state)
    assert days_of(streamed) == {1: 4, 2: 4, 9: 4}
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_stream_equals_batch(spark, small, zone, request):
    request.addfinalizer(lambda: spark.conf.set("spark.sql.session.timeZone", "UTC"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    events = tables.table(spark, small, "events")
    batch = events.groupBy(F.to_date("ts").alias("day")).agg(*daily.totals())
    streamed = daily.stream_daily_totals(spark, small)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


@pytest.fixture
def park(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(i), 10 + i % 7, 5 + i % 5, 3 + i % 3, 0 if i % 2 else 1) for i in range(60)]
    df = spark.createDataFrame(rows, "date date, ap_attendance int, ticket_attendance int, "
                                     "promotional_ticket_attendance int, marquee_event int")
    revenue = F.col("ap_attendance") * 4 + F.col("ticket_attendance") * 2 - F.col("promotional_ticket_attendance")
    return df.withColumn("total_fb_revenue", revenue + models.days_since(F.col("date")) * 0.5)


def test_least_squares_finds_the_coefficients(park):
    got = {r["feature"]: r["value"] for r in models.spend_drivers(park, 1).collect()}
    assert got == pytest.approx({"ap_attendance": 4, "ticket_attendance": 2, "promotional_ticket_attendance": -1,
                                 "date_diff": 0.5}, abs=1e-6)
    only = models.spend_drivers(park, 0, ["ap_attendance"])
    assert {r["feature"] for r in only.collect()} == {"ap_attendance", "date_diff"}
    sentence = models.conclusion(models.spend_drivers(park, 1)).first()[0]
    assert "ap_attendance, ticket_attendance, date_diff" in sentence and sentence.endswith("4.0, 2.0, 0.5")


def test_relative_importance_and_threshold(spark):
    df = spark.createDataFrame([("a", 4.0), ("b", 0.2), ("c", 2.0)], "feature string, value double")
    kept = models.important_features(models.relative_importance(df)).collect()
    assert [(r["feature"], r["relative"]) for r in kept] == [("a", 100.0), ("c", 50.0)]


def test_one_hot_columns(spark):
    df = models.one_hot_columns(spark.createDataFrame([("x",), (None,)], "c string"), "c", ["x", "y"])
    assert [tuple(r)[1:] for r in df.collect()] == [(1, 0), (0, 0)]


def test_tree_is_repeatable_and_bounded(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(i), "Monday", 100 + i, 40, 20.0, 30.0, 10.0, float(i % 9)) for i in range(80)]
    df = spark.createDataFrame(rows, "date date, week_days string, total_attendance int, ap_attendance int, "
                                     "max_temperature double, beijing_guest_ratio double, operating_hours double, "
                                     "total_fb_revenue double")
    features = models.tree_features(df, "total_fb_revenue")
    a, mse = models.fit_tree(features, "total_fb_revenue")
    b, _ = models.fit_tree(features.repartition(5), "total_fb_revenue")
    assert a.depth <= 4 and models.tree_rules(a, spark).collect() == models.tree_rules(b, spark).collect()
    assert mse.first()["n_test"] + 0 > 0 and mse.first()["mse"] >= 0
    assert sum(r["importance"] for r in models.tree_importance(a, spark).collect()) == pytest.approx(1)


def test_word_vectors(spark):
    df = spark.createDataFrame([(["a", "b", "c"] * 5,)] * 20, "t array<string>")
    model = models.train_word_vectors(df, "t", dimension=8, min_count=1, partitions=2)
    assert model.getVectors().count() == 3
    assert all(-1.0 <= r["similarity"] <= 1.0001 for r in model.findSynonyms("a", 2).collect())


def test_whole_texts_through_latin1(spark):
    long = "x" * 60 + ' é "quoted", a\\ \\" and\r\nlines\rto the\n\nend ' + "ÿ" * 5000
    rows = [(1, long), (2, '"'), (3, " lead and trail\t"), (4, ""), (5, "\n\r\n"), (6, "#,\\"), (7, None)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    for order in (texts.coalesce(1), texts.orderBy(F.desc("doc_id")).coalesce(1)):
        assert sorted(map(tuple, payload_plans.through_latin1(spark, order).collect())) == rows


def test_matrix_folders_hold_one_file(spark, tmp_path):
    """Rows of a folder meet before they are written, however many tasks hold them."""
    rows = spark.createDataFrame([(i, i % 3, [i, 0], "train", i % 5) for i in range(200)],
                                 "doc_id bigint, label int, idx array<int>, split string, batch_id bigint").repartition(8)
    path = str(tmp_path / "matrix")
    sinks.write_matrix(rows, path)
    assert len(list((tmp_path / "matrix").rglob("*.parquet"))) == 5
    assert sorted(r.doc_id for r in spark.read.parquet(path).collect()) == list(range(200))
