"""Nested payloads, tool calls, parsed documents, files, the catalog and the event stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import url_quote
from tidemill.functions.toolcalls import extract_tool_calls
from tidemill.operators import frames, windows
from tidemill.session import scratch_path, written
from tidemill.sources import files, payloads, schemas, sinks, tables
from tidemill.sources.csv_ranges import read_csv_ranges
from tidemill.sources.tables import table
from tidemill.streaming import averages
from tidemill.streaming.daily import stream_daily_totals as run_stream


def event_payloads(spark, folder):
    """One weather-like payload per event: errors carry a failed status, sign-ups empty lists."""
    kind = F.col("event_type")
    live = F.array(F.struct(kind.alias("city"), F.get_json_object("props", "$.k").alias("temperature")))
    place = F.array(F.struct(F.col("user_id").cast("string").alias("id")))
    body = F.struct(
        F.when(kind == "error", "0").otherwise("1").alias("status"),
        F.when(kind == "signup", F.filter(place, lambda x: F.lit(False))).otherwise(place).alias("location"),
        F.struct(F.col("value").cast("string").alias("temp")).alias("now"),
        F.when(kind != "signup", live).alias("lives"),
    )
    return table(spark, folder, "events").select("event_id", F.to_json(body).alias("payload"))


def json_payload_extract(spark, folder):
    return payloads.parse_payloads(event_payloads(spark, folder)).select(
        "event_id", "location_id", F.col("current")["temp"].cast("double").alias("temp"), F.col("live.city").alias("city"),
        F.col("live.temperature").cast("int").alias("k"),
    )


def landed_variants(spark, folder):
    """Event payloads landed as files of JSON lines, some of other shapes and every eleventh one broken off."""
    number = F.col("event_id")
    whole = F.concat(F.lit('{"id":'), number.cast("string"), F.lit(',"kind":"'), F.col("event_type"), F.lit('","props":'),
                     F.col("props"), F.lit(',"tags":["'), F.col("event_type"), F.lit('",'), number.cast("string"), F.lit("]}"))
    line = (F.when(number % 11 == 0, F.expr("substring(whole, 1, length(whole) - 3)"))
            .when(number % 5 == 0, F.concat(F.lit('{"id":"'), number.cast("string"), F.lit('","props":[]}'))).otherwise(F.col("whole")))
    path = scratch_path(spark, "json-lines")
    table(spark, folder, "events").withColumn("whole", whole).select(line.alias("value")).write.text(path)
    return payloads.read_variants(spark, path)


def variant_payloads(spark, folder):
    """Fields of payloads without a declared schema, read from files."""
    return payloads.variant_fields(landed_variants(spark, folder), {
        "id": ("$.id", "bigint"), "kind": ("$.kind", "string"), "k": ("$.props.k", "int"), "first_tag": ("$.tags[0]", "string"),
        "tag_number": ("$.tags[1]", "bigint")})


def variant_quarantine(spark, folder):
    """Lines that are no JSON."""
    return payloads.quarantined(landed_variants(spark, folder)).select("raw")


def named_file(spark, folder):
    """The lines of the first file, by its name, of a folder of text files."""
    path = scratch_path(spark, "named")
    asia = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    asia.filter("r_name = 'ASIA'").select("n_name").coalesce(1).write.text(path)
    name = files.list_files(spark, path, "txt").agg(F.min("file_name")).first()[0]
    content = files.read_file(spark, path, name)
    return content.select(F.explode(F.split(F.rtrim("content"), "\n")).alias("nation")).filter("nation <> ''")


def catalog_sketches(spark, folder):
    """Different values per column, from sketches of each half of the rows, merged; and whether the estimate is near."""
    merged = []
    for name in ("customer", "orders", "lineitem"):
        rows = table(spark, folder, name)
        halves = rows.withColumn("half__", F.monotonically_increasing_id() % 2)
        stored = tables.column_sketches(halves.filter("half__ = 0").drop("half__"), name).unionByName(
            tables.column_sketches(halves.filter("half__ = 1").drop("half__"), name))
        exact = tables.exact_cardinalities(rows, name)
        merged.append(tables.merged_cardinalities(written(stored, "sketches")).join(exact, ["table_name", "column_name"]))
    near = F.abs(F.col("estimate") - F.col("n_values")) <= tables.SKETCH_ERROR * F.col("n_values")
    return reduce(DataFrame.unionByName, merged).select("table_name", "column_name", "n_values", near.alias("near"))


def props_extract(spark, folder):
    parsed = F.from_json("props", "k int")
    return table(spark, folder, "events").groupBy("event_type").agg(F.count(parsed["k"]).alias("n_k"),
                                                                  F.sum(parsed["k"]).alias("sum_k"))


def event_messages(spark, folder):
    """One assistant message per event: a call with object or text arguments, a broken call, or no call."""
    kind = F.col("event_type")
    plain = F.concat(F.lit('{"name":"weather_tools.'), kind, F.lit('","arguments":'), F.col("props"), F.lit("}"))
    quoted = F.concat(F.lit('{"name":"'), kind, F.lit('","arguments":"'), F.replace("props", F.lit('"'), F.lit('\\"')),
                      F.lit('"}'))
    text = (
        F.when(kind == "click", F.concat(F.lit("call <tool>\n"), plain, F.lit("\n</tool> done <tool>x</tool>")))
        .when(kind == "view", F.concat(F.lit("<tool>"), quoted, F.lit("</tool>")))
        .when(kind == "error", F.concat(F.lit("<tool>{broken "), plain, F.lit("</tool>")))
        .when(kind == "purchase", F.concat(F.lit("<tool>"), plain))
        .otherwise(F.lit("no call"))
    )
    return table(spark, folder, "events").select("event_id", text.alias("content"))


def tool_call_extract(spark, folder):
    found = extract_tool_calls(event_messages(spark, folder))
    return found.select("event_id", "tool_name", "arguments", "call_status",
                        F.get_json_object("arguments", "$.k").cast("int").alias("k"))


def tool_call_rounds(spark, folder):
    """The round every message belongs to: assistant messages up to and including it."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    step = (F.col("role") == "assistant").cast("bigint")
    return windows.running_total(rows, "conv_id", "turn", step, name="round_no")


def row_validation(spark, folder):
    """Events checked against the last day of the table and for their keys."""
    rows = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    last = rows.select(F.max("day")).scalar()
    rules = {
        "missing_user": F.col("user_id").isNotNull(),
        "missing_k": F.get_json_object("props", "$.k").isNotNull(),
        "not_today": F.col("day") == last,
        "no_value": F.col("value") > 0,
    }
    return frames.split_valid(rows, rules).select("event_id", "reject_reason")


def parsed_documents(spark, folder):
    """Documents as parsed-document JSON: five lines a page, table lines as tables, then read back."""
    lines = F.transform(F.split(F.col("text"), "\n", -1), lambda line, i: F.struct(
        F.when(~F.contains(line, F.lit("|")), line).alias("text"), (F.length(line) % 7 + 8).alias("font-size"),
        F.size(F.split(line, " ")).alias("token"),
        F.when(F.contains(line, F.lit("|")), F.concat(F.lit("|"), F.trim(line))).alias("table"), i.alias("i"),
    ))
    texts = frames.spread(table(spark, folder, "documents").select("doc_id", "text"))
    rows = texts.select("doc_id", lines.alias("lines"))
    numbers = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / 5).cast("int"))
    pages = F.transform(numbers, lambda p: F.struct(
        (p + 1).alias("page_num"), F.slice(F.col("lines"), p * 5 + 1, F.lit(5)).alias("content")))
    text = rows.select("doc_id", F.to_json(pages).alias("json"))
    return text.select("doc_id", F.from_json("json", schemas.PARSED_DOCUMENT).alias("pages"))


def parsed_page_profile(spark, folder):
    blocks = payloads.document_blocks(parsed_documents(spark, folder), keys=("doc_id",))
    return payloads.page_profile(blocks, keys=("doc_id",))


def table_block_cells(spark, folder):
    blocks = payloads.document_blocks(parsed_documents(spark, folder), keys=("doc_id",))
    return payloads.table_cells(blocks, keys=("doc_id", "page_num", "block_no")).select(
        "doc_id", "page_num", "block_no", "col_no", "cell"
    )


def url_quoted(spark, folder):
    return table(spark, folder, "pages").select("page_id", url_quote(F.col("url")).alias("quoted"))


def catalog_snapshot(spark, folder):
    """Rows and missing values of every column of every table."""
    named = {name: table(spark, folder, name) for name in schemas.TABLES}
    return tables.catalog_profile(named, cardinality=False).drop("data_type")


def catalog_cardinality(spark, folder):
    return tables.catalog_profile({name: table(spark, folder, name) for name in schemas.TABLES})


def table_columns(spark, folder):
    return frames.describe_columns(table(spark, folder, "lineitem")).select("position", "column_name", "data_type", "n_rows")


def sheet_counts(spark, folder):
    paths = {name: (f"{folder}/{name}.parquet", schemas.TABLES[name]) for name in ("orders", "lineitem")}
    return tables.sheet_row_counts(tables.sheets(spark, paths))


def landed_by_language(spark, folder):
    """Document ids landed as one file per language."""
    path = scratch_path(spark, "landed")
    rows = table(spark, folder, "documents").select("doc_id", "lang")
    rows.repartition("lang").write.partitionBy("lang").parquet(path)
    return path


def file_listing(spark, folder):
    listed = files.list_files(spark, landed_by_language(spark, folder), "*.parquet")
    return listed.select(files.parent_folder(F.col("path")).alias("folder"), "suffix").distinct()


def file_count(spark, folder):
    return files.count_files(spark, landed_by_language(spark, folder), "parquet")


def session_catalog(spark, folder):
    """The profile of the tables a session can name, found through its catalog."""
    prefix = "catalog_"
    tables.register_views(spark, folder, prefix=prefix)
    found = {n.removeprefix(prefix): df for n, df in tables.catalog_frames(spark).items() if n.startswith(prefix)}
    return tables.catalog_profile(found, cardinality=False).drop("data_type")


def sheet_roundtrip(spark, folder):
    """Two tables written as sheets, read back and counted."""
    path, names = scratch_path(spark, "sheets"), ("customer", "supplier")
    sinks.write_sheets({n: table(spark, folder, n) for n in names}, path)
    return tables.sheet_row_counts(tables.sheets(spark, {n: (f"{path}/{n}", schemas.TABLES[n]) for n in names}))


def partial_append(spark, folder):
    """Suppliers appended to customers; they have no market segment."""
    customers = table(spark, folder, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    return frames.append_partial(customers, table(spark, folder, "supplier").selectExpr("s_name AS name", "s_nationkey AS nation"))


def through_latin1(spark, texts, read=None):
    """(doc_id, text): whole texts, line breaks and quotes included, written as CSV in ISO-8859-1 and read back."""
    path = scratch_path(spark, "latin1")
    options = {"header": "true", "encoding": "ISO-8859-1", "quoteAll": "true", "escape": '"', "lineSep": "\n",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    # CSV does not tell an empty text from a missing one.
    texts.select("doc_id", F.col("text").isNull().alias("missing"), "text").write.options(**options).csv(path)
    schema = "doc_id bigint, missing boolean, text string"
    rows = read(spark, path, schema) if read else files.read_csv(spark, path, schema, line_sep="\n")
    return rows.select("doc_id", F.when(~F.col("missing"), F.coalesce("text", F.lit(""))).alias("text"))


def latin1_roundtrip(spark, folder):
    """Whole texts after they went through ISO-8859-1, white space marked."""
    marked = F.translate("text", " \t\r\n", "____").alias("marked")
    return through_latin1(spark, table(spark, folder, "documents")).select("doc_id", marked)


def latin1_texts(spark, folder):
    """Length and digest of every whole text that went through ISO-8859-1."""
    return through_latin1(spark, table(spark, folder, "documents")).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("digest"))


def latin1_ranges(spark, folder):
    """The same read in byte ranges, so that a large file is many tasks."""
    return through_latin1(spark, table(spark, folder, "documents"), read_csv_ranges).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("digest"))


def csv_roundtrip(spark, folder):
    """Customers written as CSV and read back under a declared schema."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(table(spark, folder, "customer"), path)
    return files.read_csv(spark, path, schemas.TABLES["customer"], encoding="UTF-8")


def merged_text(spark, folder):
    """Conversation texts merged to one line each, characters set apart; lines and characters read back."""
    path = scratch_path(spark, "merged")
    sinks.write_merged_text(table(spark, folder, "conversations").select("text"), "text", path)
    lines = files.read_lines(spark, path)
    return lines.agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def positive_negative(spark, folder):
    """Good and bad documents written as two line files and read as one labelled set."""
    base = scratch_path(spark, "sides")
    line = F.regexp_replace("text", r"[\r\n]+", " ").alias("value")
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    for side, quality in (("positive", 1), ("negative", 0)):
        rows.filter(F.col("quality") == quality).select(line).write.text(f"{base}/{side}")
    both = files.read_positive_negative(spark, f"{base}/positive", f"{base}/negative")
    return both.groupBy(F.array_join(F.transform("label", lambda x: x.cast("string")), ",").alias("label")).agg(
        F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


def labelled_corpus(spark, folder):
    """Documents written as lines into one folder per language, read back with the folder as label."""
    path = scratch_path(spark, "corpus")
    line = F.regexp_replace("text", r"[\r\n]+", " ").alias("value")
    table(spark, folder, "documents").select("lang", line).write.partitionBy("lang").text(path)
    corpus = files.read_labelled_lines(spark, path)
    counts = files.label_counts(corpus)
    return counts.withColumn("label", F.replace("label", F.lit("lang%3D"), F.lit("lang=")))


def report_lines(spark, folder):
    """A text report of rows per nation, written and read back."""
    path = scratch_path(spark, "report")
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    counts = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    sinks.write_report(counts.join(nations, "c_nationkey").select("n_name", "n"), "- %s: %d", path)
    return files.read_lines(spark, path)


def vector_store(spark, folder):
    """Chunk vectors saved with their pages and loaded again."""
    path = scratch_path(spark, "vectors")
    texts = table(spark, folder, "documents").select(F.col("doc_id").alias("chunk_id"), "text")
    stored = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), (F.col("label") + 1).alias("page"), "embedding"
    )
    sinks.write_vector_store(stored.join(texts, "chunk_id"), path)
    loaded = sinks.read_vector_store(spark, path)
    return loaded.groupBy("page").agg(F.count("*").alias("n_chunks"), F.sum(F.size("embedding")).alias("n_values"),
                                      F.sum(F.length("text")).alias("n_chars"))


def stream_moving_averages(spark, folder):
    """Daily events of every type with their seven-row average and growth, kept while files with all days come in."""
    kept = averages.stream_moving_averages(spark, table(spark, folder, "events"))
    return kept.withColumns({c: F.round(c, 6) for c in ("moving_avg", "growth_pct")})


def stream_daily_totals(spark, folder):
    return run_stream(spark, folder).withColumn("total_value", F.col("total_value").cast("double"))


QUERIES = {
    "json_payload_extract": json_payload_extract,
    "props_extract": props_extract,
    "tool_call_extract": tool_call_extract,
    "tool_call_rounds": tool_call_rounds,
    "row_validation": row_validation,
    "parsed_page_profile": parsed_page_profile,
    "table_block_cells": table_block_cells,
    "url_quoted": url_quoted,
    "catalog_snapshot": catalog_snapshot,
    "catalog_cardinality": catalog_cardinality,
    "catalog_sketches": catalog_sketches,
    "variant_payloads": variant_payloads,
    "variant_quarantine": variant_quarantine,
    "named_file": named_file,
    "table_columns": table_columns,
    "sheet_counts": sheet_counts,
    "file_listing": file_listing,
    "file_count": file_count,
    "csv_roundtrip": csv_roundtrip,
    "session_catalog": session_catalog,
    "sheet_roundtrip": sheet_roundtrip,
    "partial_append": partial_append,
    "latin1_roundtrip": latin1_roundtrip,
    "latin1_texts": latin1_texts,
    "latin1_ranges": latin1_ranges,
    "merged_text": merged_text,
    "positive_negative": positive_negative,
    "labelled_corpus": labelled_corpus,
    "report_lines": report_lines,
    "vector_store": vector_store,
    "stream_moving_averages": stream_moving_averages,
    "stream_daily_totals": stream_daily_totals,
}
