"""Nested JSON: API payloads, parsed documents and chunked documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources import schemas

LIVE_WEATHER = "struct<city:string,weather:string,temperature:string,winddirection:string,windpower:string," \
               "humidity:string,reporttime:string>"
PAYLOAD = f"status string, location array<struct<id:string>>, now map<string,string>, lives array<{LIVE_WEATHER}>"


def first_location_id(payload: Column) -> Column:
    """Id of the first location; null when the list is empty or absent."""
    return F.try_element_at(payload["location"], F.lit(1))["id"]


def current_conditions(payload: Column) -> Column:
    return payload["now"]


def first_live(payload: Column, ok_status: str = "1") -> Column:
    """First live entry of a payload whose status says success, else null."""
    return F.when(payload["status"] == ok_status, F.try_element_at(payload["lives"], F.lit(1)))


def parse_payloads(df: DataFrame, column: str = "payload", schema: str = PAYLOAD) -> DataFrame:
    """Adds ``parsed`` and the three extractions; text that is no JSON leaves them null."""
    parsed = df.withColumn("parsed", F.from_json(column, schema))
    return parsed.withColumns({
        "location_id": first_location_id(F.col("parsed")),
        "current": current_conditions(F.col("parsed")),
        "live": first_live(F.col("parsed")),
    })


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """(file, raw, payload): files of one JSON text per line, of any shape. A line that is no JSON has no payload."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"),
                        F.try_parse_json("value").alias("payload"))


def quarantined(variants: DataFrame) -> DataFrame:
    """(file, raw): the lines that are no JSON, as they came."""
    return variants.filter(F.col("payload").isNull()).select("file", "raw")


def variant_fields(variants: DataFrame, fields: dict[str, tuple[str, str]], *keep: str) -> DataFrame:
    """One column for each of {name: (path, type)}; what a payload lacks, or holds in another type, is missing."""
    good = variants.filter(F.col("payload").isNotNull())
    return good.select(*keep, *[F.try_variant_get("payload", path, kind).alias(name) for name, (path, kind) in fields.items()])


def read_parsed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files holding one JSON list of pages each."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        F.col("_metadata.file_path").alias("path"), F.from_json("value", schemas.PARSED_DOCUMENT).alias("pages")
    )


def document_blocks(parsed: DataFrame, pages: str = "pages", keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """One row per text or table block of a parsed document."""
    by_page = parsed.select(*keys, F.explode(pages).alias("page"))
    return by_page.select(*keys, "page.page_num", F.posexplode("page.content").alias("block_no", "block")).select(
        *keys, "page_num", "block_no", "block.text", F.col("block.`font-size`").alias("font_size"), "block.token",
        "block.table",
    )


def page_profile(blocks: DataFrame, keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """Blocks, tokens, mean content length and largest font per page."""
    content = F.coalesce("text", "table")
    return blocks.groupBy(*keys, "page_num").agg(
        F.count("*").alias("n_blocks"),
        F.count("table").alias("n_tables"),
        F.sum("token").alias("n_tokens"),
        F.bround(F.avg(F.length(content)), 2).alias("mean_length"),
        F.max("font_size").alias("max_font"),
    )


def read_chunked_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk of files that hold a document with its chunk list."""
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", schemas.CHUNKED_DOCUMENT).alias("doc"))
    return parsed.select("doc.url", "doc.title", F.explode("doc.raw").alias("chunk")).select(
        "url", "title", "chunk.content", F.col("chunk.metadata.chunk_id").alias("chunk_id"), "chunk.token"
    )


def table_cells(blocks: DataFrame, table: str = "table", keys: tuple[str, ...] = ()) -> DataFrame:
    """Cells of ``|a|b|`` table blocks with row and column positions; the text ``None`` marks an empty cell."""
    rows = blocks.filter(F.col(table).isNotNull()).select(
        *keys, F.posexplode(F.split(F.col(table), "\n")).alias("row_no", "row")
    )
    inner = F.regexp_replace(F.trim("row"), r"^\||\|$", "")
    cells = rows.select(*keys, "row_no", F.posexplode(F.split(inner, r"\|", -1)).alias("col_no", "cell"))
    return cells.withColumn("cell", F.nullif(F.trim("cell"), F.lit("None")))
