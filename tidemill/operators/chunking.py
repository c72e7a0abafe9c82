"""Documents to chunks, and chunks to the pages they begin on."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.splitting import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, chunks_of
from tidemill.operators.frames import numbered_entries
from tidemill.operators.joins import interval_lookup
from tidemill.session import small_batches


def recursive_chunks(df: DataFrame, key: str, text: str = "text", size: int = CHUNK_SIZE,
                     overlap: int = CHUNK_OVERLAP, separators: Sequence[str] = SEPARATORS) -> DataFrame:
    """(key, chunk_no, start, text): chunks that end at paragraph, line, sentence or word borders."""
    separators = tuple(separators)
    small_batches(df.sparkSession)
    fields = T.StructType([df.schema[key], *T.StructType.fromDDL("chunk_no int, start int, text string").fields])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from chunk_batches(batch, size, overlap, separators)

    return df.select(key, F.col(text).alias("whole")).mapInArrow(split, fields)


CHUNK_BATCH = 4 << 20  # characters of text whose chunks are held at once


def chunk_batches(batch: pa.RecordBatch, size: int, overlap: int, separators: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The chunks of a batch (key, whole), handed on whenever those of ``CHUNK_BATCH`` characters are made."""
    names = [batch.schema.names[0], "chunk_no", "start", "text"]
    rows, numbers, starts, texts, held = [], [], [], [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int32()),
            pa.array(texts, pa.string())], names)

    for i in range(batch.num_rows):
        found = chunks_of(batch.column(1)[i].as_py(), size, overlap, separators)
        rows += [i] * len(found)
        numbers += range(len(found))
        starts += [c["start"] for c in found]
        texts += [c["text"] for c in found]
        held += sum(len(c["text"]) for c in found)
        if held >= CHUNK_BATCH:
            yield made()
            rows, numbers, starts, texts, held = [], [], [], [], 0
    if rows:
        yield made()


def chunk_flags(chunks: DataFrame, documents: DataFrame, key: str, text: str = "text", size: int = CHUNK_SIZE,
                overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """What chunks must satisfy, per document: each is the text at its place and no longer than ``size``, neighbours
    share at most ``overlap`` characters, and nothing but blanks lies outside all chunks."""
    along = Window.partitionBy(key).orderBy("start")
    placed = chunks.select(key, "start", F.col("text").alias("chunk"), (F.col("start") + F.length("text")).alias("end"))
    near = placed.withColumns({"before": F.coalesce(F.lag("end").over(along), F.lit(0)), "after": F.lead("start").over(along)})
    whole = near.join(documents.select(key, F.col(text).alias("whole")), key)

    def blank(start: Column, length: Column) -> Column:
        return ~F.substring(F.col("whole"), start + 1, F.greatest(length, F.lit(0))).rlike(r"\S")

    rest = F.when(F.col("after").isNull(), blank(F.col("end"), F.length("whole") - F.col("end"))).otherwise(F.lit(True))
    return whole.groupBy(key).agg(
        F.bool_and(F.substring(F.col("whole"), F.col("start") + 1, F.length("chunk")) == F.col("chunk")).alias("in_place"),
        F.bool_and(F.length("chunk") <= size).alias("sized"),
        F.bool_and(F.col("before") - F.col("start") <= overlap).alias("overlapping"),
        F.bool_and(blank(F.col("before"), F.col("start") - F.col("before")) & rest).alias("covered"),
    )


def stride_chunks(df: DataFrame, key: str, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
                  ) -> DataFrame:
    """(key, chunk_no, start, text): windows of fixed size, expressed in columns alone."""
    step = size - overlap
    length = F.length(text)
    last = F.greatest(F.ceil((length - size) / step), F.lit(0)).cast("int")
    # The pieces are cut inside the row, so the whole text is not repeated for each of them.
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        (i * step).alias("start"), F.substring(F.col(text), i * step + 1, F.lit(size)).alias("text")))
    cut = df.filter(length > 0).select(key, pieces.alias("pieces"))
    return numbered_entries(cut, "pieces", "chunk_no", "piece", key).select(key, "chunk_no", "piece.start", "piece.text")


def pages_of_lines(df: DataFrame, key: str, text: str, lines_per_page: int) -> DataFrame:
    """(key, page, text): a text laid out as pages of a fixed number of lines, pages counted from 1."""
    lines = df.select(key, F.split(F.col(text), "\n", -1).alias("lines"))
    last = F.ceil(F.size("lines") / lines_per_page).cast("int") - 1
    pages = F.transform(F.sequence(F.lit(0), last), lambda p: F.array_join(
        F.slice(F.col("lines"), p * lines_per_page + 1, F.lit(lines_per_page)), "\n"))
    laid = lines.select(key, pages.alias("pages"))
    return numbered_entries(laid, "pages", "place", "text", key).select(
        key, (F.col("place") + 1).alias("page"), "text"
    )


def page_spans(pages: DataFrame, key: str, page: str = "page", text: str = "text") -> DataFrame:
    """(key, page, page_start, page_end): character offsets of each page in the text of its document.

    Pages are one line break apart. One document's pages form one window group.
    """
    sized = pages.select(key, page, F.length(text).alias("size"))
    before = Window.partitionBy(key).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("size") + 1).over(before), F.lit(0))
    return sized.select(key, page, start.alias("page_start"), (start + F.col("size") + 1).alias("page_end"))


def attribute_pages(chunks: DataFrame, spans: DataFrame, key: str, page: str = "page", unknown: str = "未知",
                    width: int = 2000) -> DataFrame:
    """Adds the page each chunk begins on, as text; ``unknown`` where no page holds the offset."""
    found = interval_lookup(chunks, spans, [key], "start", "page_start", "page_end", width, "left")
    return found.withColumn(page, F.coalesce(F.col(page).cast("string"), F.lit(unknown))).drop("page_start", "page_end")


def source_pages(retrieved: DataFrame, query: str, *page: str) -> DataFrame:
    """The distinct pages behind each answer."""
    return retrieved.select(query, *page).distinct()


def chunk_listing(best: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Retrieved chunk ids with their text and metadata."""
    return best.join(chunks, key)
