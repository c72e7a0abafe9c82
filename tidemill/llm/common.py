"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import written

BROADCAST_LIMIT = 200_000  # rows of a written table that may be sent to every task


ARROW_ROWS, ARROW_BYTES = (f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch"))
BATCH_ROWS = 1000  # some megabytes of text, held several times over on both sides of a Python worker
BATCH_BYTES = 8 << 20  # a batch of long texts ends with the row that passes so many bytes


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ``BATCH_ROWS``, unless it has fewer rows set, and by ``BATCH_BYTES``."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)


def documents_of(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only (doc_id, text); a missing text counts as empty. Other columns, whatever their names, are left out."""
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bounded_broadcast(table: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A written table, marked for broadcast only when it is counted to have at most ``limit`` rows."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary column end to end, and the n+1 offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = column.cast(pa.large_binary())
    offsets = np.frombuffer(large.buffers()[1], dtype=np.int64)[large.offset: large.offset + len(large) + 1]
    data = large.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int, rows: int = 1 << 30
           ) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about ``limit`` bytes of ``column`` and ``rows`` rows, one at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
            end = min(end, start + rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse among 64-bit numbers
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACES = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8))


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``BASE`` and of its inverse."""
    steps = np.ones((2, n), dtype=np.uint64)
    steps[0, 1:], steps[1, 1:] = BASE, INVERSE
    return tuple(np.multiply.accumulate(steps, axis=1))


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` reads the hash of any span."""
    terms = (raw.astype(np.uint64) + np.uint64(1)) * powers(room(len(raw)))[0][: len(raw)]
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])


def room(n: int) -> int:
    """The next power of two, so that few tables of powers are made."""
    return 1 << max(10, int(n).bit_length())


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(room(len(sums)))[1][starts])


def word_edges(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space and ends of texts."""
    blank = SPACES[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    first[edges] = ~blank[edges]
    last = ~blank
    last[:-1] &= blank[1:]
    last[edges - 1] = ~blank[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_spans(raw: np.ndarray, offsets: np.ndarray, block: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Words between ASCII white space and ends of texts, block by block: (text number, start, end, 64-bit hash).

    A word comes with the block in which it ends. What a block holds of an unfinished word is carried into the next one,
    so a word of any length has one hash, wherever the blocks fall.
    """
    held = None  # start of the unfinished word and its hash so far, before mixing
    for start in range(0, len(raw), block):
        part = raw[start: start + block]
        stop = start + len(part)
        starts, ends = word_edges(part, offsets - start)
        sums = prefix_hash(part)
        values = (sums[ends] - sums[starts]) * powers(room(len(sums)))[1][starts]
        starts, ends = starts + start, ends + start
        if held:
            shift = pow(int(BASE), start - held[0], 1 << 64)
            starts[0], values[0] = held[0], np.uint64((held[1] + shift * int(values[0])) % (1 << 64))
            held = None
        if stop < len(raw) and len(ends) and ends[-1] == stop and not SPACES[raw[stop]] and not (offsets == stop).any():
            held = int(starts[-1]), int(values[-1])
            starts, ends, values = starts[:-1], ends[:-1], values[:-1]
        yield np.searchsorted(offsets, starts, side="right") - 1, starts, ends, mixed(values)


def kept_rows(docs: DataFrame, decisions: DataFrame, content_key: Column, id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    ``decisions`` is a written table with one row per document: doc_id, content_key, kept. Rows are told by both.
    Where a kept row has twins with its own doc_id and content, one of them stays.
    """
    per_row = decisions.groupBy("doc_id", "content_key").agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    marks = written(per_row.filter(~F.col("stays") | (F.col("n") > 1)).select(
        F.col("doc_id").alias("doc_id__"), F.col("content_key").alias("content_key__"), "stays"), "marks")
    own = {"own_id__": F.col(f"`{id_column}`").cast("long"), "own_key__": content_key}
    same = F.col("own_id__").eqNullSafe(F.col("doc_id__")) & (F.col("own_key__") == F.col("content_key__"))
    left = docs.withColumns(own).join(bounded_broadcast(marks.filter(~F.col("stays"))), same, "left_anti")
    twins = marks.filter("stays")
    if not twins.isEmpty():
        twins = bounded_broadcast(twins)
        once = left.join(twins, same, "left_semi").dropDuplicates(list(own))
        left = left.join(twins, same, "left_anti").unionByName(once)
    return left.drop(*own)
