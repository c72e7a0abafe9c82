"""Sinks. Each writes from all tasks at once; none gathers rows on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import space_characters


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 with a header and without a byte order mark."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_sheets(frames: dict[str, DataFrame], folder: str) -> None:
    """One parquet folder per sheet."""
    for sheet, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{sheet}")


def write_report(df: DataFrame, template: str, path: str) -> None:
    """Text lines made by ``format_string`` from the columns in order."""
    df.select(F.format_string(template, *df.columns).alias("value")).write.mode("overwrite").text(path)


def write_merged_text(df: DataFrame, text: str, path: str) -> None:
    """One document per line, its characters set apart by spaces; line breaks inside become spaces."""
    line = F.regexp_replace(space_characters(F.col(text)), r"[\r\n]+", " ")
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_token_batches(df: DataFrame, tokens: str, batch: str, path: str) -> None:
    """Space-joined tokens, one document per line, one folder per batch."""
    # Rows of a batch meet in the same task so that a batch is one file.
    out = df.select(batch, F.array_join(tokens, " ").alias("value"))
    out.repartition(batch).write.mode("overwrite").partitionBy(batch).text(path)


def write_matrix(df: DataFrame, path: str, partition: tuple[str, ...] = ("split", "batch_id"),
                 rows_per_file: int = 20_000) -> None:
    """Label and padded index rows as parquet, at most ``rows_per_file`` documents in a file.

    Rows of a folder meet before they are written, else every task has a file in every folder; a large one is still
    several tasks.
    """
    df.hint("rebalance", *partition).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*partition).parquet(path)


def write_vector_store(chunks: DataFrame, path: str) -> None:
    chunks.select("chunk_id", "page", "text", "embedding").write.mode("overwrite").parquet(path)


def read_vector_store(spark, path: str) -> DataFrame:
    return spark.read.schema("chunk_id bigint, page int, text string, embedding array<float>").parquet(path)


def parallel_lists_json(df: DataFrame, order: str, columns: dict[str, str]) -> DataFrame:
    """A chart payload: one JSON object of parallel lists in the order of ``order``.

    For report frames (one row per day or district) only: the lists are gathered into a single row.
    """
    row = F.struct(F.col(order).alias("order_key"), *[F.col(c).alias(c) for c in columns.values()])
    sorted_rows = df.agg(F.array_sort(F.collect_list(row)).alias("rows"))
    lists = [F.col("rows").getField(c).alias(name) for name, c in columns.items()]
    return sorted_rows.select(F.to_json(F.struct(*lists)).alias("payload"))


def records_json(df: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """One JSON object per row, with the asked integer or float casts."""
    casts = casts or {}
    columns = [F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*columns)).alias("record"))
