"""File listings and text sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import strip_blank_lines
from tidemill.operators.frames import numbered_entries


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_folder(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def suffix(path: Column) -> Column:
    """Text after the last dot of the file name; the whole name when it holds no dot."""
    return F.element_at(F.split(base_name(path), r"\."), -1)


def list_files(spark: SparkSession, folder: str, extension: str = "ALL", recursive: bool = True) -> DataFrame:
    """Files of a folder with their length, sorted by path. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    wanted = extension.split(".")[-1]
    if wanted != "ALL":
        reader = reader.option("pathGlobFilter", f"*.{wanted}")
    return (
        reader.load(folder)
        .select("path", base_name(F.col("path")).alias("file_name"), suffix(F.col("path")).alias("suffix"), "length")
        .orderBy("path")
    )


def count_files(spark: SparkSession, folder: str, extension: str = "ALL", recursive: bool = True) -> DataFrame:
    return list_files(spark, folder, extension, recursive).agg(F.count("*").alias("n_files"))


def read_file(spark: SparkSession, folder: str, file_name: str) -> DataFrame:
    """The whole content of one named text file; an empty frame when the folder holds no such file."""
    return (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(base_name(F.col("_metadata.file_path")).alias("file_name"), F.col("value").alias("content"))
        .filter(F.col("file_name") == file_name)
    )


def read_lines(spark: SparkSession, path: str, strip: str = "right") -> DataFrame:
    """One row per line; ``strip`` is ``right`` for plain line files and ``both`` for stop-word files."""
    trim = {"right": r"\s+$", "both": r"^\s+|\s+$"}[strip]
    return spark.read.text(path).select(F.regexp_replace("value", trim, "").alias("line"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files with stripped lines and without blank ones."""
    return (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), strip_blank_lines(F.col("value")).alias("content"))
    )


def read_labelled_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Documents labelled with the name of the folder they lie in."""
    return read_documents(spark, path).withColumn("label", parent_folder(F.col("path")))


def read_labelled_lines(spark: SparkSession, path: str) -> DataFrame:
    """One document per line, labelled with the name of the folder its file lies in."""
    lines = spark.read.format("text").option("recursiveFileLookup", "true").load(path)
    return lines.select(parent_folder(F.col("_metadata.file_path")).alias("label"), F.col("value").alias("content"))


def label_counts(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("label").agg(F.count("*").alias("n_docs")).orderBy(F.desc("n_docs"), "label")


def read_positive_negative(spark: SparkSession, positive: str, negative: str) -> DataFrame:
    """Two line files as one labelled set: [0,1] marks a positive line, [1,0] a negative one."""
    def side(path: str, mark: list[int]) -> DataFrame:
        return spark.read.text(path).select("value", F.array(*map(F.lit, mark)).alias("label"))

    return side(positive, [0, 1]).unionByName(side(negative, [1, 0]))


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "ISO-8859-1", line_sep: str | None = None) -> DataFrame:
    """A CSV file with quoted line breaks in a given character encoding.

    ``multiLine`` makes every file one task; land large exports as many files. Without ``line_sep`` the reader guesses
    the ends of rows, also from line breaks inside quotes, and may change those.
    """
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return (
        reader.schema(schema)
        .option("header", "true")
        .option("encoding", encoding)
        .option("multiLine", "true")
        .option("escape", '"')
        .csv(path)
    )


def page_lines(pages: DataFrame, page: str = "page", text: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of page text, each carrying the number of its page; empty pages give no line."""
    filled = pages.filter(F.length(text) > 0)
    return numbered_entries(filled, F.split(F.col(text), "\n", -1), "line_no", "line", *keys, page)
