"""CSV with quoted line breaks, read in byte ranges, so that one large file is many tasks.

A line break ends a row only outside quotes, and a task that starts in the middle of a file cannot know where it is. So
each range is read under both assumptions, that it starts outside quotes and inside: that gives it a function from the
state before to the state after. Functions of ranges compose associatively; a scan over them, one small row for each
range, tells every range how it really starts. A second reading cuts the rows. A row that reaches over ranges leaves a
piece in each, and only those pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import written


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted value is still open at the end of a line. Quotes open a value only as its first character."""
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1: at + 2] == b'"':
                at += 2
                continue
            inside = False
            at += 1
        elif line[at: at + 1] == b'"':
            inside = True
            at += 1
            continue
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): lines between line feeds as bytes, with the range they were read in, in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"))


def range_functions(lines: DataFrame) -> DataFrame:
    """(file, start, from_outside, from_inside): whether each range ends inside quotes for both ways it may start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, after = None, [False, True]
        for batch in batches:
            for place, value in zip(places(batch), batch.column("value"), strict=True):
                if place != at:
                    if at:
                        yield row(at, after)
                    at, after = place, [False, True]
                line = value.as_buffer().to_pybytes()
                if b'"' in line:
                    after = [ends_inside(line, state) for state in after]
        if at:
            yield row(at, after)

    def row(at: tuple[int, int], after: list[bool]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": at[0], "start": at[1], "from_outside": after[0], "from_inside": after[1]}])

    return lines.mapInArrow(run, "file long, start long, from_outside boolean, from_inside boolean")


def places(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    return zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True)


def inside_at_start(functions: DataFrame) -> DataFrame:
    """(file, start) of the ranges that start inside quotes.

    A range whose end does not depend on its start settles the state; from there on, each range that turns the state
    around counts.
    """
    settled = F.col("from_outside") == F.col("from_inside")
    turned = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = functions.withColumns({
        "group": F.coalesce(F.sum(settled.cast("int")).over(before), F.lit(0)),
        "value": F.coalesce(F.last(F.when(settled, F.col("from_outside")), ignorenulls=True).over(before), F.lit(False)),
        "turned": F.when(settled, 0).otherwise(turned), "before": F.lag(F.when(settled, 0).otherwise(turned), 1, 0).over(
            Window.partitionBy("file").orderBy("start"))})
    since = Window.partitionBy("file", "group").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = (F.sum("before").over(since) + F.col("value").cast("int")) % 2 == 1
    return known.withColumn("inside", state).filter("inside").select("file", "start")


HEAD, WHOLE, TAIL = range(3)


def row_pieces(lines: DataFrame, inside, whole: bool) -> DataFrame:
    """(file, start, first, kind, value): rows that lie in one range, or else the pieces of rows that do not.

    A head goes on with a row of an earlier range; a tail is the beginning of a row that goes on. ``first`` marks the
    first row of a file. ``inside`` broadcasts the ranges that start inside quotes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = inside.value
        at, held, state, started, first = None, [], False, False, False
        for batch in batches:
            found = []

            def add(kind: int, found=found) -> None:
                if (kind == WHOLE) == whole:
                    found.append({"file": at[0], "start": at[1], "first": first and kind != HEAD, "kind": kind,
                                  "value": b"\n".join(held)})

            for place, value in zip(places(batch), batch.column("value"), strict=True):
                if place != at:
                    if held:
                        add(TAIL if started else HEAD)
                    at, held, state = place, [], place in opened
                    started, first = not state, place[1] == 0
                line = value.as_buffer().to_pybytes()
                held.append(line)
                state = ends_inside(line, state) if b'"' in line else state
                if not state:
                    add(WHOLE if started else HEAD)
                    first = first and not started
                    held, started = [], True
            if found:
                yield pa.RecordBatch.from_pylist(found, SCHEMA)
        if held:
            found = []
            add(TAIL if started else HEAD, found)
            if found:
                yield pa.RecordBatch.from_pylist(found, SCHEMA)

    return lines.mapInArrow(run, "file long, start long, first boolean, kind int, value binary")


SCHEMA = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("first", pa.bool_()), ("kind", pa.int32()), ("value", pa.binary())])


def rows_over_ranges(pieces: DataFrame) -> DataFrame:
    """(first, value): rows put together from a tail and the heads that follow it in the same file."""
    along = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = pieces.withColumn("row", F.sum((F.col("kind") == TAIL).cast("int")).over(along))
    joined = numbered.groupBy("file", "row").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "value"))).alias("pieces"))
    breaks = F.transform("pieces", lambda p, i: F.when(i == 0, p["value"]).otherwise(F.concat(F.lit(b"\n"), p["value"])))
    return joined.select("first", F.aggregate(breaks, F.lit(b""), lambda a, b: F.concat(a, b)).alias("value"))


def read_csv_ranges(spark: SparkSession, path: str, schema: str, encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """CSV files with quoted line breaks and doubled quotes, read by many tasks; rows end at LF or CRLF.

    Equal to reading each file with one task. ``encoding`` must write quotes, commas and line feeds as in ASCII. Files
    are read three times: for the states, the rows inside ranges and the pieces of the others. Blank lines outside
    quotes are no rows. With ``header`` the first row of each file is left out.
    """
    lines = physical_lines(spark, path)
    found = inside_at_start(written(range_functions(lines), "range-functions")).collect()  # at most one row for a range
    inside = spark.sparkContext.broadcast({(r["file"], r["start"]) for r in found})
    whole = row_pieces(lines, inside, True).select("first", "value")
    rows = whole.unionByName(rows_over_ranges(row_pieces(lines, inside, False)))
    if header:
        rows = rows.filter("NOT first")
    text = F.regexp_replace(F.decode("value", encoding), "\r$", "").alias("text")
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = rows.select(text).filter(F.col("text") != "").select(F.from_csv("text", F.lit(schema), options).alias("row"))
    return parsed.select("row.*")
