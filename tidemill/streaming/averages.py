"""Moving averages and growth kept up to date by a stream of event files that may come late.

Each series holds its daily counts as state. A file adds to some days; only those days and the few after them whose
window or predecessor changed are computed anew and sent on. The latest row sent for a day is its value, so files may come
in any order. Tasks add up what they read before it is shuffled, so a series that is a third of all rows costs no more
than any other; its state is one number for each day.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemill.session import scratch_path

ROWS = 7
UPDATE = "series string, day date, n long, moving_avg double, growth_pct double"


def partial_counts(stream: DataFrame, series: str, time: str) -> DataFrame:
    """(series, day, n): events of each task's batches per series and day. Rows without either are left out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby(["series", "day"], as_index=False).size().rename(columns={"size": "n"})

    rows = stream.select(F.col(series).alias("series"), F.unix_date(F.to_date(time)).alias("day"))
    return rows.filter("series IS NOT NULL AND day IS NOT NULL").mapInPandas(run, "series string, day int, n long")


def changed_rows(days: np.ndarray, changed: np.ndarray, rows: int) -> np.ndarray:
    """Places whose average or growth may differ: a new count reaches ``rows`` places, so does a day put in between."""
    places = np.searchsorted(days, changed)
    reach = np.unique(np.concatenate([places + i for i in range(rows)])) if len(places) else places
    return reach[reach < len(days)]


def updated(held: dict[int, int], new: dict[int, int], rows: int) -> tuple[dict[int, int], pd.DataFrame]:
    """The counts with those of new events added, and the rows that changed by it."""
    total = dict(held)
    for day, n in new.items():
        total[day] = total.get(day, 0) + n
    days = np.array(sorted(total), dtype=np.int64)
    counts = np.array([total[d] for d in days.tolist()], dtype=np.int64)
    at = changed_rows(days, np.array(sorted(new), dtype=np.int64), max(rows, 2))
    sums = np.concatenate([[0], np.cumsum(counts)])
    average = [(sums[i + 1] - sums[i + 1 - rows]) / rows if i + 1 >= rows else None for i in at.tolist()]
    growth = [(counts[i] / counts[i - 1] - 1) * 100 if i else None for i in at.tolist()]
    frame = pd.DataFrame({"day": [np.datetime64(int(d), "D").astype(object) for d in days[at]], "n": counts[at],
                          "moving_avg": pd.Series(average, dtype="float64"), "growth_pct": pd.Series(growth, dtype="float64")})
    return total, frame


def keep_averages(stream: DataFrame, series: str, time: str, checkpoint: str, updates: str, rows: int = ROWS) -> None:
    """Adds all files not seen before to the state in ``checkpoint``, sends changed rows to ``updates``, and stops.

    Started again with the same folders it goes on where it stopped; a batch that is repeated replaces its own rows.
    """
    def add(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        new: dict[int, int] = {}
        for batch in batches:
            for day, n in zip(batch["day"].tolist(), batch["n"].tolist(), strict=True):
                new[day] = new.get(day, 0) + n
        total, frame = updated(held, new, rows)
        state.update((list(total), list(total.values())))
        frame.insert(0, "series", key[0])
        yield frame

    def send(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    counts = partial_counts(stream, series, time).groupBy("series").applyInPandasWithState(
        add, UPDATE, "days array<int>, counts array<long>", "update", GroupStateTimeout.NoTimeout)
    query = counts.writeStream.foreachBatch(send).outputMode("update").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()


def current_averages(spark: SparkSession, updates: str) -> DataFrame:
    """(series, day, n, moving_avg, growth_pct): the latest row of each day; averages from the seventh day of a series on."""
    sent = spark.read.schema(f"{UPDATE}, batch long").parquet(updates)
    latest = F.max_by(F.struct("n", "moving_avg", "growth_pct"), "batch").alias("latest")
    return sent.groupBy("series", "day").agg(latest).select("series", "day", "latest.*")


def stream_moving_averages(spark: SparkSession, events: DataFrame, files: int = 6) -> DataFrame:
    """Events landed as files with days of all times in each, taken one after the other."""
    landed, updates = scratch_path(spark, "late-files"), scratch_path(spark, "averages")
    events.repartition(files, F.xxhash64("event_id")).write.parquet(landed)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    keep_averages(stream, "event_type", "ts", scratch_path(spark, "averages-state"), updates)
    return current_averages(spark, updates)
