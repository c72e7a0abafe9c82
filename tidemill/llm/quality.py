"""A quality score by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed byte trigrams, of hashed character-shape runs (case, digits, punctuation) and of
immediate word repetitions. Weighted by rarity over all documents and projected on the leading singular directions of a labelled sample,
it is compared by exact cosine with every labelled vector; the nearest labels vote with their similarity.

The labelled vectors are a bounded sample (``PER_LABEL`` rows of each label), so what is sent to every task and the work
per document do not grow with the collection. Scoring needs no shuffle: each task reads texts and writes scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, identified, mixed, slices, text_bytes, word_spans

PER_LABEL = 1500  # labelled documents taken of each label, by a hash of their ids
DIMENSIONS = 64
NEIGHBOURS = 7
PRIOR_WEIGHT = 0.05  # what the balanced prior adds to the votes, in units of similarity
HALF = 1024  # buckets for byte trigrams, and as many for shapes
EXTRA = 32  # word repetitions and the length of the text
WIDTH = 2 * HALF + EXTRA
BLOCK = 1 << 20
ROWS = 256


def shapes() -> np.ndarray:
    """Each byte's character shape: lower-case and non-ASCII letters, upper case, digits, or the byte itself."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("a"): ord("z") + 1] = table[128:] = ord("a")
    table[ord("A"): ord("Z") + 1] = ord("A")
    table[ord("0"): ord("9") + 1] = ord("0")
    return table


def run_counts(raw: np.ndarray, offsets: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Counts of hashed runs of ``width`` bytes per text, taken in blocks; no run crosses two texts."""
    counts = np.zeros((len(offsets) - 1) * HALF)
    cut = np.unique([offsets[1:] - i for i in range(1, width)])  # runs that would start here cross a text's end
    for start in range(0, len(raw), BLOCK):
        part = raw[start: start + BLOCK + width - 1]
        n = len(part) - width + 1
        if n <= 0:
            continue
        key = np.full(n, seed, dtype=np.uint32)
        for i in range(width):
            key *= np.uint32(0x01000193)
            key ^= part[i: i + n]
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x2C1B3C6D)
        key >>= np.uint32(22)
        bounds = np.clip(offsets, start, start + n) - start
        key += np.repeat(np.arange(len(offsets) - 1, dtype=np.uint32) * np.uint32(HALF), np.diff(bounds))
        found = np.bincount(key, minlength=len(counts)).astype(np.float64)
        found -= np.bincount(key[cut[(cut >= start) & (cut < start + n)] - start], minlength=len(counts))
        counts += found
    return counts.reshape(-1, HALF)


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of counts per text; texts of any length are taken in blocks."""
    n = len(offsets) - 1
    extra = np.zeros((n, EXTRA))
    sizes = np.diff(offsets)
    extra[np.arange(n), np.minimum(np.log2(sizes + 1).astype(int), EXTRA - 3)] = 1
    for text, _, _, hashes in word_spans(raw, offsets, BLOCK):
        again = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
        extra[:, EXTRA - 2] += np.bincount(text[1:][again], minlength=n)
        near = (hashes[2:] == hashes[:-2]) & (text[2:] == text[:-2])
        extra[:, EXTRA - 1] += np.bincount(text[2:][near], minlength=n)
    return np.hstack([run_counts(raw, offsets, 3, 7), run_counts(shapes()[raw], offsets, 4, 11), extra])


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped counts times rarity, each block of features brought to length one."""
    rows = np.log1p(counts) * rarity
    for block in (slice(0, HALF), slice(HALF, 2 * HALF), slice(2 * HALF, WIDTH)):
        size = np.sqrt((rows[:, block] ** 2).sum(axis=1, keepdims=True))
        rows[:, block] /= np.where(size > 0, size, 1)
    return rows


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt((rows ** 2).sum(axis=1, keepdims=True))
    return rows / np.where(size > 0, size, 1)


@dataclass
class Model:
    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        placed = unit(weighted(counts, self.rarity) @ self.directions)
        likeness = np.round(placed @ self.vectors.T, 9)
        k = min(self.neighbours, likeness.shape[1])
        # The labelled row's number breaks ties, so a score does not depend on the batch it is computed in.
        ranked = likeness - np.arange(likeness.shape[1]) * 1e-13
        best = np.argpartition(-ranked, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(likeness, best, axis=1), 0) ** 4
        votes = (weight * self.labels[best]).sum(axis=1) + PRIOR_WEIGHT * self.prior
        return np.round(votes / (weight.sum(axis=1) + PRIOR_WEIGHT), 6)


def leading_directions(rows: np.ndarray, n: int) -> np.ndarray:
    """The first right singular vectors by subspace iteration from a fixed start."""
    n = min(n, *rows.shape)
    basis = np.random.default_rng(1).standard_normal((rows.shape[1], n + 16))
    for _ in range(6):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, turned = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turned.T)[:, :n]


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, counts) with the counts of each text as packed 32-bit floats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK, ROWS):
            rows = features(*text_bytes(batch.column("text"))).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["doc_id", "counts"])

    return docs.mapInArrow(run, "doc_id long, counts binary")


def rarity_of(docs: DataFrame) -> np.ndarray:
    """The weight of each feature by the number of all documents that have it; rows of ``WIDTH`` counts are collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, having = 0, np.zeros(WIDTH, dtype=np.int64)
        for batch in slices(batches, "text", BLOCK, ROWS):
            n += batch.num_rows
            having += (features(*text_bytes(batch.column("text"))) > 0).sum(axis=0)
        # The number of documents goes by the feature behind the last one.
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1, dtype=np.int32)), pa.array(np.append(having, n))],
                                         ["feature", "n"])

    found = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    counts = found.sort_values("feature")["n"].to_numpy(dtype=np.int64)
    return np.log((1 + counts[WIDTH]) / (1 + counts[:WIDTH])) + 0.1


def labelled_sample(labels: DataFrame, label: str, per_label: int) -> pd.DataFrame:
    """At most ``per_label`` documents of each label, the same ones in every run; several labels are averaged."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    each = known.groupBy("doc_id").agg(F.avg(label).alias("y"))
    taken = [each.filter(side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for side in ("y >= 0.5", "y < 0.5")]
    return taken[0].unionByName(taken[1]).toPandas()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL,
        dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """Learns from at most ``per_label`` labelled documents of each label; the rarity of features is that in all ``docs``.

    ``labels`` holds doc_id and a label of 0 or 1; rows without either are passed over. Without any labelled text the
    model gives everything 0.5, with one label only that label's value.
    """
    spark = docs.sparkSession
    empty = Model(np.ones(WIDTH), np.zeros((WIDTH, 0)), np.zeros((0, 0)), np.zeros(0), 0.5)
    wanted = labelled_sample(labels.select("doc_id", label), label, per_label)
    if not len(wanted):
        return empty
    ids = spark.createDataFrame([(int(i),) for i in wanted["doc_id"]], "doc_id long")
    # A sample of bounded size: at most twice ``per_label`` ids and their texts' counts.
    # Of several texts with one doc_id the one with the smallest hash is learned, whatever the plan.
    known = docs.join(F.broadcast(ids), "doc_id", "left_semi").withColumn("text_key", F.xxhash64("text"))
    one = known.groupBy("doc_id").agg(F.min_by("text", "text_key").alias("text"))
    rows = counted(one).toPandas().merge(wanted, on="doc_id").sort_values("doc_id")
    if not len(rows):
        return empty
    counts = np.frombuffer(b"".join(rows["counts"]), dtype=np.float32).reshape(-1, WIDTH).astype(np.float64)
    rarity = rarity_of(docs)
    weights = weighted(counts, rarity)
    directions = leading_directions(weights, dimensions)
    y = rows["y"].to_numpy(dtype=np.float64)
    prior = 0.5 if (y >= 0.5).any() and (y < 0.5).any() else float(y.mean())
    return Model(rarity, directions, unit(weights @ directions), y, prior, neighbours)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) per row, the score between 0 and 1.

    Only the text is looked at. An empty or missing text has a vector of its own length alone and is scored like any
    other, a text of any length as a whole. Repeated rows get equal scores, rows without doc_id a score like others. Other
    columns are left out, whatever their names. No rows give no rows.
    """
    # The model is bounded by its parameters: a few megabytes, whatever the number of documents.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK, ROWS):
            found = shared.value.scores(features(*text_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return identified(docs, id_column, text_column).mapInArrow(run, "doc_id long, score double")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels of documents that are not held out."""
    return labels.filter(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fitted(spark: SparkSession, docs: DataFrame, folder: str) -> Model:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return fit(identified(docs), learnable(labels))


def kept_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The rows of ``docs`` whose text scores at least one half, all columns as they were.

    Missing and empty texts are scored like any other, so are long ones; equal texts, repeated rows among them, stay or
    go together. A score of exactly one half stays. No rows give no rows.
    """
    model = fitted(spark, docs, folder)
    shared = spark.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK, ROWS):
            found = shared.value.scores(features(*text_bytes(batch.column(batch.schema.get_field_index("text")))))
            yield batch.filter(pa.array(found >= 0.5))

    return docs.mapInArrow(run, schema)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents_of(spark, folder)
    rows = score(docs, fitted(spark, docs, folder))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op10_quality": op10_quality}
ORACLES: dict[str, str] = {}
