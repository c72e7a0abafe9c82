"""Near-duplicate documents by SimHash and multi-index hashing.

Fingerprints are cut into two halves of 32 bits. Two fingerprints that differ in at most two bits agree in the lower
half or differ by at most one bit in the upper one, so each fingerprint looks up its lower half and the ball of one
flipped bit around its upper half, and every match is verified over all 64 bits. Flips only set bits: of two values one
bit apart exactly one reaches the other that way.

Fingerprints in or next to a crowded table entry would meet too many others there. They take a way that is just as
exact: each is listed under itself and its 64 one-bit variants. Two fingerprints share such a variant if and only if
they are at most two bits apart, and no variant can gather more than 65 of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, identified, kept_rows
from tidemill.llm.components import connected
from tidemill.session import written

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 64  # distinct fingerprints in one table entry
BLOCK = 1 << 20  # bytes of a text whose words are held at once


def word_blocks(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about ``BLOCK`` bytes; each block repeats the last words of the one before."""
    start, carried = 0, []
    while start < len(data):
        end = start + BLOCK
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        words = carried + data[start:end].split()
        yield words
        carried, start = words[len(words) - overlap:] if len(words) >= overlap else words, end


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    runs = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    return np.fromiter(map(hashed, runs), dtype=np.uint64)


def fingerprint(text: str, k: int = SHINGLE) -> int:
    """A bit is set where over half the hashes of all shingles have it; signed, as Spark holds 64-bit numbers."""
    counts, n, words = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks(text.encode().lower(), k - 1):
        hashes = shingle_hashes(words, k)
        n += len(hashes)
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    if not n and words:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=SEED)], dtype=np.uint64)
        counts, n = np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, content_key, fp) per row; words are split at ASCII white space after lower-casing A-Z."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), k) for t in batch.column("text")), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content_key"), pa.array(found)],
                                             ["doc_id", "content_key", "fp"])

    rows = identified(docs, id_column, text_column).select("doc_id", F.xxhash64("text").alias("content_key"), "text")
    return rows.mapInArrow(run, "doc_id long, content_key long, fp long")


def halves(fp: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))


def flips(value: Column, bits: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda j: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), j)))


def segments(fp: Column) -> Column:
    high, low = halves(fp)
    return F.array(F.struct(F.lit(0).alias("segment"), high.alias("value")), F.struct(F.lit(1).alias("segment"), low.alias("value")))


def probes(fp: Column) -> Column:
    """What a fingerprint looks up: both halves, and the upper one with each unset bit set."""
    high, _ = halves(fp)
    near = F.transform(F.filter(flips(high, 32), lambda v: v > high), lambda v: F.struct(F.lit(0).alias("segment"), v.alias("value")))
    return F.concat(segments(fp), near)


def links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints at most two bits apart.

    ``distinct`` is a written table of different fingerprints ``fp``.
    """
    entries = distinct.select("fp", F.inline(segments(F.col("fp"))))
    looked_up = distinct.select(F.col("fp").alias("a"), F.inline(probes(F.col("fp"))))
    full = written(entries.groupBy("segment", "value").count().filter(F.col("count") > crowd).drop("count"), "crowded")
    table = entries.select(F.col("fp").alias("b"), "segment", "value")
    if not full.isEmpty():
        table = table.join(full, ["segment", "value"], "left_anti")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = looked_up.join(table, ["segment", "value"]).filter((F.col("a") != F.col("b")) & (apart <= DISTANCE))
    found = met.select("a", "b")
    if full.isEmpty():
        return found
    busy = looked_up.join(full, ["segment", "value"], "left_semi").select("a").distinct()
    variants = busy.select("a", F.explode(F.concat(F.array("a"), flips(F.col("a"), 64))).alias("middle"))
    variants = written(variants, "variants")
    shared = variants.groupBy("middle").agg(F.min("a").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    around = variants.join(shared, "middle").filter((F.col("a") != F.col("b")) & (apart <= DISTANCE))
    return found.unionByName(around.select("a", "b"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text",
                    crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, content_key, fp, component_id, kept.

    Documents are linked when their fingerprints differ in at most two bits; a component is all that links reach, and
    component_id its smallest doc_id. A text without words, empty or missing, has the fingerprint zero and is linked
    like any other; a text of fewer words than a shingle is one shingle. Missing doc_ids come last and name a component
    only if it has no other. The row that names the component is kept, of several with its doc_id the one with the
    smallest content_key; rows repeated in the table are all marked alike. Texts may be of any length. Other columns are
    left out, whatever their names. An empty table gives an empty result.
    """
    rows = written(fingerprints(docs, k, id_column, text_column), "fingerprints")
    entry = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content_key")
    distinct = written(rows.groupBy("fp").agg(F.min(entry).alias("first")), "distinct")
    roots = written(connected(links(distinct.select("fp"), crowd)), "roots")
    nodes = roots.join(distinct.withColumnRenamed("fp", "node"), "node")
    named = nodes.groupBy("root").agg(F.min("first").alias("reached"))
    linked = roots.join(named, "root").select(F.col("node").alias("fp"), "reached")
    labels = distinct.join(linked, "fp", "left").select("fp", F.coalesce("reached", "first").alias("first"))
    placed = rows.join(written(labels, "labels"), "fp")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("content_key") == F.col("first.content_key"))
    return placed.select("doc_id", "content_key", "fp", F.col("first.doc_id").alias("component_id"), same.alias("kept"))


def kept_documents(docs: DataFrame, k: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of every component, all columns as they were.

    Texts without words, missing texts and doc_ids, ties and long texts are treated as by ``near_duplicates``; of rows
    repeated in the table one stays. No rows give no rows.
    """
    decided = written(near_duplicates(docs, k, id_column, text_column), "near")
    key = F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    return kept_rows(docs, decided, key, id_column)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = near_duplicates(documents_of(spark, folder))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op5_simhash": op5_simhash}
ORACLES: dict[str, str] = {}
