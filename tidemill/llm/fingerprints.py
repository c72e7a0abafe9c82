"""Similarity digests of improbable features.

Every window of 64 bytes has an entropy; how rare its entropy class is among all windows of the collection ranks it.
Windows that rank lowest around them are features, each hashed to five bits of a Bloom filter that takes 160 features
before the next one in the chain is opened. Two digests are compared by the bits their filters share, scaled between
what chance would share and what is possible.

Texts are range-partitioned by doc_id once and compared with their successors while streaming through a task; the first
text of each range is also sent to the range before it.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, identified, mixed, slices

WINDOW = 64
CLASSES = 1001  # thousandths of the largest entropy
LEAST = 100  # classes below are all but constant bytes, never features
AROUND = 64  # a feature ranks lowest in ``AGREED`` runs of so many windows
AGREED = 16
SPAN = AROUND + AGREED - 1
# Texts too short for many features add all their windows of fewer bytes: (bytes of a window, least and most bytes of a
# text). The sizes overlap, so that a text and its edited form share a kind of window.
SMALL_WINDOWS = ((16, 48, 1024), (4, 4, 96))
PER_FILTER = 160
BITS = 2048
CORE = 1 << 16  # bytes ranked at once, small enough for a processor's cache
PAD = 16  # between texts, so that no run of windows reaches from one into the next
STEP = 4 << 20  # bytes of texts taken at once


def scaled_entropy_terms() -> np.ndarray:
    """c·log2 c in 65536ths, as integers so that sums do not depend on where they start."""
    c = np.arange(WINDOW + 1)
    return np.round(c * np.log2(np.maximum(c, 1)) * 65536).astype(np.int32)


TERMS = scaled_entropy_terms()
GAIN = np.diff(TERMS, prepend=np.int32(0))
LARGEST = int(TERMS[WINDOW])


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """The entropy class of each window of ``x``, from running counts of equal bytes."""
    n = len(x) - WINDOW + 1
    ahead, behind = np.zeros(len(x), dtype=np.uint8), np.zeros(len(x), dtype=np.uint8)
    equal = np.empty(len(x), dtype=np.uint8)
    for d in range(1, WINDOW):
        same = equal[: len(x) - d]
        np.equal(x[:-d], x[d:], out=same.view(bool))
        ahead[:-d] += same
        behind[d:] += same
    sums = np.empty(n, dtype=np.int32)
    sums[0] = TERMS[np.bincount(x[:WINDOW], minlength=256)].sum()
    sums[1:] = GAIN[behind[WINDOW:] + 1] - GAIN[ahead[: n - 1] + 1]
    np.cumsum(sums, out=sums)
    return ((LARGEST - sums).astype(np.float64) * ((CLASSES - 1) / LARGEST)).astype(np.int16)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with padding around each, where they start, and their lengths."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = PAD + np.concatenate([[0], np.cumsum(sizes + PAD)[:-1]]).astype(np.int64)
    gap = bytes(PAD)
    return np.frombuffer(gap + gap.join(texts) + gap, dtype=np.uint8), starts, sizes


def window_places(starts: np.ndarray, sizes: np.ndarray, total: int) -> np.ndarray:
    """Marks where a whole window of one text starts."""
    steps = np.zeros(total + 1, dtype=np.int8)
    long = sizes >= WINDOW
    steps[starts[long]] = 1
    steps[starts[long] + sizes[long] - WINDOW + 1] = -1
    return np.cumsum(steps[:-1], dtype=np.int8).view(bool)


def class_counts(texts: list[bytes]) -> np.ndarray:
    x, starts, sizes = joined(texts)
    valid = window_places(starts, sizes, len(x))
    counts = np.zeros(CLASSES, dtype=np.int64)
    for start in range(0, len(x) - WINDOW + 1, CORE):
        part = x[start: start + CORE + WINDOW - 1]
        found = entropy_classes(part)
        counts += np.bincount(found[valid[start: start + len(found)]], minlength=CLASSES)
    return counts


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Classes ranked by rarity, the rarest lowest; the lowest entropies rank last and are never features."""
    order = np.lexsort((np.arange(CLASSES), counts))
    ranks = np.empty(CLASSES, dtype=np.int32)
    ranks[order] = np.arange(CLASSES)
    ranks[:LEAST] = CLASSES
    return ranks


def chosen(x: np.ndarray, valid: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the features, found core by core with the neighbourhood each core needs."""
    found = []
    for start in range(0, len(x), CORE):
        low = max(0, start - SPAN)
        part = x[low: start + CORE + SPAN + WINDOW]
        if len(part) < WINDOW:
            continue
        rank = ranks[entropy_classes(part)]
        rank[~valid[low: low + len(rank)]] = CLASSES
        n = len(rank)
        key = np.full(n + 2 * SPAN, CLASSES << 18, dtype=np.int32)
        key[SPAN: SPAN + n] = rank << 18 | np.arange(n)
        best, reach = key, 1
        while reach < AROUND:  # lowest of 2, 4, … 64 places, and of the whole span by two of those
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        best = np.minimum(best[: -(SPAN - AROUND)], best[SPAN - AROUND:])
        place = best & ((1 << 18) - 1)
        offset = place - (np.arange(len(best)) - SPAN)
        agreed = (best < CLASSES << 18) & (offset >= AGREED - 1) & (offset < AROUND)
        marked = np.zeros(n, dtype=bool)
        marked[place[agreed]] = True
        places = np.flatnonzero(marked) + low
        found.append(places[(places >= start) & (places < start + CORE)])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def window_hashes(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    words = np.ndarray(len(x) - 7, dtype="<u8", buffer=x, strides=(1,))
    h = np.full(len(places), 0x2545F4914F6CDD1D, dtype=np.uint64)
    for i in range(0, WINDOW, 8):
        h = mixed(h ^ words[places + i])
    return h


def small_windows(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash) of all small windows of the texts that are short enough for them."""
    for size, least, most in SMALL_WINDOWS:
        short = np.flatnonzero((sizes >= least) & (sizes < most))
        n = sizes[short] - size + 1
        owner = np.repeat(short, n)
        places = np.repeat(starts[short] - np.cumsum(n) + n, n) + np.arange(n.sum())
        words = np.ndarray(len(x) - 3, dtype="<u4", buffer=x, strides=(1,))
        h = np.full(len(places), size, dtype=np.uint64)
        for i in range(0, size, 4):
            h = mixed(h ^ words[places + i].astype(np.uint64))
        yield owner, h


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """One chain of Bloom filters per text, as rows of ``BITS`` bits.

    Texts of fewer than a thousand bytes also have their small windows as features. A text without features, being
    shorter than any window or long and all but constant, has itself as its only feature; an empty text has none and an
    empty chain.
    """
    x, starts, sizes = joined(texts)
    places = chosen(x, window_places(starts, sizes, len(x)), ranks)
    small = list(small_windows(x, starts, sizes))
    owner = np.concatenate([np.searchsorted(starts, places, side="right") - 1, *[o for o, _ in small]])
    hashes = np.concatenate([window_hashes(x, places), *[h for _, h in small]])
    bare = np.flatnonzero((np.bincount(owner, minlength=len(texts)) == 0) & (sizes > 0))
    own = [int.from_bytes(hashlib.sha256(texts[i]).digest()[:8], "little") for i in bare]
    owner = np.concatenate([owner, bare])
    hashes = np.concatenate([hashes, np.array(own, dtype=np.uint64)])
    order = np.lexsort((hashes, owner))  # stable: of equal features of a text the first comes first
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    kept = np.sort(order[~again])
    kept = kept[np.argsort(owner[kept], kind="stable")]
    owner, hashes = owner[kept], hashes[kept]
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    filters = -(-np.bincount(owner, minlength=len(texts)) // PER_FILTER)
    ends = np.cumsum(filters)
    row = (ends - filters)[owner] + number // PER_FILTER
    bits = np.zeros((int(ends[-1]) if len(ends) else 0, BITS), dtype=np.uint8)
    for i in range(5):
        bits[row, (hashes >> np.uint64(11 * i)) & np.uint64(BITS - 1)] = 1
    packed = np.packbits(bits, axis=1)
    return [packed[a:b] for a, b in zip(ends - filters, ends, strict=True)]


def one_way(a: np.ndarray, b: np.ndarray) -> float:
    """Each filter of ``a`` against its best match in ``b``, weighted by its bits."""
    size_a, size_b = (np.bitwise_count(x.view(np.uint64)).sum(axis=1).astype(float) for x in (a, b))
    total = 0.0
    for f, bits in zip(a.view(np.uint64), size_a, strict=True):
        shared = np.bitwise_count(f & b.view(np.uint64)).sum(axis=1)
        possible, chance = np.minimum(bits, size_b), bits * size_b / BITS
        least = chance + 0.3 * (possible - chance)
        total += bits * np.clip((shared - least) / (possible - least), 0, 1).max()
    return total / size_a.sum()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1; the shorter chain is looked up in the longer, chains of equal length in each other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b):
        return round((one_way(a, b) + one_way(b, a)) / 2, 6)
    return round(one_way(a, b) if len(a) < len(b) else one_way(b, a), 6)


def printed(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def rarity(docs: DataFrame) -> np.ndarray:
    """Ranks of the entropy classes, counted over all windows of all texts; at most ``CLASSES`` rows are collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, dtype=np.int64)
        for batch in slices(batches, "text", STEP):
            counts += class_counts([t.as_buffer().to_pybytes() for t in batch.column("text")])
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(counts)], ["class", "n"])

    counted = docs.select("text").mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES, dtype=np.int64)
    for row in counted.collect():
        counts[row["class"]] = row["n"]
    return ranks_of(counts)


def range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``key``, by a coarse and a fine search."""
    def reached(among: Column) -> Column:
        return F.size(F.filter(among, lambda b: b <= key))

    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    groups = [bounds[i: i + width] for i in range(0, len(bounds), width)]
    coarse = F.greatest(reached(F.array(*[F.lit(g[0]) for g in groups])) - 1, F.lit(0))
    fine = F.array(*[F.array(*map(F.lit, g)) for g in groups])
    return coarse * width + reached(fine[coarse])


def with_successors(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Texts range-partitioned and sorted by doc_id; each range ends with the first text of the next one.

    Only ids are read to choose the ranges and their first rows, one row per range.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    marks = keyed.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [0.5], 10000)).first()[0] or []
    bounds = sorted(set(marks)) if ranges > 1 else []
    ranged = keyed.withColumn("range", range_of(F.col("key"), bounds))
    firsts = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.min("key")).collect())
    before = [(key, firsts[i - 1][0]) for i, (_, key) in enumerate(firsts)]
    sent = F.broadcast(spark.createDataFrame(before, "key long, range int"))  # one row per range
    own = ranged.withColumn("extra", F.lit(False))
    extra = keyed.join(sent, "key").withColumn("extra", F.lit(True))
    placed = own.unionByName(extra).repartitionById(len(bounds) + 1, F.col("range"))
    return placed.sortWithinPartitions("range", "extra", "key", F.xxhash64("text")).select("range", "extra", "doc_id", "text")


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compared(rows: list[tuple], ranks: np.ndarray) -> list[tuple]:
    """Results for (doc_id, text, next text), given with the digests of text and next text."""
    edited = []
    for _, text, after, _, _ in rows:
        quarter = len(text) // 4
        edited.append((text[: len(text) - quarter] + after[:quarter]).encode())
    return [
        (doc_id, len(text), hashlib.sha256(e).hexdigest(), printed(own), printed(other), likeness(own, other),
         likeness(own, following))
        for (doc_id, text, _, own, following), e, other in zip(rows, edited, digests(edited, ranks), strict=True)
    ]


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranges: int | None = None
                ) -> DataFrame:
    """One row per document: its digest, the digest of an edited text, and the likeness to that and to the next one.

    The edited text has its last quarter replaced by the beginning of the next document in the order of doc_id; the
    last is followed by the first. Missing doc_ids come first, equal ones in the order of a hash of their texts. A
    missing text counts as empty; texts may be of any length. Equal texts have equal digests. Two empty digests have the
    likeness 1, an empty and a filled one 0. Repeated rows have a row each, and one may follow the other. Other columns
    are left out, whatever their names. No rows give no rows.
    """
    texts = identified(docs, id_column, text_column)
    # About a thousand numbers, whatever the size of the collection.
    shared = docs.sparkSession.sparkContext.broadcast(rarity(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, waiting = shared.value, None
        for batch in slices(batches, "text", STEP):
            values = [batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text")]
            chains = digests([t.encode() for t in values[3]], ranks)
            ready = []
            for place, extra, doc_id, text, chain in zip(*values, chains, strict=True):
                if waiting and waiting[0] == place:
                    ready.append((*waiting[1:3], text, waiting[3], chain))
                waiting = None if extra else (place, doc_id, text, chain)
            if ready:
                columns = zip(*compared(ready, ranks), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)], NAMES)

    return with_successors(texts, ranges).mapInArrow(run, RESULT)


NAMES = [field.split()[0] for field in RESULT.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint(documents_of(spark, folder))


QUERIES = {"op3_fingerprints": op3_fingerprints}
ORACLES: dict[str, str] = {}
