"""Word vectors from counts: words that stand near each other, their association, and a randomised SVD of it.

Counts and weights are tables; up to ``HELD_WORDS`` frequent words pass the driver, to be looked up in the tasks. Of the
decomposition the driver sees matrices of as many rows and columns as the vectors have dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.frames import entries
from tidemill.operators.vocabulary import looked_up
from tidemill.operators.windows import ordered_index
from tidemill.session import small_batches, written


PAIRS_HELD = 1 << 22  # pairs a task counts at once
BUCKETS = 1 << 10  # parts in which counts of pairs meet


def pair_counts(located: DataFrame, window: int) -> DataFrame:
    """(code, n): how often two numbered words stand within ``window`` places of each other.

    ``located`` has words, lists of numbers in their order, -1 for a word that is left out. The code is the smaller number
    times 2^32 and the larger one. Pairs are counted in each task, and their counts meet in ``BUCKETS`` parts as arrays,
    so that no row is shuffled for a pair.
    """
    def counted(pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        code, n = np.unique(np.concatenate(pairs), return_counts=True)
        bucket = (((code >> 32) + (code & 0xFFFFFFFF)) % BUCKETS).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        code, n = code[order], n[order].astype(np.int32)
        found, starts = np.unique(bucket[order], return_index=True)
        edges = np.append(starts, len(code))
        for low in range(0, len(found), BUCKETS // 8):
            some = range(low, min(low + BUCKETS // 8, len(found)))
            held = [pa.array([x[edges[i]: edges[i + 1]].tobytes() for i in some], pa.binary()) for x in (code, n)]
            yield pa.RecordBatch.from_arrays([pa.array(found[some.start: some.stop].astype(np.int32)), *held], ["bucket", "codes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[np.ndarray] = []
        for batch in batches:
            lists = batch.column("words")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
            number = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            for step in range(1, window + 1):
                one, other = number[:-step], number[step:]
                near = (row[:-step] == row[step:]) & (one >= 0) & (other >= 0)
                one, other = one[near], other[near]
                pairs.append(np.minimum(one, other) << 32 | np.maximum(one, other))
                if sum(map(len, pairs)) >= PAIRS_HELD:
                    yield from counted(pairs)
                    pairs = []
        if pairs:
            yield from counted(pairs)

    def added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        code, n = np.concatenate(codes), np.concatenate(counts)
        order = np.argsort(code)
        code = code[order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        return code[starts], np.add.reduceat(n[order], starts, dtype=np.int64)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, codes, counts, held, most = -1, [], [], 0, PAIRS_HELD

        def rows() -> Iterator[pa.RecordBatch]:
            code, n = added(codes, counts)
            for low in range(0, len(code), PAIRS_HELD // 4):
                yield pa.RecordBatch.from_arrays([pa.array(x[low: low + PAIRS_HELD // 4]) for x in (code, n)], ["code", "n"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != at and codes:
                    yield from rows()
                    codes, counts, held, most = [], [], 0, PAIRS_HELD
                at = r["bucket"]
                codes.append(np.frombuffer(r["codes"], np.int64))
                counts.append(np.frombuffer(r["counts"], np.int32))
                held += len(codes[-1])
                if held >= most:
                    codes, counts = ([x] for x in added(codes, counts))
                    held = len(codes[0])
                    most = max(PAIRS_HELD, 2 * held)
        if codes:
            yield from rows()

    parts = located.select("words").mapInArrow(run, "bucket int, codes binary, counts binary")
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merged, "code bigint, n bigint")


HELD_WORDS = 1 << 20  # frequent words that every task keeps


def often_words(counts: DataFrame, min_count: int) -> DataFrame:
    """(word, times, number), written: the words of (word, times) that occur at least ``min_count`` times, numbered from 0
    in an order that says nothing of them."""
    often = counts.select("word", "times").filter(F.col("times") >= min_count)
    numbered = ordered_index(often, F.xxhash64("word"), F.col("word"))
    return written(numbered.select("word", "times", F.col("index").cast("int").alias("number")), "often")


def numbered_pairs(df: DataFrame, tokens: str, window: int, often: DataFrame) -> DataFrame:
    """(word, context, n), written: each pair of numbers of ``often`` once, the smaller first. A word beside itself counts
    once for each direction.

    Texts stay where they are read: the ``HELD_WORDS`` most frequent words are numbered there, and only others are rows of
    a join. What is shuffled for a pair is two numbers, and pairs are counted in each task first.
    """
    table = often.select(F.col("word").alias("entry"), F.col("number").alias("found"))
    first = table
    if often.count() > HELD_WORDS:
        most = often.orderBy(F.desc("times"), "word").limit(HELD_WORDS)
        first = written(most.select(F.col("word").alias("entry"), F.col("number").alias("found")), "held-words")
    # Numbered before the lists are looked up, so that none is met twice.
    held = df.select(F.monotonically_increasing_id().alias("doc"), F.col(tokens).alias("held"))
    located = looked_up(held, "doc", F.col("held"), table, first, -1, "words", unique=True)
    low, high = F.shiftright("code", 32).cast("int"), F.col("code").bitwiseAND((1 << 32) - 1).cast("int")
    pairs = pair_counts(located, window).select(low.alias("word"), high.alias("context"), "n")
    return written(pairs.withColumn("n", F.when(F.col("word") == F.col("context"), 2 * F.col("n")).otherwise(F.col("n"))), "pairs")


def cooccurrences(df: DataFrame, tokens: str, window: int = 5, min_count: int = 2, often: DataFrame | None = None) -> DataFrame:
    """(word, context, n), written: how often two words stand within ``window`` places, either one first.

    Words that occur less than ``min_count`` times are left out before any pair is made; they keep their places in the
    texts. Rows without tokens have none. With ``often``, a table of ``often_words``, its words alone are counted and stand
    as their numbers, and each pair is one row, the smaller number first, instead of one for each direction.
    """
    small_batches(df.sparkSession)
    if often is not None:
        return numbered_pairs(df, tokens, window, often)
    often = often_words(entries(df, tokens, "word").groupBy("word").agg(F.count("*").alias("times")), min_count)
    pairs = numbered_pairs(df, tokens, window, often).withColumnsRenamed({"word": "low", "context": "high"})
    ways = F.when(F.col("low") == F.col("high"), F.array(F.struct("low", "high", "n"))).otherwise(
        F.array(F.struct("low", "high", "n"), F.struct(F.col("high").alias("low"), F.col("low").alias("high"), "n")))
    both = pairs.select(F.explode(ways).alias("way")).select("way.*")
    names = often.select("word", "number")
    named = both.join(names.withColumnRenamed("number", "low"), "low").join(
        names.withColumnsRenamed({"word": "context", "number": "high"}), "high")
    return written(named.select("word", "context", "n"), "cooccurrences")


def positive_association(counts: DataFrame, once: bool = False) -> DataFrame:
    """(word, context, n, ppmi), written: the logarithm of how much more often two words meet than by chance, where it is
    more than never. Words may be their numbers; ``once`` says that each pair is one row for both directions."""
    sides = counts.select("word", "n")
    if once:
        sides = sides.unionByName(counts.filter("word <> context").select(F.col("context").alias("word"), "n"))
    sums = written(sides.groupBy("word").agg(F.sum("n").alias("n_word")), "word-sums")
    n_words, total = sums.agg(F.count("*"), F.sum("n_word")).first()
    total = total or 0
    if n_words <= HELD_WORDS:
        sums = F.broadcast(sums)
    joined = counts.join(sums, "word").join(sums.withColumnsRenamed({"word": "context", "n_word": "n_context"}), "context")
    chance = F.col("n_word").cast("double") * F.col("n_context").cast("double")
    weighed = joined.withColumn("ppmi", F.log(F.col("n").cast("double") * F.lit(float(total)) / chance))
    return written(weighed.filter("ppmi > 0").select("word", "context", "n", "ppmi"), "association")


def signs(word: Column, size: int, seed: int) -> Column:
    """A row of plus and minus ones fixed by the word."""
    return F.array(*[F.when(F.xxhash64(word, F.lit(seed), F.lit(j)) > 0, 1.0).otherwise(-1.0) for j in range(size)])


CELL = 1 << 19  # weights of a cell on average
WEIGHTS_HELD = 1 << 20  # weights a task deals to cells at once


def grid(association: DataFrame, often: DataFrame | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(word, number), written; (cell, starts, columns, weights), written; and how many words a block has.

    Words are numbered in an order that says nothing of them and cut into blocks; a cell holds the weights of the words of
    one block beside those of the same or a later one, each pair once, as rows one after the other. With ``often`` words
    have their numbers already, and each pair is one row.
    """
    small_batches(association.sparkSession)
    if often is None:
        words = ordered_index(association.select("word").distinct(), F.xxhash64("word"), F.col("word"))
        numbered = written(words.select("word", F.col("index").alias("number")), "numbers")
        placed = association.select("word", "context", "ppmi").join(numbered, "word").join(
            numbered.withColumnsRenamed({"word": "context", "number": "other"}), "context").filter("number <= other")
        n_weights = association.count()
    else:
        numbered = often.select("word", F.col("number").cast("bigint").alias("number"))
        placed = association.select(F.col("word").cast("bigint").alias("number"), F.col("context").cast("bigint").alias("other"), "ppmi")
        n_weights = 2 * association.count()
    width = -(-numbered.count() // max(1, math.isqrt(n_weights // CELL)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            parts.append(tuple(batch.column(c).to_numpy() for c in ("number", "other", "ppmi")))
            if sum(len(x[0]) for x in parts) >= WEIGHTS_HELD:
                yield pieces(parts)
                parts = []
        if parts:
            yield pieces(parts)

    def pieces(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        number, other, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
        cell = (number // width << 32) + other // width
        order = np.argsort(cell, kind="stable")
        found, starts = np.unique(cell[order], return_index=True)
        edges = np.append(starts, len(cell))
        held = [x[order] for x in ((number % width).astype(np.int32), (other % width).astype(np.int32), weight)]
        return pa.RecordBatch.from_arrays([pa.array(found), *[
            pa.array([x[low:high].tobytes() for low, high in zip(edges, edges[1:])], pa.binary()) for x in held]], ["cell", "one", "two", "ppmi"])

    def cell_of(cell: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        one, two, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(one.astype(np.int64) * width + two)
        starts = np.searchsorted(one[order], np.arange(width + 1))
        held = [x.tobytes() for x in (starts.astype(np.int32), two[order].astype(np.int32), weight[order])]
        return pa.RecordBatch.from_arrays([pa.array([cell], pa.int64()), *[pa.array([x], pa.binary()) for x in held]],
                                          ["cell", "starts", "columns", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        at = -1
        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != at and parts:
                    yield cell_of(at, parts)
                    parts = []
                at = r["cell"]
                parts.append(tuple(np.frombuffer(r[c], kind) for c, kind in (("one", np.int32), ("two", np.int32), ("ppmi", float))))
        if parts:
            yield cell_of(at, parts)

    weights = placed.select("number", "other", "ppmi").mapInArrow(packed, "cell long, one binary, two binary, ppmi binary")
    cells = weights.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        run, "cell long, starts binary, columns binary, weights binary")
    return numbered, written(cells, "cells"), width


STEP = 1 << 12  # weights multiplied at once


def row_sums(starts: np.ndarray, columns: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the rows that have weights, and for each the sum of its weights times the rows of its columns."""
    used = np.flatnonzero(np.diff(starts))
    begins, total = starts[used], np.empty((len(used), rows.shape[1]))
    low = 0
    while low < len(used):  # whole rows, some STEP weights of them
        high = max(low + 1, int(np.searchsorted(begins, begins[low] + STEP)))
        first, last = begins[low], begins[high] if high < len(used) else len(columns)
        total[low:high] = np.add.reduceat(weights[first:last, None] * rows[columns[first:last]], begins[low:high] - first, axis=0)
        low = high
    return used, total


def applied(cells: DataFrame, rows: DataFrame, width: int, size: int) -> DataFrame:
    """(number, row), written: the product of the symmetric matrix in cells and rows (number, row).

    A block of rows goes to the cells of its words, where it is multiplied; no row is written for a weight. A row that is
    not given is zero.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = -1, np.zeros((width, size))
        for batch in batches:
            number = batch.column("number").to_numpy()
            row = batch.column("row").flatten().to_numpy().reshape(len(number), size)
            for one in np.unique(number // width):
                if one != block and block >= 0:
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([held.tobytes()])], ["block", "rows"])
                    held[:] = 0.0
                block = int(one)
                some = number // width == one
                held[number[some] % width] = row[some]
        if block >= 0:
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([held.tobytes()])], ["block", "rows"])

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, first = (), np.zeros((0, size))

        def sums(block: int, found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            used, total = found
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * size, pa.int32()), pa.array(total.ravel()))
            return pa.RecordBatch.from_arrays([pa.array(block * width + used), lists], ["number", "row"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["side"] == 0:
                    cell = tuple(np.frombuffer(r[c], t) for c, t in (("starts", np.int32), ("columns", np.int32), ("weights", float)))
                    continue
                here = np.frombuffer(r["rows"], float).reshape(-1, size)
                one, two = r["cell"] >> 32, r["cell"] & 0xFFFFFFFF
                if r["side"] == 1:
                    first = here
                if r["side"] == 2 or one == two:
                    yield sums(one, row_sums(*cell, here))
                    starts, columns, weights = cell
                    line = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                    order = np.argsort(columns, kind="stable")
                    if one == two:
                        order = order[line[order] != columns[order]]
                    turned_starts = np.searchsorted(columns[order], np.arange(width + 1))
                    yield sums(two, row_sums(turned_starts, line[order], weights[order], first))

    block = F.floor(F.col("number") / width)
    blocks = rows.select("number", "row").repartition(block).sortWithinPartitions("number").mapInArrow(packed, "block long, rows binary")
    places = cells.select("cell", F.shiftright("cell", 32).alias("one"), F.col("cell").bitwiseAND((1 << 32) - 1).alias("two"))
    sides = F.array(F.struct(F.col("one").alias("block"), F.lit(1).alias("side")), F.struct(F.col("two").alias("block"), F.lit(2).alias("side")))
    wanted = places.select("cell", F.inline(F.when(F.col("one") == F.col("two"), F.slice(sides, 1, 1)).otherwise(sides)))
    met = cells.withColumn("side", F.lit(0)).unionByName(wanted.join(blocks, "block").drop("block"), allowMissingColumns=True)
    sums = met.repartition("cell").sortWithinPartitions("cell", "side").mapInArrow(multiplied, "number long, row array<double>")
    added = sums.groupBy("number").agg(*[F.sum(F.col("row")[j]).alias(f"s{j}") for j in range(size)])
    return written(added.select("number", F.array(*[f"s{j}" for j in range(size)]).alias("row")), "rows")


def products(a: DataFrame, b: DataFrame, size: int) -> np.ndarray:
    """The inner products of all columns of two tables of rows, of which there are few."""
    both = a.join(b.withColumnRenamed("row", "other"), "number") if a is not b else a.withColumn("other", F.col("row"))
    found = both.select(F.posexplode("row").alias("i", "x"), "other").groupBy("i").agg(
        *[F.sum(F.col("x") * F.col("other")[j]).alias(f"s{j}") for j in range(size)]).orderBy("i").collect()
    return np.array([list(r)[1:] for r in found], dtype=float).reshape(-1, size)


def turned(rows: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Each row times a small matrix."""
    columns = [F.array(*[F.lit(float(x)) for x in column]) for column in matrix.T]
    total = [F.aggregate(F.zip_with("row", c, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) for c in columns]
    return rows.select("number", F.array(*total).alias("row"))


def orthonormal(rows: DataFrame, size: int) -> DataFrame:
    """The same space with columns of length one at right angles; directions without extent are left out."""
    gram = products(rows, rows, size)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    kept = values > values.max(initial=0.0) * 1e-10
    return written(turned(rows, vectors[:, kept] / np.sqrt(values[kept])), "basis")


def svd_vectors(association: DataFrame, dimension: int = 32, more: int = 8, rounds: int = 2, seed: int = 1,
                often: DataFrame | None = None) -> DataFrame:
    """(word, vector), written: words along the main directions of a symmetric table (word, context, ppmi).

    With ``often`` the table has numbers of these words, each pair once; words that are in no pair get no vector.

    A randomised decomposition: the table applied to ``dimension + more`` random rows, ``rounds`` times over, spans its
    main directions; its restriction to them is a small matrix whose eigenvectors the driver finds. Directions are scaled
    by the root of their strength. A table without rows gives none.
    """
    if association.isEmpty():
        none = association.select(F.col("word").cast("string").alias("word"))
        return none.select("word", F.array().cast("array<double>").alias("vector"))
    size = dimension + more
    numbered, cells, width = grid(association, often)
    basis = numbered.select("number", signs(F.col("word"), size, seed).alias("row"))
    for _ in range(rounds + 1):
        image = applied(cells, basis, width, size)
        basis = orthonormal(image, size)
        size = len(basis.first()["row"])
    small = products(basis, applied(cells, basis, width, size), size)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    main = np.argsort(-np.abs(values))[:dimension]
    scaled = vectors[:, main] * np.sqrt(np.abs(values[main]))
    vectors = turned(basis, scaled).join(numbered, "number").select("word", F.col("row").alias("vector"))
    return written(vectors, "word-vectors")
