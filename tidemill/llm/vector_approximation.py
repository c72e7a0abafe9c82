"""Exact top-k by inner product over a vector-approximation file.

Every component is an integer and lies in one of ``CELLS`` cells of its position, so a vector has an approximation of
one byte a component. The corners of its cells bound its product with a query from both sides. A first scan over the
approximations finds for each query a value that its kth score reaches for certain; a second one lists the vectors whose
upper bound reaches it. Exact vectors are then read in the order of their bounds, the most promising first, in rounds,
until no vector is left whose bound reaches the kth exact score.

Equal vectors are one entry with their first members, so a vector that makes up a third of the table is looked at once.
Queries and approximations meet in blocks: a grid deals blocks of both to its fields, and each pair of blocks shares one
field. Neither side is sent to all tasks nor to the driver; only the cells' edges are, a few numbers for each position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.session import written

CELLS = 64
TAILS = (0.001, 0.999)  # shares of values between which cells are of equal width; the outer cells take the rest
ROWS = 2048  # approximations in a block
QUERIES_AT_ONCE = 512  # queries in a block
FIELD = 64  # blocks of one side that meet in a field of the grid
WIDER = 4  # each round reads so many times as many vectors as the one before


WHOLE = "decimal(38,0)"  # a vector's product with itself is met too, and may be long though no wanted score is


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("decimal(19,0)") * y.cast("decimal(19,0)"))
    return F.aggregate(products, F.lit(0).cast(WHOLE), lambda s, x: (s + x).cast(WHOLE))


def integers(vectors: DataFrame, asked: Column, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(row, vec_id, asked, v): vectors without gaps, each component floor(scale * x)."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(vector.isNotNull() & whole).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.coalesce(asked, F.lit(False)).alias("asked"), F.transform(vector, lambda x: F.floor(x * scale)).alias("v"))


MEMBER = ("unnamed", "vec_id", "row")


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """(gid, v, members): different vectors, each with its first k rows by vec_id, rows without one last."""
    order = W.partitionBy("v").orderBy(*MEMBER)
    first = rows.withColumn("unnamed", F.col("vec_id").isNull()).withColumn("place", F.row_number().over(order))
    held = first.filter(F.col("place") <= k).groupBy("v").agg(F.collect_list(F.struct(*MEMBER)).alias("members"))
    return written(held.withColumn("gid", F.monotonically_increasing_id()), "vectors")


def cell_edges(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest value of each cell, position by position."""
    spread = entries.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(
        F.min("x").alias("least"), F.max("x").alias("most"), F.percentile_approx("x", list(TAILS), 1000).alias("tails"))
    low, high = [], []
    for least, most, tails in ((r.least, r.most, r.tails) for r in spread.orderBy("at").collect()):
        inner = [min(max(tails[0] + (tails[1] - tails[0]) * i // (CELLS - 2), least), most + 1) for i in range(CELLS - 1)]
        low.append([least, *inner])
        high.append([*(x - 1 for x in inner), most])
    return (np.array(x, dtype=np.int64).reshape(-1, CELLS) for x in (low, high))


def matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of one vector length, at most ``size`` at once, and their vectors as a matrix."""
    held: dict[int, list[pa.Table]] = {}

    def parts(n: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
        table = pa.concat_tables(held.pop(n)).combine_chunks()
        for start in range(0, len(table), size):
            part = table.slice(start, size).combine_chunks()
            vectors = part.column("v").combine_chunks()
            yield part, vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(part), n)

    for batch in batches:
        lengths = np.diff(batch.column("v").offsets.to_numpy())
        for n in np.unique(lengths).tolist():
            held.setdefault(n, []).append(pa.Table.from_batches([batch.filter(pa.array(lengths == n))]))
            if sum(map(len, held[n])) >= size:
                yield from parts(n)
        while len(held) > 16:  # lengths that are seldom met are not kept waiting
            yield from parts(next(iter(held)))
    for n in list(held):
        yield from parts(n)


def approximations(entries: DataFrame, low: np.ndarray) -> DataFrame:
    """(n, ids, cells): blocks of entries with vectors of n components, one byte a component."""
    shared = entries.sparkSession.sparkContext.broadcast(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = shared.value[:, 1:]
        for table, vectors in matrices(batches, ROWS):
            cells = np.empty(vectors.shape, dtype=np.uint8)
            for i in range(vectors.shape[1]):
                cells[:, i] = np.searchsorted(edges[i], vectors[:, i], side="right")
            yield pa.RecordBatch.from_arrays([
                pa.array([vectors.shape[1]], pa.int32()), pa.array([table.column("gid").to_numpy().tobytes()], pa.binary()),
                pa.array([cells.tobytes()], pa.binary())], ["n", "ids", "cells"])

    return written(entries.select("gid", "v").mapInArrow(run, "n int, ids binary, cells binary"), "approximations")


def query_blocks(queries: DataFrame) -> DataFrame:
    """(n, asked, wanted, least): blocks of query entries, their vectors and the values their bounds must reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, vectors in matrices(batches, QUERIES_AT_ONCE):
            columns = (table.column("gid").to_numpy(), vectors.astype(np.float64), table.column("least").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([vectors.shape[1]], pa.int32()),
                                              *[pa.array([x.tobytes()], pa.binary()) for x in columns]],
                                             ["n", "asked", "wanted", "least"])

    return written(queries.select("gid", "v", "least").mapInArrow(run, "n int, asked binary, wanted binary, least binary"),
                   "query-blocks")


def met(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Every block of queries beside every block of approximations of vectors as long."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    n_files, n_blocks = files.count(), blocks.count()
    across = max(1, -(-n_files // FIELD), min(cores, n_files))
    down = max(1, -(-n_blocks // FIELD))
    x, y = (F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (across, down))
    copied = files.withColumn("x", F.pmod(F.xxhash64("ids"), F.lit(across).cast("long"))).withColumn("y", y)
    other = blocks.withColumn("y", F.pmod(F.xxhash64("asked"), F.lit(down).cast("long"))).withColumn("x", x)
    dealt = copied.repartition(min(across * down, 1 << 15), "n", "x", "y")
    return dealt.join(other, ["n", "x", "y"]).select("n", "ids", "cells", "asked", "wanted", "least")


def scanned(blocks: DataFrame, files: DataFrame, edges: tuple[np.ndarray, np.ndarray], use, schema: str) -> DataFrame:
    """``use(entry ids, query ids, least values, lower bounds, upper bounds)`` for each pair of blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(tuple(x.astype(np.float64) for x in edges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = shared.value
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                n, at = row["n"], np.arange(row["n"])
                ids, asked = (np.frombuffer(row[c], np.int64) for c in ("ids", "asked"))
                wanted = np.frombuffer(row["wanted"], np.float64).reshape(len(asked), n)
                cells = np.frombuffer(row["cells"], np.uint8).reshape(len(ids), n)
                least, most = low[at, cells], high[at, cells]
                plus, minus = np.maximum(wanted, 0), np.minimum(wanted, 0)
                # Whole numbers are exact up to 2^53; beyond, the bounds give way by more than rounding can take.
                size = np.abs(wanted) @ np.maximum(np.abs(low[:n, 0]), np.abs(high[:n, -1]))
                slack = np.where(size < 2.0 ** 52, 0.0, size * (n + 2) * 2.0 ** -50)[:, None]
                lower = plus @ least.T + minus @ most.T - slack
                upper = plus @ most.T + minus @ least.T + slack
                yield use(ids, asked, np.frombuffer(row["least"], np.float64), lower, upper)

    return met(blocks, files).mapInArrow(run, schema)


def certain_values(blocks: DataFrame, files: DataFrame, edges, k: int) -> DataFrame:
    """(gid, least): for each query the kth largest lower bound, which its kth score reaches; -inf where fewer are."""
    def use(ids, asked, _, lower, __) -> pa.RecordBatch:
        best = -np.partition(-lower, min(k, lower.shape[1]) - 1, axis=1)[:, :k]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, best.shape[1])), pa.array(best.ravel())], ["gid", "bound"])

    found = scanned(blocks, files, edges, use, "gid long, bound double")
    order = W.partitionBy("gid").orderBy(F.desc("bound"))
    top = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    reached = F.when(F.count("*") == k, F.min("bound")).otherwise(float("-inf"))
    return top.groupBy("gid").agg(reached.alias("least"))


def candidates(blocks: DataFrame, files: DataFrame, edges) -> DataFrame:
    """(query, gid, bound): the entries whose upper bound reaches what the query's kth score reaches."""
    def use(ids, asked, least, _, upper) -> pa.RecordBatch:
        q, x = np.nonzero(upper >= least[:, None])
        return pa.RecordBatch.from_arrays([pa.array(asked[q]), pa.array(ids[x]), pa.array(upper[q, x])],
                                          ["query", "gid", "bound"])

    return written(scanned(blocks, files, edges, use, "query long, gid long, bound double"), "candidates")


BEST = ("query", "score", *MEMBER)


def read_in_order(found: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(query, score, member): the k best rows of each query, exact vectors read by their bounds until that is certain."""
    vectors = entries.select("gid", "v", "members")
    wanted = entries.select(F.col("gid").alias("query"), F.col("v").alias("wanted"))
    best, left, width = None, found, k
    while True:
        order = W.partitionBy("query").orderBy(F.desc("bound"), "gid")
        chosen = written(left.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= width), "chosen")
        scored = chosen.join(vectors, "gid").join(wanted, "query").select(
            "query", dot(F.col("v"), F.col("wanted")).alias("score"), F.explode("members").alias("member"))
        scored = scored.select("query", "score", "member.*")
        every = scored if best is None else best.select(*BEST).unionByName(scored)
        top = W.partitionBy("query").orderBy(F.desc("score"), *MEMBER)
        best = written(every.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k), "best")
        kth = best.groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
        read = chosen.groupBy("query").agg(F.min_by(F.struct("bound", "gid"), F.struct(F.col("bound"), -F.col("gid"))).alias("read"))
        state = kth.join(read, "query")
        after = (F.col("bound") < F.col("read.bound")) | ((F.col("bound") == F.col("read.bound")) & (F.col("gid") > F.col("read.gid")))
        # A vector of the same score may still have a smaller vec_id.
        open_ = left.join(state, "query").filter(after & (F.col("kth").isNull() | (F.col("bound") >= F.col("kth").cast("double"))))
        left = written(open_.select("query", "gid", "bound"), "left")
        if left.isEmpty():
            return best
        width *= WIDER


def search(vectors: DataFrame, asked: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
           scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which ``asked`` holds.

    The score is the inner product of the components floor(scale * x), as whole numbers; one that passes 64 bits is an
    error. Ties go to the smaller vec_id; a missing one comes last, equal ones in the order of the scan. Vectors that are
    missing or hold missing or infinite components or no numbers take no part; vectors meet only those of their own
    length, an empty one other empty ones with the score zero. Rows repeated in the table are searched for and found each
    for itself. A query with fewer others has fewer rows; ``asked`` counts as false where it is missing. Other columns are
    left out, whatever their names. No rows give no rows.
    """
    rows = written(integers(vectors, asked, id_column, vector_column, scale), "rows")
    entries = entries_of(rows, k + 1)  # one more than asked for, as a query's own row is among them
    queries = written(rows.filter("asked").select("vec_id", "row", "v").join(entries.select("gid", "v"), "v").drop("v"), "asked")
    sought = entries.join(queries.select("gid").distinct(), "gid", "left_semi").select("gid", "v")
    edges = tuple(cell_edges(entries))
    files = approximations(entries, edges[0])
    blocks = query_blocks(sought.withColumn("least", F.lit(float("-inf"))))
    least = written(certain_values(blocks, files, edges, k + 1), "least")
    best = read_in_order(candidates(query_blocks(sought.join(least, "gid")), files, edges), entries, k + 1)
    named = queries.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), F.col("gid").alias("query"))
    others = named.join(best.drop("place"), "query").filter(F.col("row") != F.col("own"))
    order = W.partitionBy("own").orderBy(F.desc("score"), *MEMBER)
    ranked = others.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def op11_vector_approximation(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {"op11_vector_approximation": op11_vector_approximation}
ORACLES = {"op11_vector_approximation": """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
        FROM scored)
    FROM ranked WHERE rank <= 5
"""}
