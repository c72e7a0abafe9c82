"""Packing of texts into batches of nearly equal lengths.

The lengths of all pieces form one histogram. Dynamic programming over it finds the bucket boundaries with the least
padding; inside each bucket as many pieces make a batch as the token budget holds.

Pieces are numbered by one range-partitioned order of bucket and identifier, so a bucket that holds most of the pieces
is spread over as many tasks as its size asks for.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, identified
from tidemill.operators.windows import ordered_index
from tidemill.session import written

MAX_LENGTH = 2048  # tokens; a longer text is cut into pieces of this length
BUCKETS = 16
TOKEN_BUDGET = 16384  # of a batch, padding included
WHITE_SPACE = r"[\x20\x09-\x0D]+"


TOKEN_BYTES = 8


def token_count(text):
    """One token for each begun ``TOKEN_BYTES`` bytes of each word between ASCII white space.

    Most words are one token; text without spaces, as in Chinese or in encoded data, is as many as its bytes ask for.
    """
    words = F.array_remove(F.split(text, WHITE_SPACE), "")
    return F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.ceil(F.octet_length(w) / TOKEN_BYTES))


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding; of equal choices the lowest bounds.

    ``lengths`` ascend. The padding of a bucket is its bound less the length, summed over its pieces.
    """
    if not len(lengths):
        return []
    n = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    m, k = len(lengths), min(buckets, len(lengths))

    def padding(upto: int) -> np.ndarray:
        """Of one bucket from each possible start to length number ``upto``."""
        return lengths[upto - 1] * (n[upto] - n[:upto]) - (tokens[upto] - tokens[:upto])

    worst = np.iinfo(np.int64).max // 4
    best = np.full(m + 1, worst)
    best[0] = 0
    choices = []
    for _ in range(k):
        now, choice = np.full(m + 1, worst), np.zeros(m + 1, dtype=np.int64)
        for upto in range(1, m + 1):
            cost = best[:upto] + padding(upto)
            choice[upto] = cost.argmin()
            now[upto] = cost[choice[upto]]
        best = now
        choices.append(choice)
    bounds, upto = [], m
    for choice in reversed(choices):
        bounds.append(int(lengths[upto - 1]))
        upto = int(choice[upto])
    return bounds[::-1]


def pieces(docs: DataFrame, max_length: int, length=token_count) -> DataFrame:
    """(doc_id, text_key, piece, first_token, n_tokens): consecutive stretches of at most ``max_length`` tokens."""
    sized = docs.select("doc_id", F.xxhash64("text").alias("text_key"), length(F.col("text")).alias("total"))
    last = F.greatest(F.expr(f"(total - 1) div {max_length}"), F.lit(0))
    cut = sized.withColumn("piece", F.explode_outer(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("piece") * max_length
    return cut.select("doc_id", "text_key", "piece", first.alias("first_token"),
                      F.least(F.col("total") - first, F.lit(max_length)).alias("n_tokens"))


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET,
         id_column: str = "doc_id", text_column: str = "text", length=token_count) -> DataFrame:
    """One row per piece: doc_id, piece, first_token, n_tokens, bucket, padded_length, batch_id, slot.

    A text longer than ``max_length`` is cut, none of its tokens is lost. A text without tokens, empty or missing, is
    one piece of length 0. Every batch holds pieces of one bucket and at most ``budget`` tokens with padding, one
    piece at least. Pieces of a bucket follow in the order of doc_id, missing ones first, then of a hash of the text.
    Repeated rows are packed each for itself. ``length`` gives the number of tokens of a text column. Other columns are
    left out, whatever their names. No rows give no rows.
    """
    rows = written(pieces(identified(docs, id_column, text_column), max_length, length), "pieces")
    # At most max_length + 1 rows, whatever the number of documents.
    histogram = sorted((r["n_tokens"], r["count"]) for r in rows.groupBy("n_tokens").count().collect())
    lengths, counts = np.array(histogram, dtype=np.int64).reshape(-1, 2).T
    bounds = best_bounds(lengths, counts, buckets)
    held = [int(counts[(lengths <= b) & (lengths > a)].sum()) for a, b in zip([-1, *bounds], bounds, strict=False)]
    per_batch = [max(1, budget // max(1, b)) for b in bounds]
    batches = [-(-n // size) for n, size in zip(held, per_batch, strict=True)]

    def of_bucket(values: list[int]):
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values or [0]]), F.col("bucket") + 1)

    below = F.filter(F.array(*[F.lit(b).cast("long") for b in bounds or [0]]), lambda b: b < F.col("n_tokens"))
    placed = ordered_index(rows.withColumn("bucket", F.size(below)), "bucket", "doc_id", "text_key", "piece")
    place = F.col("index") - of_bucket([sum(held[:i]) for i in range(len(held))])
    size = of_bucket(per_batch)
    return placed.select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket", of_bucket(bounds).alias("padded_length"),
        (of_bucket([sum(batches[:i]) for i in range(len(batches))]) + F.floor(place / size)).alias("batch_id"),
        F.pmod(place, size).alias("slot"),
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents_of(spark, folder))


QUERIES = {"op6_packing": op6_packing}
ORACLES: dict[str, str] = {}
