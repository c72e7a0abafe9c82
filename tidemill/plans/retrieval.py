"""Vector search over the embeddings. The first vector of every label serves as its query."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import vectors as vec
from tidemill.operators.windows import top_k
from tidemill.sources.tables import table


def embeddings(spark, folder):
    return table(spark, folder, "embeddings")


def prototypes(spark, folder):
    return embeddings(spark, folder).groupBy("label").agg(F.min("vec_id").alias("proto_id"))


def label_queries(spark, folder):
    first = prototypes(spark, folder).select(F.col("proto_id").alias("vec_id"))
    return embeddings(spark, folder).join(first, "vec_id").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )


def vector_topk_l2(spark, folder):
    best = vec.nearest(embeddings(spark, folder), label_queries(spark, folder), 2)
    return best.select("query_id", "id", F.round("score", 6).alias("distance"), "rank")


def vector_topk_blocks(spark, folder):
    """The same search in blocks of a few queries, as for a query set too large to be sent to every task at once."""
    best = vec.nearest(embeddings(spark, folder), label_queries(spark, folder), 2, max_values=256)
    return best.select("query_id", "id", F.round("score", 6).alias("distance"), "rank")


def every_fiftieth(spark, folder):
    return embeddings(spark, folder).filter(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), F.array("vec_id").alias("excluded"))


def vector_neighbours_l2(spark, folder):
    """The ten nearest vectors of each vector whose number is divisible by 50."""
    best = vec.nearest(embeddings(spark, folder), every_fiftieth(spark, folder), 10)
    return best.select("query_id", "id", F.round("score", 6).alias("distance"), "rank")


def vector_neighbours_cosine(spark, folder):
    best = vec.nearest(embeddings(spark, folder), every_fiftieth(spark, folder), 10, "cosine")
    return best.select("query_id", "id", F.round("score", 6).alias("cosine"), "rank")


def cosine_pair(spark, folder):
    """Cosine of every vector with the first vector of its label."""
    pairs = embeddings(spark, folder).select("vec_id", "label").join(prototypes(spark, folder), "label")
    scored = vec.pair_cosine(pairs, embeddings(spark, folder), "vec_id", "proto_id", "vec_id", "embedding")
    return scored.select("vec_id", "proto_id", "label", F.round("cosine", 6).alias("cosine"))


def nearest_words(spark, folder):
    """Ten neighbours of every label's first vector; number -1 has no vector."""
    asked = prototypes(spark, folder).select(F.col("proto_id").alias("vec_id"))
    missing = asked.select(F.lit(-1).cast("bigint").alias("vec_id")).distinct()
    best = vec.nearest_or_unknown(asked.unionByName(missing), embeddings(spark, folder), 10)
    return best.select("query_id", "id", F.round("score", 6).alias("cosine"), "rank", "status")


def analogy_vector(spark, folder):
    """first + second - third vector of every label: the ten nearest of the rest."""
    numbered = top_k(embeddings(spark, folder).select("label", "vec_id"), ["label"], [F.col("vec_id")], 3)
    examples = numbered.select(
        F.col("label").cast("bigint").alias("query_id"), "vec_id",
        F.when(F.col("rank") == 3, -1.0).otherwise(1.0).alias("sign"),
    )
    queries = vec.analogy_queries(spark, examples, embeddings(spark, folder))
    best = vec.nearest(embeddings(spark, folder), queries, 10, "cosine")
    return best.select("query_id", "id", F.round("score", 6).alias("cosine"), "rank")


def first_components(spark, folder):
    parts = vec.first_components(F.col("embedding"), 5)
    return embeddings(spark, folder).select(
        "vec_id", *[F.round(parts[i].cast("double"), 6).alias(f"c{i}") for i in range(5)]
    )


QUERIES = {
    "vector_topk_l2": vector_topk_l2,
    "vector_topk_blocks": vector_topk_blocks,
    "vector_neighbours_l2": vector_neighbours_l2,
    "vector_neighbours_cosine": vector_neighbours_cosine,
    "cosine_pair": cosine_pair,
    "nearest_words": nearest_words,
    "analogy_vector": analogy_vector,
    "first_components": first_components,
}
