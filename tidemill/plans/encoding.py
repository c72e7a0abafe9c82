"""Labels, splits, batches and word indexes over the documents."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemill.functions.text import word_tokens
from tidemill.functions.values import decode_label, encode_label, hash_order, in_fraction, one_hot
from tidemill.operators import frames
from tidemill.operators import vocabulary as voc
from tidemill.operators import windows, wordvectors
from tidemill.operators.models import train_word_vectors
from tidemill.operators.vectors import nearest_or_unknown
from tidemill.session import scratch_path, written
from tidemill.sources import sinks
from tidemill.sources.tables import table

LANGUAGES = ["de", "en", "fr"]  # es is left out, so its label is unknown
LENGTH = 300
BATCH = 128


def labelled(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.col("lang").alias("label"))


def label_encode(spark, folder):
    return labelled(spark, folder).select("doc_id", encode_label(F.col("label"), LANGUAGES).alias("code"))


def label_decode(spark, folder):
    codes = label_encode(spark, folder)
    return codes.select("doc_id", decode_label(F.col("code"), LANGUAGES).alias("label"))


def one_hot_labels(spark, folder):
    hot = F.transform(one_hot(F.col("code"), len(LANGUAGES)), lambda x: x.cast("string"))
    return label_encode(spark, folder).select("doc_id", F.array_join(hot, "").alias("one_hot"))


def label_set(spark, folder):
    return labelled(spark, folder).groupBy("label").agg(F.count("*").alias("n_docs")).orderBy(
        F.desc("n_docs"), "label"
    )


def train_val_split(spark, folder):
    split = windows.split_exact(table(spark, folder, "documents").select("doc_id"), "doc_id", 0.9)
    return split.select("doc_id", "index", "split")


def fraction_split(spark, folder):
    """A split by threshold: needs no order and no shuffle."""
    side = F.when(in_fraction(F.col("doc_id"), 0.6), "train").otherwise("val")
    return table(spark, folder, "documents").select("doc_id", side.alias("split"))


def shuffle_order(spark, folder):
    return table(spark, folder, "labels").select("doc_id", hash_order(F.col("doc_id")).alias("shuffle"))


def batch_ids(spark, folder):
    return windows.batch_ids(table(spark, folder, "documents").select("doc_id"), ["doc_id"], BATCH)


def cyclic_batches(spark, folder):
    """Two rounds over the labels in batches of 64, shuffled inside each batch."""
    rows = table(spark, folder, "labels")
    n_batches = math.ceil(2 * rows.count() / 64)
    return windows.cyclic_batches(rows, ["doc_id"], 64, n_batches, "doc_id", shuffle_seed=100).select(
        "batch_id", "slot", "doc_id", "quality"
    )


def tokens(spark, folder):
    rows = frames.spread(table(spark, folder, "documents").select("doc_id", "lang", "text"))
    return rows.select("doc_id", "lang", word_tokens(F.col("text")).alias("tokens"))


def words(spark, folder):
    texts = frames.spread(table(spark, folder, "documents").select("text"))
    return voc.build_vocabulary(texts.select(word_tokens(F.col("text")).alias("tokens")), "tokens", 2)


def vocabulary(spark, folder):
    return words(spark, folder)


def matrix(spark, folder, vocabulary_table):
    return voc.index_matrix(tokens(spark, folder), "doc_id", "tokens", vocabulary_table, LENGTH)


def text_sum(text):
    """A number that stands for a text; added up, for the contents of a file."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def as_text(column):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), " ")


def word_index_matrix(spark, folder):
    return matrix(spark, folder, words(spark, folder)).select("doc_id", as_text("idx").alias("idx"))


def index_to_word(spark, folder):
    vocabulary_table = words(spark, folder)
    back = voc.words_of_indexes(matrix(spark, folder, vocabulary_table), "doc_id", "idx", vocabulary_table, LENGTH)
    return back.select("doc_id", F.array_join("words", " ").alias("words"))


def labelled_matrix(spark, folder):
    return voc.labelled_matrix(matrix(spark, folder, words(spark, folder)), labelled(spark, folder), "doc_id", "label",
                               LANGUAGES)


def matrix_roundtrip(spark, folder):
    """The label and index rows written by split and batch, read back and counted per file group."""
    path = scratch_path(spark, "matrix")
    sided = windows.split_exact(table(spark, folder, "documents").select("doc_id"), "doc_id", 0.9)
    placed = sided.withColumn("batch_id", F.expr(f"index div {BATCH}")).select("doc_id", "split", "batch_id")
    sinks.write_matrix(labelled_matrix(spark, folder).join(placed, "doc_id"), path)
    stored = spark.read.schema("doc_id bigint, label int, idx array<int>, split string, batch_id bigint").parquet(path)
    content = F.sum(text_sum(F.concat_ws(":", "label", as_text("idx")))).alias("content")
    return voc.matrix_sizes(stored.filter(F.size("idx") == LENGTH), "split", "batch_id", measures=[content])


def token_batches(spark, folder):
    """Space-joined tokens written as one text folder per batch of documents; lines and characters read back."""
    path = scratch_path(spark, "tokens")
    texts = table(spark, folder, "documents").select("doc_id", "text")
    batched = windows.batch_ids(texts.select("doc_id"), ["doc_id"], BATCH).select("doc_id", "batch_id")
    rows = frames.spread(texts).join(batched, "doc_id").select("batch_id", word_tokens(F.col("text")).alias("tokens"))
    sinks.write_token_batches(rows, "tokens", "batch_id", path)
    stored = spark.read.schema("value string, batch_id bigint").text(path)
    return stored.groupBy("batch_id").agg(F.count("*").alias("n_docs"), F.sum(F.length("value")).alias("n_chars"),
                                          F.sum(text_sum(F.col("value"))).alias("content"))


def vector_lookup(spark, folder):
    """The vector behind every event's user number, zeros for users without one."""
    keyed = table(spark, folder, "events").select("event_id", (F.col("user_id") * 4).alias("vec_id"))
    found = voc.vectors_of_keys(keyed, table(spark, folder, "embeddings"), "vec_id", "embedding", 64)
    return found.select("event_id", "vec_id", "known", F.round(F.col("embedding")[0].cast("double"), 6).alias("v0"),
                        F.round(F.col("embedding")[63].cast("double"), 6).alias("v63"),
                        F.size("embedding").alias("dimension"))


def word2vec_synonyms(spark, folder):
    """The five words nearest to each of the ten most frequent words."""
    model = train_word_vectors(tokens(spark, folder), "tokens", dimension=64, min_count=5)
    vocabulary_table = written(words(spark, folder).select("word", "index"), "words")
    vectors = model.getVectors().join(vocabulary_table, "word").select(
        F.col("index").alias("vec_id"), "word", vector_to_array("vector").alias("embedding")
    )
    frequent = vocabulary_table.filter(F.col("index") < 10).select(F.col("index").alias("vec_id"))
    best = nearest_or_unknown(frequent, vectors, 5)
    names = vocabulary_table.select(F.col("index").alias("id"), F.col("word").alias("neighbour"))
    asked = vocabulary_table.select(F.col("index").alias("query_id"), "word")
    return best.join(names, "id", "left").join(asked, "query_id").select(
        "word", "neighbour", F.round("score", 4).alias("cosine"), "rank", "status"
    )


def association(spark, folder):
    """Words that occur at least fifty times and stand within five places of each other more often than by chance."""
    return wordvectors.positive_association(wordvectors.cooccurrences(tokens(spark, folder), "tokens", 5, 50))


def ppmi_weights(spark, folder):
    return association(spark, folder).withColumn("ppmi", F.round("ppmi", 6))


def svd_synonyms(spark, folder):
    """The five words nearest to each of the ten most frequent words, by vectors from counts."""
    listed = written(words(spark, folder).select("word", "n", F.col("index").alias("vec_id")), "words")
    often = wordvectors.often_words(listed.withColumnRenamed("n", "times"), 50)
    weights = wordvectors.positive_association(wordvectors.cooccurrences(tokens(spark, folder), "tokens", 5, 50, often), once=True)
    vectors = wordvectors.svd_vectors(weights, often=often)
    numbered = listed.select("word", "vec_id")
    known = vectors.join(numbered, "word").withColumnRenamed("vector", "embedding")
    best = nearest_or_unknown(numbered.filter("vec_id < 10").select("vec_id"), known, 5)
    names = numbered.select(F.col("vec_id").alias("id"), F.col("word").alias("neighbour"))
    asked = numbered.select(F.col("vec_id").alias("query_id"), "word")
    return best.join(names, "id", "left").join(asked, "query_id").select(
        "word", "neighbour", F.round("score", 4).alias("cosine"), "rank", "status")


QUERIES = {
    "ppmi_weights": ppmi_weights,
    "svd_synonyms": svd_synonyms,
    "label_encode": label_encode,
    "label_decode": label_decode,
    "one_hot": one_hot_labels,
    "label_set": label_set,
    "train_val_split": train_val_split,
    "fraction_split": fraction_split,
    "shuffle_order": shuffle_order,
    "batch_ids": batch_ids,
    "cyclic_batches": cyclic_batches,
    "vocabulary": vocabulary,
    "word_index_matrix": word_index_matrix,
    "index_to_word": index_to_word,
    "matrix_roundtrip": matrix_roundtrip,
    "token_batches": token_batches,
    "vector_lookup": vector_lookup,
    "word2vec_synonyms": word2vec_synonyms,
}
