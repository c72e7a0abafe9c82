"""Document text: cleaning, n-grams, TF-IDF, similarity, retrieval and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as tx
from tidemill.operators import chunking, corpus, segmentation
from tidemill.operators.frames import spread
from tidemill.operators.windows import top_k
from tidemill.session import written
from tidemill.sources import files
from tidemill.sources.tables import table

LETTERS, CHARACTERS = "abcdefghij", "甲乙丙丁戊己庚辛壬癸"
LINES_PER_PAGE = 5
CHUNK_FACTOR = 1_000_000  # chunk ids are document id times this plus the chunk number


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def shared_documents(spark, folder):
    return spread(documents(spark, folder))


def clean_text(spark, folder):
    return shared_documents(spark, folder).select("doc_id", tx.clean_english(F.col("text")).alias("clean"))


def clean_lines(spark, folder):
    return shared_documents(spark, folder).select("doc_id", tx.strip_blank_lines(F.col("text")).alias("content"))


def stopword_filter(spark, folder):
    return shared_documents(spark, folder).select(
        "doc_id", F.array_join(tx.content_words(F.col("text")), " ").alias("words")
    )


def pad_tokens(spark, folder):
    return shared_documents(spark, folder).select(
        "doc_id", F.array_join(tx.pad_tokens(tx.segment(F.col("text")), 190), " ").alias("padded")
    )


def chinese_text():
    """Test texts hold no Chinese, so ten letters stand in for ten characters."""
    return F.translate("text", LETTERS, CHARACTERS)


def keep_cjk(spark, folder):
    return shared_documents(spark, folder).select("doc_id", tx.keep_cjk(chinese_text()).alias("cjk"))


def labelled_line_cleaning(spark, folder):
    return shared_documents(spark, folder).select("doc_id", tx.clean_labelled_line(chinese_text()).alias("cjk"))


def page_line_numbers(spark, folder):
    """Every line of every page with its place and length."""
    pages = chunking.pages_of_lines(documents(spark, folder), "doc_id", "text", LINES_PER_PAGE)
    return files.page_lines(pages, keys=("doc_id",)).select("doc_id", "page", "line_no", F.length("line").alias("n_chars"))


def char_tokens(spark, folder):
    tokens = tx.segment(chinese_text(), "char", tx.SEGMENT_STOP_WORDS)
    return shared_documents(spark, folder).select("doc_id", tokens.alias("tokens")).select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def chinese_documents(spark, folder):
    return documents(spark, folder).select("doc_id", chinese_text().alias("text"))


def found_words(spark, folder):
    """Ten characters vary less than thousands do, so the bounds are lower than usual."""
    return segmentation.corpus_dictionary(chinese_documents(spark, folder), "doc_id", "text", min_cohesion=1.5, min_entropy=0.3)


def corpus_words(spark, folder):
    """Words of two to four characters that the corpus itself shows."""
    words = found_words(spark, folder)
    return words.filter("cohesion IS NOT NULL").select("word", "n", *[F.round(c, 6).alias(c) for c in ("cohesion", "entropy")], "weight")


def segmented_words(spark, folder):
    """Every text cut into the words of that dictionary."""
    rows = chinese_documents(spark, folder)
    cut = segmentation.segment(rows, "doc_id", "text", found_words(spark, folder))
    return cut.select("doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words"))


def top_ngrams(spark, folder):
    return corpus.top_ngrams(shared_documents(spark, folder), "text", 3, 20)


def top_words(spark, folder):
    return corpus.top_ngrams(shared_documents(spark, folder), "text", 1, 20)


def cleaned(rows):
    return rows.select("doc_id", tx.clean_english(F.col("text")).alias("text"))


def document_weights(spark, folder):
    """Each text is cut into words once."""
    lists = written(corpus.word_lists(cleaned(shared_documents(spark, folder)), "text", "doc_id"), "words")
    return corpus.tfidf(lists, "doc_id", "words", corpus.fit_terms(lists, "words"))


def tfidf_weights(spark, folder):
    return document_weights(spark, folder).withColumn("weight", F.round("weight", 6))


def similar_documents(spark, folder):
    """The ten documents most like the first document of every source."""
    weights = document_weights(spark, folder)
    first = corpus.first_of_each_name(table(spark, folder, "documents"), "source", "doc_id").select("doc_id")
    best = corpus.similar_documents(weights, weights.join(first, "doc_id", "left_semi"), "doc_id", 10)
    return best.select("query_id", "doc_id", F.round("cosine", 6).alias("cosine"), "rank")


def cosine_neighbours(spark, folder):
    """The ten documents most like each document whose number is divisible by 50."""
    weights = document_weights(spark, folder)
    asked = documents(spark, folder).filter(F.col("doc_id") % 50 == 0).select("doc_id")
    best = corpus.cosine_topk(weights, asked, "doc_id", 10)
    return best.select("query_id", "doc_id", F.round("cosine", 6).alias("cosine"), "rank")


def bm25_search(spark, folder, **how):
    return corpus.bm25(table(spark, folder, "benchmark"), shared_documents(spark, folder), "item_id", "doc_id", 10, **how)


def bm25_search_join(spark, folder):
    """The same search with the broadcast of the asked words and their weights left out, as for very many queries."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    try:
        return written(bm25_search(spark, folder, held=0), "searched")
    finally:
        spark.conf.set(setting, before)


def rerank_candidates(spark, folder):
    questions, rows = table(spark, folder, "benchmark"), documents(spark, folder)
    candidates = corpus.bm25(questions, spread(rows), "item_id", "doc_id", 20)
    return corpus.rerank(candidates, questions, rows, "item_id", "doc_id", 5)


def fixed_stride_chunks(spark, folder):
    return chunking.stride_chunks(documents(spark, folder), "doc_id")


def recursive_chunks(spark, folder):
    return chunking.recursive_chunks(shared_documents(spark, folder), "doc_id")


def recursive_chunk_flags(spark, folder):
    return chunking.chunk_flags(recursive_chunks(spark, folder), documents(spark, folder), "doc_id")


def spans(spark, folder):
    pages = chunking.pages_of_lines(documents(spark, folder), "doc_id", "text", LINES_PER_PAGE)
    return chunking.page_spans(pages, "doc_id")


def document_pages(spark, folder):
    return spans(spark, folder)


def chunk_page(spark, folder):
    chunks = fixed_stride_chunks(spark, folder).select("doc_id", "chunk_no", "start")
    return chunking.attribute_pages(chunks, spans(spark, folder), "doc_id")


def chunk_ids(chunks):
    return chunks.withColumn("chunk_id", F.col("doc_id") * CHUNK_FACTOR + F.col("chunk_no"))


def retrieved_chunks(spark, folder):
    """The two best chunks for every question, with text length and page."""
    chunks = chunk_ids(fixed_stride_chunks(spark, folder))
    best = corpus.bm25(table(spark, folder, "benchmark"), spread(chunks), "item_id", "chunk_id", 2)
    listed = chunking.chunk_listing(best, chunks, "chunk_id")
    paged = chunking.attribute_pages(listed, spans(spark, folder), "doc_id")
    return paged.select("item_id", "rank", "chunk_id", "doc_id", "page", F.length("text").alias("n_chars"))


def answer_pages(spark, folder):
    return chunking.source_pages(retrieved_chunks(spark, folder), "item_id", "doc_id", "page")


def document_by_id(spark, folder):
    """Text and name of the first document of every source."""
    rows = table(spark, folder, "documents").select("doc_id", "source", "text")
    return top_k(rows, ["source"], [F.col("doc_id")], 1).drop("rank")


QUERIES = {
    "clean_text": clean_text,
    "clean_lines": clean_lines,
    "stopword_filter": stopword_filter,
    "pad_tokens": pad_tokens,
    "keep_cjk": keep_cjk,
    "labelled_line_cleaning": labelled_line_cleaning,
    "page_line_numbers": page_line_numbers,
    "char_tokens": char_tokens,
    "corpus_words": corpus_words,
    "segmented_words": segmented_words,
    "top_ngrams": top_ngrams,
    "top_words": top_words,
    "tfidf_weights": tfidf_weights,
    "similar_documents": similar_documents,
    "cosine_neighbours": cosine_neighbours,
    "bm25_search": bm25_search,
    "bm25_search_join": bm25_search_join,
    "rerank_candidates": rerank_candidates,
    "fixed_stride_chunks": fixed_stride_chunks,
    "recursive_chunks": recursive_chunks,
    "recursive_chunk_flags": recursive_chunk_flags,
    "document_pages": document_pages,
    "chunk_page": chunk_page,
    "retrieved_chunks": retrieved_chunks,
    "answer_pages": answer_pages,
    "document_by_id": document_by_id,
}
