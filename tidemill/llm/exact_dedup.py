"""Exact deduplication with a stateful stream.

Every document's digest goes through a Structured Streaming aggregation whose state lies on disk and never expires.
Per digest it retains the smallest identifier, the place of that document's content and the number of copies. Where
a digest was seen more than once the full normalised bytes are compared, so a collision never removes a document.

Only DataFrame operations are used. What is gathered per digest is one row per task, so a text that makes up a third
of the collection costs no more than any other; the copies' rows meet their class in a join that Spark splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import bounded_broadcast, documents_of, identified, kept_rows
from tidemill.session import scratch_path, written

STATE = "spark.sql.streaming.stateStore"
SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.allowFAllocate": "false",  # no disk is set aside ahead of use, for each of many small stores
    # All stores of an executor share one bounded cache, and none sets a large write buffer aside.
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "128",
    f"{STATE}.rocksdb.writeBufferSizeMB": "4",
    f"{STATE}.unloadOnCommit": "true",  # a store leaves the executor's memory with the micro-batch that used it
}
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, WHITE_SPACE, " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def add_to_state(spark: SparkSession, seen: str, state: str, files_per_batch: int | None = None) -> None:
    """Feeds the digest files in the folder ``seen`` that the state has not met yet, then stops.

    Smallest identifiers and counts do not depend on the order or the cutting of the micro-batches. Called again with
    the same folders it goes on where it stopped.
    """
    stream = spark.readStream.schema(spark.read.parquet(seen).schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    held = stream.parquet(seen).groupBy("digest").agg(F.min("entry").alias("first"), F.count("*").alias("n"))
    query = (
        held.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Keeps stream state in RocksDB for as long as the block runs."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def held_classes(spark: SparkSession, state: str) -> DataFrame:
    """The state as a table: digest, first entry, number of copies."""
    return spark.read.format("statestore").load(state).select(
        F.col("key.digest").alias("digest"), F.col("value.min").alias("first"), F.col("value.count").alias("n")
    )


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, if there is one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest=sha256_digest,
                files_per_batch: int | None = None, state: str | None = None, call: int | None = None,
                read: Callable[..., DataFrame] | None = None) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept, kept_at.

    Texts are equal when identical after ``normalised``; a missing text counts as empty, so all empty texts are one
    group. Of equal texts the smallest doc_id stays; missing doc_ids come last. Of repeated rows with the same doc_id
    and text one row is kept, whichever the scan meets first. ``kept_at`` names the file and place of the kept row.
    Texts may be of any length. An empty table gives an empty result. ``digest`` maps a text column to a binary column;
    documents whose digests collide are told apart by their bytes.

    ``state`` is a folder in which digests, stream state and colliding texts stay from call to call. A document that
    equals one of an earlier call goes, whatever its doc_id, and group_size counts over all calls. Its bytes are compared
    with the earlier text, which ``read``, parquet files by default, loads from the files the state names; so documents of
    calls with a state come from files that stay. A call that failed can be repeated with its number, from 0.
    """
    spark = docs.sparkSession
    folder = state or scratch_path(spark, "digest-state")
    seen = f"{folder}/digests"
    before = stored(spark, seen) if state else None
    number = call
    if number is None:
        number = 0 if before is None else before.agg(F.max("entry.call")).first()[0] + 1
    named = identified(docs, id_column, text_column).select("doc_id", normalised(F.col("text")).alias("text"))
    entry = F.struct(F.lit(number).cast("long").alias("call"), F.col("doc_id").isNull().alias("unnamed"), "doc_id",
                     F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("place"))
    if before is None or before.filter(F.col("entry.call") == number).isEmpty():
        named.select(digest(F.col("text")).alias("digest"), entry.alias("entry")).write.mode("append").parquet(seen)
    rows = spark.read.parquet(seen).filter(F.col("entry.call") == number)

    with state_on_disk(spark):
        add_to_state(spark, seen, f"{folder}/state", files_per_batch)
        several = held_classes(spark, f"{folder}/state").filter(F.col("n") > 1)
        several = written(several.join(rows, "digest", "left_semi") if before is not None else several, "digest-classes")

    # Full bytes on every hit: equal texts are added up in each task before one copy of each is shuffled.
    hits = bounded_broadcast(several.select("digest"))
    texts = named.withColumn("digest", digest(F.col("text"))).join(hits, "digest", "left_semi").select("digest", "text")
    earlier = None
    if number:
        earlier = earlier_texts(several.filter(F.col("first.call") < number), id_column, text_column, digest, read)
    met = texts if earlier is None else texts.unionByName(earlier.select("digest", "text"))
    compared = met.groupBy("digest", "text").agg(F.count("*").alias("n")).groupBy("digest").count()
    collided = compared.filter(F.col("count") > 1).select("digest")
    known = stored(spark, f"{folder}/classes") if number else None
    known = None if known is None else known.filter(F.col("call") < number).drop("call")
    if known is not None:
        collided = collided.unionByName(known.select("digest").join(several, "digest", "left_semi")).distinct()
    collided = written(collided, "collided")

    single = rows.join(collided, "digest", "left_anti").select("digest", "entry")
    placed = single.join(several, "digest", "left").select(
        F.col("entry.doc_id").alias("doc_id"), "digest",
        F.coalesce("first", "entry").alias("first"), F.coalesce("n", F.lit(1)).alias("group_size"), "entry",
    )
    if not collided.isEmpty():
        apart = written(named.withColumns({"digest": digest(F.col("text")), "entry": entry}).join(
            collided, "digest", "left_semi"), "collided-texts")
        now = apart.groupBy("digest", "text").agg(F.min("entry").alias("first"), F.count("*").alias("n"))
        if earlier is not None:
            now = now.unionByName(first_collisions(earlier, several, apart, known))
        now = now.join(collided, "digest", "left_semi")
        now.write.mode("overwrite").parquet(f"{folder}/classes/call={number}")
        now = spark.read.schema(now.schema).parquet(f"{folder}/classes/call={number}")
        classes = (now if known is None else now.unionByName(known)).groupBy("digest", "text").agg(
            F.min("first").alias("first"), F.sum("n").alias("group_size"))
        placed = placed.unionByName(apart.join(classes, ["digest", "text"]).select(
            F.col("entry.doc_id").alias("doc_id"), "digest", "first", "group_size", "entry"))
    return placed.select(
        "doc_id", "digest", F.col("first.doc_id").alias("keep_id"), F.col("group_size").cast("long"),
        ((F.col("entry.call") == F.col("first.call")) & (F.col("entry.place") == F.col("first.place"))).alias("kept"),
        F.struct("first.file", "first.place").alias("kept_at"),
    )


def earlier_texts(classes: DataFrame, id_column: str, text_column: str, digest, read) -> DataFrame | None:
    """(digest, text), written: the first text of each class that an earlier call met, from the file the state names."""
    files = [r.file for r in classes.select("first.file").distinct().collect()]  # at most as many as there are files
    if not files:
        return None
    if "" in files:
        raise ValueError("documents of an earlier call did not come from files, so their bytes cannot be compared")
    docs = (read or classes.sparkSession.read.parquet)(*map(unquote, files))
    wanted = classes.select(F.col("digest").alias("digest__"), F.col("first.doc_id").alias("doc_id__"))
    named = identified(docs, id_column, text_column).select("doc_id", normalised(F.col("text")).alias("text"))
    same = (F.col("digest") == F.col("digest__")) & F.col("doc_id").eqNullSafe(F.col("doc_id__"))
    found = named.withColumn("digest", digest(F.col("text"))).join(wanted, same, "left_semi")
    return written(found.select("digest", "text").distinct(), "earlier-texts")


def first_collisions(earlier: DataFrame, several: DataFrame, apart: DataFrame, known: DataFrame | None) -> DataFrame:
    """(digest, text, first, n): the classes of earlier calls whose digest had not collided until now."""
    now = apart.groupBy("digest").agg(F.count("*").alias("now"))
    held = earlier.join(several, "digest").join(now, "digest").select("digest", "text", "first", (F.col("n") - F.col("now")).alias("n"))
    return held if known is None else held.join(known, "digest", "left_anti")


def kept_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Missing texts and doc_ids, ties, repeated rows, long texts and empty tables are treated as by ``deduplicate``.
    """
    decided = written(deduplicate(docs, id_column, text_column).withColumnRenamed("digest", "content_key"), "dedup")
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return kept_rows(docs, decided, sha256_digest(normalised(text)), id_column)


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = deduplicate(documents_of(spark, folder))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op2_exact_dedup": op2_exact_dedup}
ORACLES = {"op2_exact_dedup": r"""
    WITH texts AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, text_sha256
    FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""}
