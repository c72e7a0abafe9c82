"""Language of web pages by fusing evidence.

Four sources speak for a page's language: its visible text, the language its markup declares, the suffix of its address
and what is known of its host. Text likelihoods come from byte trigrams counted per language over all labelled
documents. How far declarations and suffixes can be trusted, and which languages a host carries, is learned from the
pages themselves: each page's text votes with its posterior, the votes are added up by grouped aggregation, and a host
leans on its domain, a domain on all pages, as far as its own votes are few. A page's own vote is taken out again
before it meets its host.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, slices, text_bytes
from tidemill.session import written

BUCKETS = 1 << 14  # of hashed trigrams, per language
WIDTH = 3
EFFECTIVE = 60.0  # trigrams of a page that count as independent; a longer text does not speak louder
SMOOTHING = 0.5
HOST_WEIGHT = 5.0  # votes the domain has in a host's prior, and all pages in a domain's
EVIDENCE_WEIGHT = 2.0  # votes spread evenly before declarations and suffixes are counted
BLOCK = 1 << 20

HIDDEN = re.compile(r"<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>", re.S | re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)"
DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b"


def visible(page: str) -> str:
    """Text between tags; scripts, styles and comments are left out, open ones up to the end of the page."""
    return html.unescape(HIDDEN.sub(" ", page))


def trigram_buckets(raw: np.ndarray) -> np.ndarray:
    if len(raw) < WIDTH:
        return np.zeros(0, dtype=np.int64)
    key = np.zeros(len(raw) - WIDTH + 1, dtype=np.uint32)
    for i in range(WIDTH):
        key = (key ^ raw[i: len(raw) - WIDTH + 1 + i]) * np.uint32(0x01000193)
    key ^= key >> np.uint32(15)
    return ((key * np.uint32(0x2C1B3C6D)) >> np.uint32(18)).astype(np.int64)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def primary(tag: Column) -> Column:
    """The primary subtag of a language tag, or null."""
    found = F.regexp_extract(F.lower(tag), r"^\s*([a-z]{2,3})(?:[-_].*)?\s*$", 1)
    return F.when(found != "", found)


def language_counts(docs: DataFrame, language: str, text: str) -> DataFrame:
    """(language, bucket, n): trigrams of all labelled texts; each task adds up before it sends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", BLOCK):
            raw, offsets = text_bytes(batch.column("text"))
            lower = LOWER[raw]
            for name, a, b in zip(batch.column("language").to_pylist(), offsets, offsets[1:], strict=False):
                total = counts.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                for start in range(a, b, BLOCK):
                    total += np.bincount(trigram_buckets(lower[start: min(b, start + BLOCK + WIDTH - 1)]), minlength=BUCKETS)
        for name, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                                             ["language", "bucket", "n"])

    rows = docs.select(primary(F.col(f"`{language}`")).alias("language"), F.col(f"`{text}`").alias("text"))
    counted = rows.dropna().mapInArrow(run, "language string, bucket long, n long")
    return counted.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def likelihoods(docs: DataFrame, language: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and the log-likelihood of every trigram bucket under each.

    The counts are collected: at most ``BUCKETS`` rows per language, however many documents there are.
    """
    counts = language_counts(docs, language, text).toPandas()
    names = sorted(counts["language"].unique())
    table = np.zeros((len(names), BUCKETS))
    table[[names.index(x) for x in counts["language"]], counts["bucket"].to_numpy(dtype=np.int64)] = counts["n"]
    table += SMOOTHING
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def page_rows(pages: DataFrame, table: np.ndarray, page_id: str, url: str, markup: str) -> DataFrame:
    """One row per page with its host, declared language and the text's log-likelihoods; the markup stays behind."""
    # Bounded by the number of languages times BUCKETS.
    shared = pages.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, "markup", 4 * BLOCK):
            rows = []
            for page in batch.column("markup"):
                raw = LOWER[np.frombuffer(visible(page.as_py()).encode(), dtype=np.uint8)]
                buckets = trigram_buckets(raw)
                n = len(buckets)
                total = table @ np.bincount(buckets, minlength=BUCKETS) if n else np.zeros(len(table))
                rows.append(total * (min(n, EFFECTIVE) / max(n, 1)))
            kept = [batch.column(c) for c in ("page_id", "host", "declared")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))],
                                             ["page_id", "host", "declared", "text_ll"])

    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), HOST, 1))
    source = F.coalesce(F.col(f"`{markup}`"), F.lit(""))
    wanted = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), host.alias("host"),
        F.lower(F.regexp_extract(source, DECLARED, 1)).alias("declared"), source.alias("markup"),
    )
    return wanted.mapInArrow(run, "page_id long, host string, declared string, text_ll array<double>")


def normal(logs: Column) -> Column:
    """Probabilities from logarithms."""
    top = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def votes(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """The posteriors of a key's pages, added up per language; partial sums are made in each task."""
    sums = rows.groupBy(key).agg(*[F.sum(F.col("vote")[i]).alias(f"v{i}") for i in range(n)])
    return sums.select(key, F.array(*[f"v{i}" for i in range(n)]).alias(name))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def evidence(rows: DataFrame, key: str, n: int, whole: Column) -> DataFrame:
    """log P(key | language) for every value of ``key``, smoothed evenly over the values met."""
    counted = votes(rows, key, n, "counts")
    values = counted.count() + 1
    logs = F.zip_with("counts", whole, lambda c, w: F.log((c + EVIDENCE_WEIGHT / values) / (w + EVIDENCE_WEIGHT)))
    return counted.select(key, logs.alias(f"{key}_ll"))


def smoothed(own: Column, vote: Column, above: Column) -> Column:
    """Shares of votes without the page's own one, leaning on the level above."""
    others = F.zip_with(own, vote, lambda c, v: F.greatest(c - v, F.lit(0.0)))
    size = total(others) + HOST_WEIGHT
    return F.zip_with(others, above, lambda c, p: (c + HOST_WEIGHT * p) / size)


def identify(pages: DataFrame, docs: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html",
             language: str = "lang", text: str = "text") -> DataFrame:
    """One row per page: page_id, host, declared, text_lang, lang, confidence, evidence.

    ``docs`` gives texts with known languages; rows without a text or a usable tag are passed over, and without any
    the languages are null. A page without visible text is decided by its other evidence, without any at all by what
    all pages are; ties go to the language first in the alphabet. Missing addresses have the empty host, missing
    declarations count as a declaration of their own. Repeated rows are each reported and each vote; no pages give no
    rows. Pages and texts may be of any length. Other columns are left out, whatever their names. ``evidence`` holds the logarithms of all four sources per language, in alphabetical order of the languages.
    """
    names, table = likelihoods(docs, language, text)
    if not names:
        names, table = [""], np.zeros((1, BUCKETS))
    n = len(names)
    rows = page_rows(pages, table, page_id, url, markup)
    rows = rows.withColumns({
        "domain": F.substring_index("host", ".", -2),
        "suffix": F.regexp_extract("host", r"\.([a-z][a-z0-9\-]*)$", 1),
        "vote": normal(F.col("text_ll")),
    })
    rows = written(rows, "pages")
    sums = rows.agg(*[F.coalesce(F.sum(F.col("vote")[i]), F.lit(0.0)) for i in range(n)]).first()
    whole = F.array(*[F.lit(float(x)) for x in sums])
    size = sum(sums) + n * SMOOTHING
    overall = F.array(*[F.lit((x + SMOOTHING) / size) for x in sums])
    known = rows
    for key in ("declared", "suffix"):
        known = known.join(written(evidence(rows, key, n, whole), key), key)
    for key in ("domain", "host"):
        known = known.join(written(votes(rows, key, n, f"{key}_votes"), key), key)
    domain = smoothed(F.col("domain_votes"), F.col("vote"), overall)
    known = known.withColumn("domain_prior", domain)
    host = smoothed(F.col("host_votes"), F.col("vote"), F.col("domain_prior"))
    known = known.withColumn("host_ll", F.transform(host, lambda p: F.log(p)))
    sources = ["text_ll", "declared_ll", "suffix_ll", "host_ll"]
    fused = F.col(sources[0])
    for source in sources[1:]:
        fused = F.zip_with(fused, F.col(source), lambda a, b: a + b)
    known = known.withColumn("posterior", normal(fused))
    listed = F.array(*[F.lit(x or None).cast("string") for x in names])

    def best(chances: str) -> Column:
        rounded = F.transform(chances, lambda x: F.round(x, 9))
        return listed[F.array_position(rounded, F.array_max(rounded)).cast("int") - 1]

    return known.select(
        "page_id", "host", F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
        best("vote").alias("text_lang"), best("posterior").alias("lang"),
        F.round(F.array_max("posterior"), 6).alias("confidence"),
        F.struct(*sources).alias("evidence"),
    )


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = identify(spark.read.parquet(f"{folder}/pages.parquet"), documents_of(spark, folder))
    return rows.drop("evidence")


QUERIES = {"op8_language_id": op8_language_id}
ORACLES: dict[str, str] = {}
