"""Spelling variants grouped under their commonest neighbour.

Words are near when one inserted, deleted or replaced letter apart. For every word the deletions of one letter and the
replacements of one letter by a later one are generated as hashes, which covers each near pair from one of its ends. The
hashes are looked up in blocked Bloom filters over the vocabulary, one for each length of word. Only hits become
strings, are shuffled and meet the vocabulary in an exact join, which removes false positives.

All filters together take at most ``FILTER_BITS`` bits, however large the vocabulary: what is sent to all tasks is
bounded. Beyond that more hits are false, and the join still decides. Letters are those of Latin-1, so a word is as many
bytes, and no letter is left out of the alphabet tried.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BASE, INVERSE, documents_of, identified, mixed
from tidemill.session import written

LEAST_LETTERS, LEAST_COUNT = 5, 3
TYPO_EVERY = 97
RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lower-cased
BREAK = re.compile("[^a-zÀ-ÿ]")
READ = 1 << 20  # letters of a text cut into runs at once, to the end of the last run
HELD_WORDS = 200_000  # different words a task adds up before it hands them on
BITS_PER_WORD = 24
FILTER_BITS = 1 << 28
LANES = 8  # a block has eight numbers of 32 bits, and a word sets one bit in each
BLOCK_BITS = 32 * LANES
EDITS_AT_ONCE = 1 << 18

# Odd factors that choose the bit of a word in each lane.
LANE_FACTORS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31],
                        dtype=np.uint32)


def runs(text: str, read: int) -> Iterator[list[str]]:
    """Maximal runs of letters, A-Z lower-cased, from blocks that end where a run does."""
    low = text.encode().lower().decode()  # bytes are lower-cased in ASCII alone
    start = 0
    while start < len(low):
        stop = BREAK.search(low, start + read)
        end = stop.start() if stop else len(low)
        yield RUN.findall(low, start, end)
        start = max(end, start + 1)


def with_typo(run: str, prefix: bytes, every: int) -> str:
    """The run, in one of ``every`` cases without the letter that the document and the run name."""
    h = zlib.crc32(prefix + run.encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
                typo_every: int = TYPO_EVERY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): the words of at least so many letters that occur at least so often in all whole texts.

    Added up in each task first, so a word that is a third of all occurrences costs no more than any other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                prefix = f"{'' if doc_id is None else doc_id}:".encode()
                for part in runs(text.as_py(), READ):
                    for word, n in Counter(part).items():
                        word = with_typo(word, prefix, typo_every)
                        if len(word) >= least_letters:
                            held[word] += n
                    if len(held) > HELD_WORDS:
                        yield listed(held)
                        held.clear()
        if held:
            yield listed(held)

    def listed(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    found = identified(docs, id_column, text_column).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def powers(start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers start, start + 1, …, and the same of its inverse."""
    steps = np.empty((2, n), dtype=np.uint64)
    steps[0, 1:], steps[1, 1:] = BASE, INVERSE
    steps[:, :1] = np.array([[pow(int(BASE), start, 1 << 64)], [pow(int(INVERSE), start, 1 << 64)]], dtype=np.uint64)
    return tuple(np.multiply.accumulate(steps, axis=1))


def letters_of(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)


def sums_of(letters: np.ndarray) -> np.ndarray:
    """Hashes of words of one length before mixing: each letter times the power of its place."""
    total = np.zeros(len(letters), dtype=np.uint64)
    for start in range(0, letters.shape[1], EDITS_AT_ONCE):
        part = letters[:, start: start + EDITS_AT_ONCE]
        total += (part * powers(start, part.shape[1])[0]).sum(axis=1, dtype=np.uint64)
    return total


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Words of one length with their counts, of together at most ``EDITS_AT_ONCE`` letters, one word at least."""
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        counts = batch.column("n").to_numpy()
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            step = max(1, EDITS_AT_ONCE // max(size, 1))
            for i in range(0, len(at), step):
                some = at[i: i + step]
                yield size, [words[j] for j in some], counts[some]


def bits_of(h: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((h.astype(np.uint32) * LANE_FACTORS[lane]) >> np.uint32(27))


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def filter_sizes(vocabulary: DataFrame, bits: int) -> dict[int, int]:
    """Blocks of the filter for each length of word; together at most ``bits`` bits, but for one block each.

    Lengths beyond the thousand commonest share the filter with the number -1, so there are few filters.
    """
    lengths = vocabulary.groupBy(F.length("word").alias("size")).count().orderBy(F.desc("count"), "size").limit(1000).collect()
    known = {r["size"]: r["count"] for r in lengths}
    total = vocabulary.count()
    known[-1] = total - sum(known.values())
    share = min(1.0, bits / max(1, BITS_PER_WORD * total))
    return {size: max(1, int(n * BITS_PER_WORD * share) // BLOCK_BITS) for size, n in known.items()}


def filters(vocabulary: DataFrame, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """The filter of each length: blocks of ``LANES`` numbers, bits of all words joined by "or" in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, words, _ in by_length(batches):
            number = size if size in sizes else -1
            h = mixed(sums_of(letters_of(words)))
            lanes = np.stack([bits_of(h, i) for i in range(LANES)], axis=1).astype("<u4").view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(h), number), pa.int32()), pa.array(block_of(h, sizes[number])),
                *[pa.array(lanes[:, i]) for i in range(LANES // 2)]], ["size", "block", *COLUMNS])

    schema = "size int, block long, " + ", ".join(f"{c} long" for c in COLUMNS)
    blocks = vocabulary.mapInArrow(run, schema).groupBy("size", "block").agg(*[F.bit_or(c).alias(c) for c in COLUMNS])
    found = blocks.toArrow()  # at most FILTER_BITS in all
    made = {size: np.zeros((n, LANES // 2), dtype=np.int64) for size, n in sizes.items()}
    owner, block = (found.column(c).to_numpy() for c in ("size", "block"))
    values = np.stack([found.column(c).to_numpy() for c in COLUMNS], axis=1)
    for size, table in made.items():
        mine = owner == size
        table[block[mine]] = values[mine]
    return {size: table.view("<u4") for size, table in made.items()}


COLUMNS = [f"lanes{i}" for i in range(LANES // 2)]


def hits(made: dict[int, np.ndarray], size: int, sums: np.ndarray, tried: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where ``tried`` holds and the hash of a word of this size may be in the vocabulary."""
    table = made.get(size, made[-1])
    at = np.nonzero(tried)
    h = mixed(sums[at])
    block, stays = block_of(h, len(table)), np.arange(len(h))
    for lane in range(LANES):
        bits = bits_of(h[stays], lane)
        stays = stays[(table[block[stays], lane] & bits) == bits]
    return tuple(x[stays] for x in at)


def edited(made: dict[int, np.ndarray], alphabet: np.ndarray, words: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(number of the word, edit) for each deletion and each replacement by a later letter that may be a word."""
    letters = letters_of(words)
    n, size = letters.shape
    whole, before = sums_of(letters)[:, None], np.zeros((n, 1), dtype=np.uint64)
    for start in range(0, size, EDITS_AT_ONCE):
        part = letters[:, start: start + EDITS_AT_ONCE]
        power, _ = powers(start, part.shape[1])
        until = before + np.cumsum(part * power, axis=1, dtype=np.uint64)
        without = until - part * power + (whole - until) * INVERSE
        other = np.ones(part.shape, dtype=bool)  # of equal letters in a row, the last is deleted
        last = letters[:, start + 1: start + part.shape[1] + 1]
        other[:, : last.shape[1]] = part[:, : last.shape[1]] != last
        for i, j in zip(*hits(made, size - 1, without, other), strict=True):
            yield int(i), words[i][: start + j] + words[i][start + j + 1:]
        for letter in alphabet:
            larger = part < letter
            replaced = whole + (letter - part).astype(np.uint64) * power
            for i, j in zip(*hits(made, size, replaced, larger), strict=True):
                yield int(i), words[i][: start + j] + bytes([letter]) + words[i][start + j + 1:]
        before = until[:, -1:]


def near_pairs(vocabulary: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(word, n, other, other_n): every near pair of words, once. ``vocabulary`` is a written table (word, n)."""
    context = vocabulary.sparkSession.sparkContext
    made = filters(vocabulary, filter_sizes(vocabulary, bits))
    used = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect()
    alphabet = np.array(sorted(ord(r.letter) for r in used if r.letter), dtype=np.uint8)  # letters of Latin-1
    shared = context.broadcast((made, alphabet))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, tried = shared.value
        for _, words, counts in by_length(batches):
            number, edits, length = [], [], 0
            for i, edit in edited(found, tried, words):
                number.append(i)
                edits.append(edit.decode("latin-1"))
                length += len(edit)
                if length > 16 * EDITS_AT_ONCE:
                    yield positives(words, counts, number, edits)
                    number, edits, length = [], [], 0
            yield positives(words, counts, number, edits)

    def positives(words: list[bytes], counts: np.ndarray, number: list[int], edits: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([words[i].decode("latin-1") for i in number], pa.string()),
            pa.array(counts[number] if number else [], pa.int64()), pa.array(edits, pa.string())], ["word", "n", "other"])

    cores = context.defaultParallelism
    positive = vocabulary.repartition(4 * cores, "word").mapInArrow(run, "word string, n long, other string")
    return positive.join(vocabulary.withColumnsRenamed({"word": "other", "n": "other_n"}), "other")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms (word, form).

    Every round follows chains twice as far. A form occurs at least twice as often as its word, so chains have at most
    63 steps and there are at most seven rounds.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "chains")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = written(state.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "chains")
        state = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return state


def variants(vocabulary: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of ``vocabulary``, a written table (word, n) of different words.

    The form is the near word with the largest n, of equal ones the first in the order of code points, if that n is at
    least twice the word's; otherwise it is missing. The root is where following forms ends, the word itself without
    one. Words consist of code points up to U+00FF. No words give no rows.
    """
    pairs = written(near_pairs(vocabulary, bits), "near-words")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("n"))
    common = -F.col("best.less") >= 2 * F.col("n")
    near = written(near.select("word", "n_near", F.when(common, F.col("best.other")).alias("form"),
                               F.when(common, -F.col("best.less")).alias("form_n")), "near")
    ends = roots(near.filter("form IS NOT NULL"))
    return vocabulary.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def group_spellings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """``variants`` over the words of whole texts: runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z lower-cased.

    One run in ``TYPO_EVERY`` of a document, chosen by the CRC-32 of ``<doc_id>:<run>``, loses the letter this number
    names; a missing doc_id is written as nothing there. Words have at least ``LEAST_LETTERS`` letters and
    ``LEAST_COUNT`` occurrences. A missing text has no words. Repeated rows count each for itself. Texts and runs may be
    of any length. Other columns are left out, whatever their names. No rows give no rows.
    """
    counted = word_counts(docs, id_column=id_column, text_column=text_column)
    return variants(written(counted, "vocabulary"), bits)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return group_spellings(documents_of(spark, folder))


QUERIES = {"op12_spelling_variants": op12_spelling_variants}
ORACLES: dict[str, str] = {}
