"""Alignment of the tokens of a byte-level BPE and of a SentencePiece vocabulary.

Both sides of a text are lists of ids over the same bytes. The lists of a batch are flattened with the numbers of their
texts, a cumulative sum that starts anew with every text gives the byte at which each token ends, and a full outer hash
join on (text, end) puts both sides on one ladder of ends. Every rung is a link: one occurrence of a token of each side,
the next to end on its side, whose bytes overlap. Where both sides end, a group is cut.

How many documents hold a pair of ids linked is counted per task with ``Table.group_by`` and added up by Spark. The
counts are looked up part by part, each part small enough to be sent to all tasks; pairs of a single document are not
listed, because a link without a listed count has the count one. Whatever the number of parts, every link is looked up.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, identified, slices, text_bytes
from tidemill.session import written

VOCABULARIES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
SLICE = 1 << 18  # bytes of text aligned at once; a longer text is a slice of its own
LINKS_AT_ONCE = 1 << 18
HELD_PAIRS = 1 << 20  # pairs a task adds up before it hands them on
PART = 1 << 21  # counted pairs sent to all tasks at once, 16 bytes each
SHIFT = 40  # a text's number stands above so many bits for a byte in it

# How words are cut before merges.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Bytes a byte-level vocabulary writes as themselves; the others are written from U+0100 on, in order.
WRITTEN_AS_IS = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))
SEPARATORS = (",", "|", ";", "")


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file; its ids must follow the order of its merges."""
    with open(path, encoding="utf-8") as lines:
        model = json.load(lines)["model"]
    rest = [b for b in range(256) if b not in WRITTEN_AS_IS]
    byte_of = {chr(b): b for b in WRITTEN_AS_IS} | {chr(256 + i): b for i, b in enumerate(rest)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = model["vocab"]
    if any(ids[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError("ids must follow the order of the merges")
    ranked = sorted(ids, key=ids.get)[: 256 + len(merges)]
    return [bytes(byte_of[c] for c in token) for token in ranked]


def piece_bytes(processor: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes each piece stands for."""
    def of(piece: str) -> bytes:
        one = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode()

    return [of(processor.id_to_piece(i)) for i in range(processor.get_piece_size())]


class Side:
    """One tokenizer: how it encodes texts, and the bytes of its ids."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = pa.array(tokens, pa.large_binary())
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)

    def listed(self, texts: list[str], raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
        """The ids of every text, and which texts their bytes give back."""
        found = self.encode(texts)
        at = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *found]).astype(np.int32)
        joined, ends = text_bytes(self.tokens.take(pa.array(flat)))
        edges = ends[at]
        same = np.diff(edges) == np.diff(offsets)
        if len(joined) != len(raw) or not same.all() or not np.array_equal(joined, raw):
            for i in np.flatnonzero(same):
                same[i] = np.array_equal(joined[edges[i]: edges[i + 1]], raw[offsets[i]: offsets[i + 1]])
        return pa.LargeListArray.from_arrays(pa.array(at), pa.array(flat)), same


class ByteLevel(Side):
    """Text with a space before it; special tokens are plain text."""

    def __init__(self, tokens: list[bytes]):
        super().__init__(tokens)
        ranks = {token: i for i, token in enumerate(tokens)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]


class Pieces(Side):
    """Text, before which the model itself puts a space."""

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        super().__init__(piece_bytes(self.processor))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, dtype=np.int32) for x in self.processor.encode(texts, num_threads=1)]


def kept(ids: pa.LargeListArray, stays: np.ndarray) -> pa.LargeListArray:
    """The same lists, those of other texts emptied."""
    if stays.all():
        return ids
    parents = pc.list_parent_indices(ids).to_numpy()
    counts = np.where(stays, np.diff(ids.offsets.to_numpy()), 0)
    flat = ids.flatten().filter(pa.array(stays[parents]))
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), flat)


def ends_of(ids: pa.LargeListArray, sizes: np.ndarray, name: str) -> pa.Table:
    """(end, name): the text and byte at which each token ends, and the token's number."""
    flat, parents = ids.flatten(), pc.list_parent_indices(ids).to_numpy()
    total = np.concatenate([[0], pc.cumulative_sum(pa.array(sizes).take(flat)).to_numpy()])
    ends = total[1:] - total[ids.offsets.to_numpy()[:-1]][parents]
    return pa.table({"end": parents.astype(np.int64) << SHIFT | ends, name: np.arange(len(flat), dtype=np.int64)})


def ladder(a: pa.LargeListArray, b: pa.LargeListArray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> dict:
    """The links of all texts in order: number of the text, ids of both sides, and which sides end there (1, 2 or 3)."""
    one, two = ends_of(a, sizes_a, "a"), ends_of(b, sizes_b, "b")
    rungs = one.join(two, "end", join_type="full outer", use_threads=False).combine_chunks().sort_by("end")
    here = [rungs.column(c).combine_chunks() for c in ("a", "b")]
    # Both sides end where a text ends, so nothing is taken from the text after it.
    ids = [side.flatten().take(pc.fill_null_backward(at)).to_numpy() for side, at in zip((a, b), here, strict=True)]
    valid = [at.is_valid().to_numpy(zero_copy_only=False).astype(np.int8) for at in here]
    return {"text": rungs.column("end").to_numpy() >> SHIFT, "a": ids[0], "b": ids[1], "ends": valid[0] + 2 * valid[1]}


ALIGNED = "doc_id long, a array<int>, b array<int>, ends array<tinyint>"


def align(docs: DataFrame, byte_level: str, pieces: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, a, b, ends) per row: the links of its tokens in the order of the text.

    Link i holds the ids a[i] and b[i]; ends[i] says whose token ends there: 1 the first side's, 2 the second's, 3
    both, which closes a group. So the tokens of a side are its ids where it ends. ``byte_level`` and ``pieces`` are
    paths of a byte-level BPE file and a SentencePiece model on the driver; their tokens are sent to all tasks.

    A text that is missing or empty, or that either side does not give back byte for byte with a space before it, has no
    links. Repeated rows are aligned each for itself, rows without doc_id too; other columns are left out, whatever
    their names. A text is aligned whole, however long. No rows give no rows.
    """
    context = docs.sparkSession.sparkContext
    with open(pieces, "rb") as model:
        shared = context.broadcast((byte_level_tokens(byte_level), model.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = ByteLevel(shared.value[0]), Pieces(shared.value[1])
        for batch in slices(batches, "text", SLICE):
            column = batch.column("text")
            raw, offsets = text_bytes(pc.binary_join_element_wise("", column, " "))
            texts = column.to_pylist()
            (a, same_a), (b, same_b) = (side.listed(texts, raw, offsets) for side in (first, second))
            stays = same_a & same_b & (np.diff(offsets) > 1)
            found = ladder(kept(a, stays), kept(b, stays), first.sizes, second.sizes)
            at = pa.array(np.searchsorted(found["text"], np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(found[c])) for c in ("a", "b", "ends")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "a", "b", "ends"])

    return identified(docs, id_column, text_column).mapInArrow(run, ALIGNED)


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows with together some ``LINKS_AT_ONCE`` links, offsets of their lists, number of the row and pair of each link."""
    for batch in batches:
        whole = batch.column("a").offsets.to_numpy()
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(whole, whole[start] + LINKS_AT_ONCE, side="right")) - 1
            part = batch.slice(start, max(end, start + 1) - start)
            start += part.num_rows
            a, b = part.column("a"), part.column("b")
            offsets = a.offsets.to_numpy().astype(np.int64)
            pair = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()
            yield part, offsets - offsets[0], pc.list_parent_indices(a).to_numpy(), pair


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): the number of rows that hold a pair of ids linked; the first id stands above 32 bits for the second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        held = empty
        for _, _, rows, pairs in pieces_of(batches):
            once = pa.table({"row": rows, "pair": pairs}).group_by(["row", "pair"], use_threads=False).aggregate([])
            new = once.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
            both = pa.concat_tables([held, new])
            held = both.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
            if held.num_rows > HELD_PAIRS:
                yield from held.to_batches(max_chunksize=1 << 16)
                held = empty
        yield from held.to_batches(max_chunksize=1 << 16)

    return aligned.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def group_digests(a: np.ndarray, b: np.ndarray, ends: np.ndarray, offsets: np.ndarray, words: pa.Array) -> list[str]:
    """SHA-256 of each row's groups, written ``a1,a2|b1;a3|b2``; '' for a row without links.

    ``words`` holds every id with each of ``SEPARATORS`` behind it.
    """
    both = ends == 3
    last = np.zeros(len(ends) + 1, dtype=bool)
    last[offsets[1:]] = True  # the link after a row's last one
    group = np.cumsum(both) - both
    is_a, is_b = (ends & 1).astype(bool), (ends & 2).astype(bool)
    count_a, count_b = (np.bincount(group[x], minlength=int(both.sum())) for x in (is_a, is_b))
    until_a, until_b = np.cumsum(count_a), np.cumsum(count_b) - count_b
    word = np.empty(int(is_a.sum() + is_b.sum()), dtype=np.int64)
    word[np.arange(is_a.sum()) + until_b[group[is_a]]] = a[is_a].astype(np.int64) * 4 + both[is_a]
    kind = np.where(last[1:], 3, np.where(both, 2, 0))
    word[np.arange(is_b.sum()) + until_a[group[is_b]]] = b[is_b].astype(np.int64) * 4 + kind[is_b]
    tokens = np.concatenate([[0], np.cumsum(is_a.astype(np.int64) + is_b)])[offsets]
    raw, at = text_bytes(words.take(pa.array(word)))
    cuts = at[tokens]
    return [hashlib.sha256(raw[i:j]).hexdigest() if i < j else "" for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


SUMMARY = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def summaries(aligned: DataFrame, ids: tuple[int, int], part: int = PART) -> DataFrame:
    """One row per row of ``aligned``, a written table: tokens, groups, links, links by their corpus-wide counts, digest.

    ``n_best`` are the links whose pair is counted as often as any pair with its first id; ``count_sum`` adds the counts
    of all links; ``groups_sha256`` is '' for a row without links, which has zeros. ``ids`` are the sizes of both
    vocabularies; the highest count of each first id, as many numbers, and ``part`` pairs at a time are sent to all
    tasks. Rows are summed up each for itself, also repeated ones. No rows give no rows.
    """
    spark = aligned.sparkSession
    counts = written(pair_counts(aligned).filter("n > 1"), "pair-counts")
    top = counts.groupBy(F.shiftright("pair", 32).cast("int").alias("a")).agg(F.max("n").alias("n")).toPandas()
    highest = np.ones(ids[0], dtype=np.int64)
    highest[top["a"].to_numpy(dtype=np.int64)] = top["n"]
    parts = max(1, -(-counts.count() // part))
    rows = aligned.withColumn("row", F.monotonically_increasing_id())

    def scored(i: int) -> DataFrame:
        mine = counts.filter(F.pmod("pair", F.lit(parts)) == i).orderBy("pair").toArrow()
        shared = spark.sparkContext.broadcast((
            mine.column("pair").to_numpy(), np.append(mine.column("n").to_numpy(), 0), highest))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            listed, counted, best = shared.value
            words = pa.array([f"{x}{s}" for x in range(max(ids)) for s in SEPARATORS], pa.large_string())
            for batch, offsets, parents, pairs in pieces_of(batches):
                # Sorted, equal pairs are looked up once and near ones side by side.
                unique, back = np.unique(pairs, return_inverse=True)
                at = np.searchsorted(listed, unique)
                here = np.flatnonzero(at < len(listed))
                here = here[listed[at[here]] == unique[here]]
                n = np.ones(len(unique), dtype=np.int64)
                n[here] = counted[at[here]]
                mine = unique % parts == i
                is_best = (n == best[unique >> 32]) & mine
                sums = [np.concatenate([[0], np.cumsum(x[back])]) for x in (is_best, np.where(mine, n, 0))]
                ends = batch.column("ends").flatten().to_numpy()
                totals = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (ends & 1, ends >> 1 & 1, ends == 3)]
                size = [np.diff(x[offsets]) for x in totals]
                digests = [""] * batch.num_rows
                if not i:
                    a, b = (batch.column(c).flatten().to_numpy() for c in ("a", "b"))
                    digests = group_digests(a, b, ends, offsets, words)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("row"), *map(pa.array, size), pa.array(np.diff(offsets)),
                    *[pa.array(np.diff(x[offsets])) for x in sums], pa.array(digests, pa.string()),
                ], ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        return rows.mapInArrow(run, SUMMARY)

    if parts == 1:
        return scored(0).drop("row")
    every = reduce(DataFrame.unionByName, map(scored, range(parts)))
    return every.groupBy("doc_id", "row", "n_a", "n_b", "n_groups", "n_links").agg(
        *[F.sum(c).alias(c) for c in ("n_best", "count_sum")], F.max("groups_sha256").alias("groups_sha256")).drop("row")


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    byte_level, pieces = map(public_tokenizers.path, VOCABULARIES)
    aligned = written(align(documents_of(spark, folder), byte_level, pieces), "aligned")
    sizes = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    return summaries(aligned, (len(byte_level_tokens(byte_level)), sizes))


QUERIES = {"op13_token_alignment": op13_token_alignment}
ORACLES: dict[str, str] = {}
