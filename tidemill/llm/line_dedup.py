"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, the rarest first; two sets as similar as asked share a word
among the first few of each, large ones several, so only those prefixes are joined. What remains after the length filter,
the positional filter (the first common words leave room for enough others), a comparison of parity maps and a count of
the common words of both prefixes is verified on the words themselves. A parity map flips one of its bits for every word, so two maps differ in no more bits than the sets in words.

Equal sets enter the join once, and those that share a word meet by size. The sets of a word that heads the prefixes of
very many are cut into blocks, and the pairs of blocks are cells of their own, so no task holds all pairs of such a word.
Every pair that passes the filters is verified, in cells that hold the words of a line once for many pairs: a line goes
for any earlier match, and the links of each class of equal sets are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import (ARROW_ROWS, BROADCAST_LIMIT, bounded_broadcast, documents_of, identified, mixed,
                                 slices, text_bytes, word_spans)
from tidemill.operators.windows import ordered_index
from tidemill.session import written

SHARE = (4, 5)  # least Jaccard similarity, as a fraction
RARITY_BITS = 18  # words are counted by so many bits of their hashes
COUNTS = 1 << 10  # of them are a row of what a task has counted
CROWD_BITS = 20  # words of prefixes are counted by so many of theirs
CROWD = 2048  # sets that share one word of their prefixes
MORE = 32  # words of a set for each further word that its prefix shares with a similar one's
NUMBERS = 10_000  # rows of an Arrow batch of numbers, which are short
ROWS = 1 << 16  # prefix rows looked at once
PAIRS = 1 << 20  # pairs of them
LINES = 512  # lines of a block whose words are compared
STEP = 2 << 20
BLOCK = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


PARTS = "part int, counts binary"


def parts_of(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task has counted, ``COUNTS`` numbers a row."""
    parts = counts.reshape(-1, COUNTS)
    at = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([parts[i].tobytes() for i in at], pa.binary())], ["part", "counts"])


def added_up(parts: DataFrame, bits: int) -> np.ndarray:
    """The sums of all tasks' counts, of which there are 2^bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                         ["part", "counts"])

    counts = np.zeros(1 << bits, dtype=np.int64).reshape(-1, COUNTS)
    for r in parts.repartition("part").mapInArrow(run, PARTS).collect():
        counts[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return counts.ravel()


def rarity_ranks(texts: DataFrame) -> np.ndarray:
    """For each hash prefix its rank by how often its words occur in all texts.

    The collected counts are bounded by ``RARITY_BITS``. Any order of words gives the same result; a good one makes the
    prefixes selective.
    """
    rest = np.uint64(64 - RARITY_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for batch in slices(batches, "text", STEP):
            raw, offsets = text_bytes(batch.column("text"))
            hashes = [h for _, _, _, h in word_spans(LOWER[raw], offsets, BLOCK)]
            if hashes:
                counts += np.bincount((np.concatenate(hashes) >> rest).astype(np.int64), minlength=len(counts))
        yield from parts_of(counts)

    counts = added_up(texts.select("text").mapInArrow(run, PARTS), RARITY_BITS)
    ranks = np.empty(len(counts), dtype=np.uint64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)
    return ranks


def prefix_sizes(n: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """How many of a set's rarest words every similar set shares one of; or several, one more for each ``MORE`` words."""
    return n - -(-n * share[0] // share[1]) + 1 + n // MORE


def line_sets(raw: np.ndarray, offsets: np.ndarray, ranks: np.ndarray, share: tuple[int, int]) -> dict:
    """Arrays with one value per line that has words: its text, number, set size, set hashes, word map and prefix."""
    low = LOWER[raw]
    parts = list(word_spans(low, offsets, BLOCK))
    if not parts:
        return {}
    text, start, _, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, start)  # line breaks before the word, over all texts
    # The rank takes the place of the hash bits it was looked up by: other numbers, in the order of rarity.
    rest = np.uint64(64 - RARITY_BITS)
    word = ranks[(hashes >> rest).astype(np.int64)] << rest | hashes & ((np.uint64(1) << rest) - np.uint64(1))
    where = line + text  # different for lines of different texts, ascending
    # The line and the leading bits of the word in one number; where words differ in later bits only, both are sorted.
    bits = int(where[-1]).bit_length()
    key = where.astype(np.uint64) << np.uint64(64 - bits) | word >> np.uint64(bits) if bits else word
    order = np.argsort(key)
    if np.any((key[order[1:]] == key[order[:-1]]) & (word[order[1:]] != word[order[:-1]])):
        order = np.lexsort((word, where))
    word, where, text, line = word[order], where[order], text[order], line[order]
    new = np.ones(len(word), dtype=bool)
    new[1:] = (word[1:] != word[:-1]) | (where[1:] != where[:-1])
    word, where, text, line = word[new], where[new], text[new], line[new]
    first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else np.zeros(0, np.int64)
    if not len(first):
        return {}
    n = np.diff(np.append(first, len(word)))
    size = prefix_sizes(n, share)
    ends = np.cumsum(size)
    taken = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
    spread = mixed(word)
    one = np.uint64(1) << (spread & np.uint64(63))
    return {
        "text": text[first], "line": line[first] - np.searchsorted(breaks, offsets[text[first]]), "n": n,
        "set": np.add.reduceat(spread, first).view(np.int64),
        "bits": np.bitwise_xor.reduceat(one, first).view(np.int64),
        "prefix": pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()),
                                           pa.array((word[taken] >> np.uint64(28)).astype(np.uint32).view(np.int32)
                                                    ^ word[taken].astype(np.uint32).view(np.int32))),
    }


LINE = "doc_id long, text_key long, line int, n int, set long, bits long, prefix array<int>"


def lines_of(texts: DataFrame, share: tuple[int, int]) -> DataFrame:
    """One row per line with words, and one with the line number -1 and the number of lines for each text."""
    # 2^18 numbers, whatever the size of the collection.
    shared = texts.sparkSession.sparkContext.broadcast(rarity_ranks(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "line", "n", "set", "bits", "prefix"]
        for batch in slices(batches, "text", STEP):
            raw, offsets = text_bytes(batch.column("text"))
            breaks = np.concatenate([[0], np.cumsum(raw == 10)])
            counts = breaks[offsets[1:]] - breaks[offsets[:-1]] + 1
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(np.full(batch.num_rows, -1, np.int32)),
                pa.array(counts.astype(np.int32)), none, none, pa.nulls(batch.num_rows, pa.list_(pa.int32())),
            ], names)
            found = line_sets(raw, offsets, shared.value, share)
            if found:
                where = pa.array(found["text"])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(where), batch.column("text_key").take(where),
                    pa.array(found["line"].astype(np.int32)), pa.array(found["n"].astype(np.int32)),
                    *[pa.array(found[c]) for c in ("set", "bits")], found["prefix"],
                ], names)

    return texts.mapInArrow(run, LINE)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is run inside."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def prefixes(sets: DataFrame) -> DataFrame:
    """(id, bits, word, ni): the words that lead each set; set size and place share one number."""
    place = sets.select("id", "bits", "n", F.posexplode("prefix").alias("place", "word"))
    return place.select("id", "bits", "word", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("place")).alias("ni"))


def place_of() -> Column:
    """Where a line stands, in the order of lines."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "line")


def line_contents(texts: DataFrame, placed: DataFrame) -> DataFrame:
    """(cell, side, id, first, content): the place and the text of the line that stands for a set, once for each of its
    cells; ``side`` tells the lines of the second block."""
    cut = F.struct("line", "id", "block", "others")
    per_text = written(placed.groupBy("doc_id", "text_key").agg(F.collect_list(cut).alias("cuts")), "cuts")
    entries = per_text.agg(F.sum(F.aggregate("cuts", F.lit(0), lambda n, c: n + 2 + F.size(c["others"])))).first()[0] or 0
    # An entry has some 16 bytes; beyond the limit texts and cuts are shuffled by text.
    held = F.broadcast(per_text) if entries <= 10 * BROADCAST_LIMIT else per_text
    held = held.withColumnsRenamed({"doc_id": "doc_id__", "text_key": "text_key__"})
    same = F.col("doc_id").eqNullSafe(F.col("doc_id__")) & (F.col("text_key") == F.col("text_key__"))
    lines = texts.join(held, same).select("doc_id", "text_key", "cuts", F.split("text", "\n").alias("lines"))
    each = lines.select("doc_id", "text_key", F.transform("cuts", lambda c: c.withField("content", F.element_at("lines", c["line"] + 1))).alias("cuts"))
    each = each.select("doc_id", "text_key", F.inline_outer("cuts"))
    dealt = each.select("id", place_of().alias("first"), "content", "block", F.explode_outer("others").alias("other"))
    cell = F.shiftleft(F.least("block", F.col("other").cast("long")), 32) + F.greatest("block", F.col("other").cast("long"))
    return dealt.select(cell.alias("cell"), (F.col("block") > F.col("other")).alias("side"), "id", "first", "content")


def verified(lines: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(id, links, goes): by the pairs in the cells whose words are as similar as asked, how many a line has and whether one
    is with an earlier line.

    A cell holds lines of two blocks, and every line of one meets every line of the other
    in the task; a cell of one block has the pairs of its lines. A pair is in one cell, and no row is written for it.
    """
    held = lines.select("cell", "side", "id", "first.*", "content")

    def similar(table: pa.Table) -> pa.RecordBatch:
        id_, later, bits, sizes = cell_words(table)
        cell, side = (table.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "side"))
        at = np.arange(len(cell))
        edge = np.concatenate([[True], cell[1:] != cell[:-1]])
        ends = np.append(np.flatnonzero(edge)[1:], len(cell))[np.cumsum(edge) - 1]
        # The lines of the first block come first and meet those of the second, or those that follow where it is the same.
        begins = np.where((cell >> 32) == (cell & 0xFFFFFFFF), at + 1, ends - np.bincount(np.cumsum(edge) - 1, side).astype(np.int64)[np.cumsum(edge) - 1])
        counts = np.where(side, 0, ends - begins)
        n, goes = np.zeros(len(cell), dtype=np.int64), np.zeros(len(cell), dtype=bool)
        for x, y in followers(begins, counts, max(1, (1 << 20) // bits.shape[1])):
            enough = np.minimum(sizes[x], sizes[y]) * share[1] >= np.maximum(sizes[x], sizes[y]) * share[0]
            x, y = x[enough], y[enough]
            common = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64)
            kept = common * share[1] >= (sizes[x] + sizes[y] - common) * share[0]
            x, y = x[kept], y[kept]
            n += np.bincount(np.concatenate([x, y]), minlength=len(n))
            goes[np.where(later[x] > later[y], x, y)] = True
        at = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(id_[at]), pa.array(n[at]), pa.array(goes[at])], ["id", "links", "goes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "cell", LINES):
            yield similar(table)

    return held.repartition("cell").sortWithinPartitions("cell", "side", "id").mapInArrow(
        run, "id long, links long, goes boolean").groupBy("id").agg(F.sum("links").alias("links"), F.max("goes").alias("goes"))


def followers(begins: np.ndarray, counts: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers: each row with so many rows from its begin on; whole rows, about ``step`` pairs at once."""
    ends = np.cumsum(counts)
    low = 0
    while low < len(counts):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + step, side="right")))
        left = np.repeat(np.arange(low, high), counts[low:high])
        yield left, begins[left] + np.arange(len(left)) - np.repeat(ends[low:high] - counts[low:high] - done, counts[low:high])
        low = high


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of some ``rows`` rows with all rows of their keys, from batches in the order of the key."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held)
            value = table.column(key).to_numpy()
            # The last key may go on in the next batch.
            other = np.flatnonzero(value != value[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield table.slice(0, cut).combine_chunks()
                held = table.slice(cut).combine_chunks().to_batches()
                n -= cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def cell_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines: ids, ranks by place, the words that several lines have as bits, and numbers of words."""
    id_, named = table.column("id").to_numpy(), table.column("unnamed").to_numpy()
    doc_id = pc.fill_null(table.column("doc_id"), 0).to_numpy()
    later = np.empty(len(id_), dtype=np.int64)
    later[np.lexsort((id_, table.column("line").to_numpy(), table.column("text_key").to_numpy(), doc_id, named))] = np.arange(len(id_))
    # The kernels for ASCII change A-Z alone, split at the six characters of white space and leave other bytes as they are.
    # Lower-cased first: Arrow 23 takes wrong bytes for a slice that was cast before.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(table.column("content")).cast(pa.large_string())).combine_chunks()
    line, words = np.repeat(np.arange(len(id_)), pc.list_value_length(lists).to_numpy()), lists.flatten()
    full = pc.binary_length(words).to_numpy() > 0
    each = np.unique(line[full] << 32 | words.dictionary_encode().indices.to_numpy()[full])  # a word of a line once
    line, coded = each >> 32, each & 0xFFFFFFFF
    sizes = np.bincount(line, minlength=len(id_))
    several = np.bincount(coded, minlength=1) > 1
    place = np.cumsum(several) - 1
    used = several[coded]
    line, word = line[used], place[coded[used]]
    bits = np.zeros((len(id_), -(-max(1, int(several.sum())) // 64)), dtype=np.uint64)
    np.bitwise_or.at(bits, (line, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
    return id_, later, bits, sizes


def by_size(table: pa.Table) -> dict[str, np.ndarray]:
    """The columns of whole cells, each cell by ascending size, and ``group``, which ascends from cell to cell."""
    columns = {c: table.column(c).to_numpy() for c in table.column_names}
    key = columns["key"]
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) << 32
    order = np.argsort(group | columns["ni"] >> 32)
    return {c: x[order] for c, x in columns.items()} | {"group": group}  # groups stay where they are


def close_pairs(rows: dict[str, np.ndarray], share: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of each cell that may be similar, up to some ``PAIRS`` compared at once.

    Where ``own`` is not -1 a cell has the pairs of sets that differ in it.

    Similar sets of sizes m and n with o common words have the first k of them, of any k up to o, among their first
    m - o + k and n - o + k words.
    """
    own, id_, bits, group = (rows[c] for c in ("own", "id", "bits", "group"))
    size, place = rows["ni"] >> 32, rows["ni"] & 0xFFFFFFFF
    # Sizes ascend within a cell: each row meets those that follow, as far as they are not too large for it.
    after = np.arange(len(size)) + 1
    counts = np.searchsorted(group | size, group | size * share[1] // share[0], side="right") - after
    for left, right in followers(after, counts, PAIRS):
        total = size[left] + size[right]
        least = -(-total * share[0] // (share[0] + share[1]))
        further = size[left] // MORE  # sizes ascend, so of the smaller set
        near = (place[left] <= size[left] - least + further) & (place[right] <= size[right] - least + further)
        x, y, most = left[near], right[near], (total - 2 * least)[near]
        close = np.bitwise_count(bits[x].view(np.uint64) ^ bits[y].view(np.uint64)) <= most
        # A set that meets itself is no pair.
        close &= ((own[x] == -1) | (own[x] != own[y])) & (id_[x] != id_[y])
        yield x[close], y[close]


ROW = ["key", "own", "id", "bits", "ni"]


def dealt_by_key(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(*ROW, *more).repartition("key").sortWithinPartitions("key")


def pairs_of_words(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of sets that may be similar; the rows of a word's cell have one ``key`` and are few.

    A pair that meets at less words than the smaller set's size asks for is none. The pairs of a large group are very
    many: ``links`` does its work without this table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "key", ROWS):
            found = by_size(table)
            id_, size = found["id"], found["ni"] >> 32
            for x, y in close_pairs(found, share):
                a, b, needed = id_[x], id_[y], size[x] // MORE + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(needed)], ["a", "b", "needed"])

    shared = dealt_by_key(rows).mapInArrow(run, "a long, b long, needed long").groupBy("a", "b").agg(
        F.count("*").alias("n"), F.max("needed").alias("needed"))
    return shared.filter("n >= needed").select("a", "b")


def needed_words(size: Column, share: tuple[int, int]) -> Column:
    """At how many words a set meets each similar one at least; that one has ``share`` of its size or more."""
    least = F.ceil(size * share[0] / share[1])
    return F.floor(least / MORE) + 1


def rows_that_meet(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The rows of words' cells that may be similar to another of their cell, with ``near``, the least set among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "key", ROWS):
            found = by_size(table)
            id_ = found["id"]
            near = id_.copy()
            met = np.zeros(len(id_), dtype=bool)
            for x, y in close_pairs(found, share):
                met[x] = met[y] = True
                np.minimum.at(near, x, id_[y])
                np.minimum.at(near, y, id_[x])
            at = np.flatnonzero(met)
            ni = found["ni"][at]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x[at]) for x in (*(found[c] for c in ("key", "own", "id", "bits")), near)],
                 pa.array((ni >> 32).astype(np.int32)), pa.array((ni & 0xFFFFFFFF).astype(np.int32))],
                ["key", "own", "id", "bits", "near", "n", "place"])

    return dealt_by_key(rows).mapInArrow(run, "key long, own int, id long, bits long, near long, n int, place int")


def cells_of(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(id, block, others): each set's block and those with which it has a cell, its own among them where that has pairs.

    A row of a word's cell says in which blocks there are sets that may be similar to it. A set goes where it has met
    others at as many words as it needs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "key", ROWS):
            found = by_size(table)
            block = found["block"]
            for x, y in close_pairs(found, share):
                code = np.unique(np.concatenate([x << 32 | block[y], y << 32 | block[x]]))
                row, other = code >> 32, code & 0xFFFFFFFF
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(other.astype(np.int32)))
                row = row[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found["id"][row]), pa.array(block[row] << 32 | found["ni"][row] >> 32), lists], ["id", "block_n", "others"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, "id", ROWS):
            id_, both = (table.column(c).to_numpy() for c in ("id", "block_n"))
            block, n = both >> 32, both & 0xFFFFFFFF
            first = np.flatnonzero(np.concatenate([[True], id_[1:] != id_[:-1]]))
            lists = table.column("others").combine_chunks()
            which = np.repeat(np.repeat(np.arange(len(first)), np.diff(np.append(first, len(id_)))), pc.list_value_length(lists).to_numpy())
            code, words = np.unique(which << 32 | lists.flatten().to_numpy(), return_counts=True)
            row, other = first[code >> 32], code & 0xFFFFFFFF
            kept = words >= -(-n[row] * share[0] // share[1]) // MORE + 1
            row, other = row[kept], other[kept]
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(other.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(id_[row[first]]), pa.array(block[row[first]]), lists], ["id", "block", "others"])

    met = dealt_by_key(rows, "block").mapInArrow(run, "id long, block_n long, others array<int>")
    return met.repartition("id").sortWithinPartitions("id").mapInArrow(counted, "id long, block long, others array<int>")


def settled(rows: DataFrame, texts: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(id, links, goes, set, first) by the rows of words' cells.

    Sets are put in the order of the least set they may resemble, which brings groups together, and cut into blocks.
    """
    with batch_rows(texts.sparkSession, NUMBERS):
        met = written(rows_that_meet(rows, share), "met")
    each = met.groupBy("id").agg(F.min("near").alias("near"), F.count("*").alias("words"), *[F.first(c).alias(c) for c in ("n", "bits")])
    near = written(each.filter(F.col("words") >= needed_words(F.col("n"), share)).drop("words"), "near")
    order = ordered_index(near, F.col("near"), F.col("id")).select("id", "n", "bits", F.floor(F.col("index") / LINES).alias("block"))
    blocks = written(order, "blocks")
    rows = met.select("id", "key", "own", "place").join(blocks, "id").withColumn("ni", F.shiftleft(F.col("n").cast("long"), 32) + F.col("place"))
    with batch_rows(texts.sparkSession, NUMBERS):
        wanted = written(cells_of(rows, share), "cells")
    places = sets.select("id", "set", "first.doc_id", "first.text_key", "first.line")
    placed = written(places.join(wanted, "id"), "placed")
    found = verified(line_contents(texts, placed), share)
    return found.join(placed.select("id", "set", place_of().alias("first")), "id")


def frequent_words(sets: DataFrame, crowd: int) -> DataFrame:
    """(word): the words of prefixes, as often as they occur, but for most that occur ``crowd`` times at most.

    Words are counted by ``CROWD_BITS`` bits first; a word cannot occur more often than all words with its bits.
    """
    bits = (1 << CROWD_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CROWD_BITS, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("prefix").flatten().to_numpy() & bits, minlength=len(counts))
        yield from parts_of(counts)

    prefix = sets.select("prefix")
    with batch_rows(sets.sparkSession, NUMBERS):
        many = added_up(prefix.mapInArrow(run, PARTS), CROWD_BITS) > crowd
    if not many.any():
        return prefix.select(F.explode("prefix").alias("word")).limit(0)
    shared = sets.sparkSession.sparkContext.broadcast(many)  # 2^20 bytes

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column("prefix").flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(word[shared.value[word & bits]])], ["word"])

    return prefix.mapInArrow(listed, "word int")


def links(texts: DataFrame, sets: DataFrame, share: tuple[int, int], crowd: int) -> DataFrame:
    """(id, links, goes): for the sets that are similar to others, to how many, and whether to an earlier one.

    ``texts`` has each doc_id and text_key once.
    """
    rows = prefixes(sets)
    counts = frequent_words(sets, crowd).groupBy("word").count()
    crowded = written(counts.filter(F.col("count") > crowd), "crowded")
    if crowded.isEmpty():
        usual = rows.select(F.col("word").cast("long").alias("key"), F.lit(-1).alias("own"), "id", "bits", "ni")
        return settled(usual, texts, sets, share)
    # Words in more than ``crowd`` prefixes: at most one for every ``crowd`` rows.
    listed = bounded_broadcast(crowded)
    usual = rows.join(listed, "word", "left_anti").select(F.col("word").cast("long").alias("key"), F.lit(-1).alias("own"), "id", "bits", "ni")
    # The root of the size in blocks: each row is in as many cells, of its block alone or of two, and cells grow with the root.
    blocks = F.ceil(F.sqrt(F.col("count") / crowd)).cast("int")
    dealt = rows.join(listed, "word").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    each = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    busy = each.select(F.xxhash64("word", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
                       F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("own"), "id", "bits", "ni")
    return settled(usual.unionByName(busy), texts, sets, share)


def deduplicate(docs: DataFrame, share: tuple[int, int] = SHARE, id_column: str = "doc_id", text_column: str = "text",
                crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, text_key, n_lines, n_removed, removed_lines (numbers from 0), line_classes.

    ``line_classes`` has (line, class, links) for every line that equals or resembles another: the class is the 64-bit
    hash of its set of words, the same for equal sets in all documents, and links counts the other classes with a
    similarity of at least ``share``, earlier or later. A line that is not listed is alone in its class, without links.

    A line is removed when an earlier line, of any document in the order of doc_id (missing ones last) and a hash of the
    text, has a set of words with a Jaccard similarity of at least ``share``; earlier lines count whether they go
    themselves or not. Words stand between ASCII white space, A-Z lower-cased; lines end at line feeds. Lines without
    words stay. A missing text counts as empty and has one line. Rows repeated with one doc_id and text are one document
    and cut alike. Words are told apart by 64-bit hashes in the search, and by themselves before a line goes for a
    similar one; words, lines and texts may be of any length. Other columns are left out, whatever their names. No rows
    give no rows.
    """
    texts = identified(docs, id_column, text_column).withColumn("text_key", F.xxhash64("text"))
    lines = written(lines_of(texts, share), "lines")
    worded = lines.filter("line >= 0")
    place = place_of()
    sets = written(worded.groupBy("set").agg(
        F.min(place).alias("first"), F.count("*").alias("copies"),
        *[F.first(c).alias(c) for c in ("n", "bits", "prefix")],
    ).withColumn("id", F.monotonically_increasing_id()), "sets")
    repeated = lines.filter("line < 0").groupBy("doc_id", "text_key").count().filter("count > 1")
    once = texts if repeated.isEmpty() else texts.dropDuplicates(["doc_id", "text_key"])
    linked = written(links(once, sets, share, crowd).select("id", "set", "first", "links", "goes"), "linked")
    copied = sets.filter("copies > 1").join(linked, "id", "left_anti").select("set", "first")
    marks = linked.drop("id").unionByName(copied, allowMissingColumns=True)
    marked = worded.select("doc_id", "text_key", "line", "set").join(marks, "set")
    goes = F.coalesce("goes", F.lit(False)) | (place != F.col("first"))
    entry = F.struct("line", F.col("set").alias("class"), F.coalesce("links", F.lit(0).cast("long")).alias("links"), goes.alias("goes"))
    found = marked.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(entry)).alias("found"))
    found = found.withColumnsRenamed({"doc_id": "doc_id__", "text_key": "text_key__"})
    same = F.col("doc_id").eqNullSafe(F.col("doc_id__")) & (F.col("text_key") == F.col("text_key__"))
    per_text = lines.filter("line < 0").select("doc_id", "text_key", F.col("n").cast("long").alias("n_lines"))
    joined = per_text.join(found, same, "left").select(
        "doc_id", "text_key", "n_lines",
        F.coalesce("found", F.array().cast("array<struct<line:int,class:bigint,links:bigint,goes:boolean>>")).alias("found"))
    removed = F.transform(F.filter("found", lambda x: x["goes"]), lambda x: x["line"])
    classes = F.transform("found", lambda x: F.struct(x["line"].alias("line"), x["class"].alias("class"), x["links"].alias("links")))
    return joined.select("doc_id", "text_key", "n_lines", F.size(removed).cast("long").alias("n_removed"),
                         removed.alias("removed_lines"), classes.alias("line_classes"))


def cleaned(docs: DataFrame, decided: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the removed lines; all rows and other columns stay."""
    marks = decided.filter("n_removed > 0").dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("doc_id__"), F.col("text_key").alias("key__"), F.col("removed_lines").alias("removed__"))
    key = F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("doc_id__")) & (key == F.col("key__"))
    kept = F.filter(F.split(F.col(f"`{text_column}`"), "\n"), lambda _, i: ~F.array_contains("removed__", i))
    text = F.when(F.col("removed__").isNull(), F.col(f"`{text_column}`")).otherwise(F.array_join(kept, "\n"))
    return docs.join(bounded_broadcast(marks), same, "left").withColumn(text_column, text).drop("doc_id__", "key__", "removed__")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(documents_of(spark, folder)).drop("text_key")


QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES: dict[str, str] = {}
