"""Removal of long repeated passages by longest-previous-factor arrays.

A passage repeats when a string of ``length`` bytes starts at more than one place. Places that can repeat are brought
together by anchors: of the short strings inside such a window the one with the smallest hash is its anchor, so equal
windows have equal anchors at equal offsets. Neighbouring windows with one anchor form a snippet of text.

1. Every task lists the anchors of its texts with a hash of their snippets, about one for each 130 bytes.
2. Anchors met once are done. Snippets that are equal as a whole enter once, in the place of the first of them.
3. Where an anchor has several different snippets their windows are put in suffix order. The previous and the next
   smaller position in that order give each window's longest earlier match, the mirrored ones its longest later match.
4. An anchor with very many different snippets, as around a short passage that everybody quotes, has its windows
   dealt out by 128-bit hashes instead, so that no task holds such a group.
5. Where passages count by words too, strings of so many words that are shorter than a window meet by 128-bit hashes;
   longer ones consist of windows.

Texts are read by the tasks that hold them; only anchors, and the bytes of differing snippets, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import (BROADCAST_LIMIT, bounded_broadcast, documents_of, identified, prefix_hash, slices,
                                 span_hash, text_bytes, word_edges)
from tidemill.session import written

LENGTH = 400  # bytes of a repeated string
ANCHOR = 64  # bytes of the strings whose hashes are compared
CROWD = 16_384  # different snippets of an anchor that one task compares, some ten megabytes
BLOCK = 1 << 18  # window starts looked at at once, so that the arrays stay small
WINDOWS = 20_000  # windows sorted at once; more are sorted by their distance from the anchor, piece by piece
PLACE = np.uint64((1 << 22) - 1)


def anchored(raw: np.ndarray, offsets: np.ndarray, length: int, anchor: int
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """(text number, first window, last window, anchor, its hash, snippet hash), block by block; places in all bytes."""
    width = length - anchor + 1
    for start in range(0, len(raw), BLOCK):
        part = raw[start: start + BLOCK + length - 1]
        n = len(part) - anchor + 1
        if len(part) < length:
            break
        places = np.arange(n)
        hashes = span_hash(prefix_hash(part), places, places + anchor)
        best, reach = (hashes & ~PLACE) | places.astype(np.uint64), 1
        while reach * 2 <= width:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        if reach < width:
            best = np.minimum(best[: reach - width], best[width - reach:])
        at = (best & PLACE).astype(np.int64)
        window = np.arange(len(at))
        text = np.searchsorted(offsets, window + start, side="right") - 1
        inside = np.flatnonzero(window + start + length <= offsets[text + 1])
        if not len(inside):
            continue
        at, text = at[inside], text[inside]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        low, high = inside[first], inside[np.append(first[1:], len(at)) - 1]
        data = part.tobytes()
        whole = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(low.tolist(), (high + length).tolist(), strict=True)]
        yield text[first], low + start, high + start, at[first] + start, hashes[at[first]], whole


PLACES = "array<struct<doc_id: long, text_key: long, start: int, end: int, reach: int>>"
STRINGS = f"slice long, one long, two long, places {PLACES}"


def by_content(number: int, batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, end: np.ndarray, reach: np.ndarray,
               content: np.ndarray) -> pa.RecordBatch:
    """(slice, one, two, places): strings of a slice of a task's texts, equal ones together, the smallest place first.

    Strings are equal when both numbers of their ``content`` are.
    """
    doc_id, text_key = (batch.column(c).take(pa.array(row)) for c in ("doc_id", "text_key"))
    named = doc_id.fill_null(0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((start, text_key.to_numpy(), *named, content[:, 1], content[:, 0]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (content[order[1:]] != content[order[:-1]]).any(axis=1)
    first = np.flatnonzero(new)
    places = pa.StructArray.from_arrays([
        doc_id.take(pa.array(order)), text_key.take(pa.array(order)),
        *[pa.array(x[order].astype(np.int32)) for x in (start, end, reach)]], ["doc_id", "text_key", "start", "end", "reach"])
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(first), task << 32 | number)), *[pa.array(content[order[first], i].view(np.int64)) for i in (0, 1)],
        pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), places)], ["slice", "one", "two", "places"])


def met(strings: DataFrame) -> DataFrame:
    """(one, two, n, first): how often each string occurs, and its first place."""
    least = F.col("places")[0]
    place = F.struct(least["doc_id"].isNull().alias("unnamed"), *[least[c].alias(c) for c in ("doc_id", "text_key", "start", "end", "reach")])
    return strings.groupBy("one", "two").agg(F.sum(F.size("places")).alias("n"), F.min(place).alias("first"))


def anchors(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """``STRINGS`` whose contents are an anchor and its snippet: ranges of windows with one anchor.

    ``reach`` is the distance from the first window to the anchor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count()
        for batch in slices(batches, "text", 4 * BLOCK):
            raw, offsets = text_bytes(batch.column("text"))
            for text, low, high, at, hashes, whole in anchored(raw, offsets, length, anchor):
                content = np.stack([hashes, np.array(whole, dtype=np.uint64)], axis=1)
                yield by_content(next(numbers), batch, text, low - offsets[text], high + length - offsets[text], at - low, content)

    return texts.mapInArrow(run, STRINGS)


def snippets(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted snippets, cut out by the tasks that read the texts."""
    fields = ["anchor", "snippet", "low", "high", "reach", "crowded"]
    per_text = written(wanted.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct(*fields)).alias("cuts")), "cuts")
    entries = per_text.agg(F.sum(F.size("cuts"))).first()[0] or 0
    # An entry has some 40 bytes; beyond the limit texts and cuts are shuffled by text.
    held = F.broadcast(per_text) if entries <= 5 * BROADCAST_LIMIT else per_text
    held = held.withColumnsRenamed({"doc_id": "doc_id__", "text_key": "text_key__"})
    same = F.col("doc_id").eqNullSafe(F.col("doc_id__")) & (F.col("text_key") == F.col("text_key__"))
    joined = texts.join(held, same).select("doc_id", "text_key", "cuts", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK):
            lists = batch.column("cuts")
            counts = np.diff(lists.offsets.to_numpy())
            cuts = lists.flatten()
            raw, offsets = text_bytes(batch.column("text"))
            data = raw.tobytes()
            text = np.repeat(np.arange(batch.num_rows), counts)
            low, high = (cuts.field(f).to_numpy() for f in ("low", "high"))
            starts = (offsets[text] + low).tolist()
            ends = (offsets[text] + high + length).tolist()
            where = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(where), batch.column("text_key").take(where),
                *[cuts.field(f) for f in ("anchor", "low", "reach", "crowded")],
                pa.array([data[a:b] for a, b in zip(starts, ends, strict=True)], pa.binary()),
            ], ["doc_id", "text_key", "anchor", "low", "reach", "crowded", "bytes"])

    return joined.mapInArrow(
        run, "doc_id long, text_key long, anchor long, low int, reach int, crowded boolean, bytes binary")


def previous_smaller(places: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each rank the common prefix with the nearest earlier rank whose place is smaller, or 0.

    ``lcp[i]`` is the common prefix of ranks i - 1 and i. All ranks between a pointer and its owner have larger places,
    so a pointer that points to a larger place may take over that place's own pointer.
    """
    n = len(places)
    pointer = np.arange(-1, n - 1)
    shared = lcp.copy()
    held = np.append(places, -1)  # place -1 ends every search
    open_ = np.flatnonzero(held[pointer] > places)
    while len(open_):
        over = pointer[open_]
        shared[open_] = np.minimum(shared[open_], shared[over])
        pointer[open_] = pointer[over]
        open_ = open_[held[pointer[open_]] > places[open_]]
    return np.where(pointer >= 0, shared, 0)


def longest_previous(places: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """By rank, the longest match with any smaller place: the better of the previous and the next smaller one."""
    back = np.zeros_like(lcp)
    back[1:] = lcp[:0:-1]
    return np.maximum(previous_smaller(places, lcp), previous_smaller(places[::-1], back)[::-1])


def matched_windows(texts: list[bytes], reach: np.ndarray, length: int
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, window, matches an earlier one, matches a later one) over all windows of texts in order.

    Equal windows lie equally far from their anchors, so windows may be sorted distance by distance.
    """
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    counts = sizes - length + 1
    text = np.repeat(np.arange(len(texts)), counts)
    window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = (np.cumsum(sizes) - sizes)[text] + window
    views = np.lib.stride_tricks.sliding_window_view(raw, length)
    earlier, later = np.empty(len(text), dtype=bool), np.empty(len(text), dtype=bool)
    for piece in pieces_of(reach[text] - window):
        rows = views[place[piece]]
        order = np.argsort(rows.view(f"S{length}").ravel(), kind="stable")
        ranked = rows[order]
        differs = ranked[1:] != ranked[:-1]
        lcp = np.zeros(len(order), dtype=np.int64)
        lcp[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
        earlier[piece[order]] = longest_previous(order, lcp) >= length
        later[piece[order]] = longest_previous(len(order) - 1 - order, lcp) >= length
    return text, window, earlier, later


def pieces_of(distance: np.ndarray) -> Iterator[np.ndarray]:
    """Windows in pieces of about ``WINDOWS``, all of one distance together, in their order."""
    if len(distance) <= WINDOWS:
        yield np.arange(len(distance))
        return
    order = np.argsort(distance, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(distance[order])) + 1, len(order))
    start = 0
    while start < len(order):
        end = int(edges[max(np.searchsorted(edges, start + WINDOWS, side="right") - 1, np.searchsorted(edges, start, side="right"))])
        yield order[start:end]
        start = end


def window_runs(text: np.ndarray, window: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring flagged windows: (text number, first, last)."""
    at = np.flatnonzero(flags)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (text[at][1:] != text[at][:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return text[at[first]], window[at[first]], window[at[last]]


SPAN = "doc_id long, text_key long, start int, end int"


def compared(held: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans of the snippets whose windows match others with the same anchor."""
    def spans(rows: list[tuple]) -> pa.RecordBatch:
        reach = np.array([r[5] for r in rows], dtype=np.int64)
        text, window, earlier, later = matched_windows([r[4] for r in rows], reach, length)
        text, first, last = window_runs(text, window, earlier if keep == "first" else earlier | later)
        low = np.array([r[3] for r in rows], dtype=np.int64)[text]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][1] for i in text], pa.int64()), pa.array([rows[i][2] for i in text], pa.int64()),
            pa.array((low + first).astype(np.int32)), pa.array((low + last + length).astype(np.int32)),
        ], ["doc_id", "text_key", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        windows = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "text_key", "low", "bytes", "reach")]
            for row in zip(*columns, strict=True):
                if windows >= WINDOWS and row[0] != rows[-1][0]:
                    yield spans(rows)
                    rows, windows = [], 0
                rows.append(row)
                windows += len(row[4]) - length + 1
        if rows:
            yield spans(rows)

    # Bounded groups: at most CROWD snippets of less than two windows' length for each anchor.
    dealt = held.repartition("anchor").sortWithinPartitions("anchor", F.col("doc_id").asc_nulls_last(), "text_key", "low")
    return dealt.select("anchor", "doc_id", "text_key", "low", "bytes", "reach").mapInArrow(run, SPAN)


def halves(digests: list[bytes]) -> np.ndarray:
    """128-bit digests as pairs of numbers."""
    return np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)


def dealt_out(held: DataFrame, length: int, keep: str) -> DataFrame:
    """The same for snippets of crowded anchors: their windows meet by 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(slices(batches, "bytes", 1 << 16)):
            counts, digests = [], []
            for data in batch.column("bytes").to_pylist():
                counts.append(len(data) - length + 1)
                digests += [xxhash.xxh3_128_digest(data[i: i + length]) for i in range(counts[-1])]
            row = np.repeat(np.arange(batch.num_rows), counts)
            start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + batch.column("low").to_numpy()[row]
            yield by_content(number, batch, row, start, start + length, np.zeros(len(row)), halves(digests))

    windows = written(held.select("doc_id", "text_key", "low", "bytes").mapInArrow(run, STRINGS), "windows")
    return met_again(windows, met(windows), keep)


def met_again(strings: DataFrame, found: DataFrame, keep: str) -> DataFrame:
    """Spans of the written ``strings`` that occur more than once, given what ``met`` found of them.

    A string is one row for each slice of a task's texts, however often it occurs there. What is found comes back to its
    slice, whose size is bounded, and is one span wherever strings overlap.
    """
    several = found.filter("n > 1").select("one", "two", "first")
    per_slice = strings.join(several, ["one", "two"]).groupBy("slice").agg(F.collect_list(F.struct("first", "places")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                entries = batch.column("found").slice(i, 1).flatten()
                places = entries.field("places").flatten()
                if keep == "first":
                    of = entries.field("first").take(pc.list_parent_indices(entries.field("places")))
                    same = pc.and_(pc.equal(of.field("text_key"), places.field("text_key")), pc.equal(of.field("start"), places.field("start")))
                    known = pc.equal(pc.is_null(of.field("doc_id")), pc.is_null(places.field("doc_id")))
                    named = pc.equal(of.field("doc_id"), places.field("doc_id")).fill_null(True)
                    places = places.filter(pc.invert(pc.and_(same, pc.and_(known, named))))
                if len(places):
                    yield joined_spans(places)

    return per_slice.mapInArrow(run, SPAN)


def joined_spans(places: pa.StructArray) -> pa.RecordBatch:
    """Overlapping and touching windows of a text as one span."""
    doc_id, text_key = places.field("doc_id"), places.field("text_key").to_numpy()
    start, end = (places.field(c).to_numpy().astype(np.int64) for c in ("start", "end"))
    number, unnamed = doc_id.fill_null(0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((start, text_key, number, unnamed))
    other = np.zeros(len(order), dtype=bool)
    for x in (text_key, number, unnamed):
        other[1:] |= x[order[1:]] != x[order[:-1]]
    base = np.cumsum(other) << 32  # places of different texts lie apart
    begins = base + start[order]
    reach = np.maximum.accumulate(base + end[order])
    new = np.ones(len(order), dtype=bool)
    new[1:] = begins[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order)) - 1
    where = pa.array(order[first])
    return pa.RecordBatch.from_arrays([
        doc_id.take(where), places.field("text_key").take(where),
        *[pa.array((x - base[first]).astype(np.int32)) for x in (begins[first], reach[last])]], ["doc_id", "text_key", "start", "end"])


def short_runs(texts: DataFrame, length: int, words: int) -> DataFrame:
    """``STRINGS``: runs of so many whole words in fewer than ``length`` bytes, their contents 128-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(slices(batches, "text", BLOCK)):
            raw, offsets = text_bytes(batch.column("text"))
            starts, ends = word_edges(raw, offsets)
            starts, ends = starts[: max(0, len(starts) - words + 1)], ends[words - 1:]
            text = np.searchsorted(offsets, starts, side="right") - 1
            short = np.flatnonzero((ends - starts < length) & (ends <= offsets[text + 1]))
            if not len(short):
                continue
            starts, ends, text = starts[short], ends[short], text[short]
            data = raw.tobytes()
            digests = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield by_content(number, batch, text, starts - offsets[text], ends - offsets[text], np.zeros(len(text)), halves(digests))

    return texts.mapInArrow(run, STRINGS)


def repeated_spans(texts: DataFrame, length: int, keep: str, anchor: int = ANCHOR, crowd: int = CROWD,
                   words: int | None = None) -> DataFrame:
    """(doc_id, text_key, spans): the maximal byte spans of each text that repeated strings cover.

    Strings of ``length`` bytes count and, where ``words`` is given, strings of so many whole words of any length.
    """
    listed = written(anchors(texts, length, anchor), "anchors")
    different = written(met(listed), "snippets")
    per_anchor = different.groupBy("one").agg(F.sum("n").alias("total"), F.count("*").alias("n_different"))
    repeated = written(per_anchor.filter("total > 1"), "repeated")

    several = different.join(repeated.filter("n_different > 1"), "one")
    wanted = several.select("first.doc_id", "first.text_key", F.col("one").alias("anchor"), F.col("two").alias("snippet"),
                            F.col("first.start").alias("low"), (F.col("first.end") - length).alias("high"), "first.reach",
                            (F.col("n_different") > crowd).alias("crowded"))
    held = written(snippets(texts, wanted, length), "snippet-bytes")
    spans = compared(held.filter(~F.col("crowded")), length, keep)
    spans = spans.unionByName(dealt_out(held.filter("crowded"), length, keep))
    spans = spans.unionByName(met_again(listed, different, keep))
    if words:
        runs = written(short_runs(texts, length, words), "short-runs")
        spans = spans.unionByName(met_again(runs, met(runs), keep))
    return merged(spans)


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a text as one."""
    along = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    numbered = spans.distinct().withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("run", F.sum("new").over(along))
    runs = numbered.groupBy("doc_id", "text_key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return identified(docs, id_column, text_column).withColumn("text_key", F.xxhash64("text"))


def whole_characters(data: bytes, start: int, end: int) -> tuple[int, int]:
    """The part of a span that holds whole UTF-8 characters only."""
    while start < end and data[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for span in spans for x in span], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def deduplicate(docs: DataFrame, length: int = LENGTH, keep: str = "first", id_column: str = "doc_id",
                text_column: str = "text", anchor: int = ANCHOR, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, text_key, n_bytes, spans, kept (the bytes that remain), text (the same as text).

    Of a character that a span cuts in two, ``text`` holds all, ``kept`` the bytes outside the span.

    ``keep="first"`` removes what matches an earlier place in the order of doc_id (missing ones last), a hash of the
    text, and byte; ``keep="none"`` removes the first copy too. Matches are strings of ``length`` UTF-8 bytes, may
    overlap, and are judged on the texts as they came. A missing text counts as empty; texts shorter than ``length``
    stay whole. Rows repeated with one doc_id and text are all cut alike: they count as copies of each other with
    "none", and as one document with "first". Texts may be of any length. Other columns are left out, whatever their
    names. No rows give no rows. Spans are (start, end) in bytes.
    """
    if keep not in ("first", "none") or not 0 < anchor <= length:
        raise ValueError("keep must be 'first' or 'none', and anchors no longer than the strings")
    texts = keyed(docs, id_column, text_column)
    spans = bounded_broadcast(written(repeated_spans(texts, length, keep, anchor, crowd), "spans"))
    spans = spans.withColumnsRenamed({"doc_id": "doc_id__", "text_key": "text_key__"})
    same = F.col("doc_id").eqNullSafe(F.col("doc_id__")) & (F.col("text_key") == F.col("text_key__"))
    joined = texts.join(spans, same, "left").select("doc_id", "text_key", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BLOCK):
            found = [[(s["start"], s["end"]) for s in x or ()] for x in batch.column("spans").to_pylist()]
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            whole = [without(t, [whole_characters(t, a, b) for a, b in x]) for t, x in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(map(len, texts), pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in x] for x in found], SPANS),
                pa.array([without(t, x) for t, x in zip(texts, found, strict=True)], pa.binary()),
                pa.array(whole, pa.binary()).cast(pa.string()),
            ], ["doc_id", "text_key", "n_bytes", "spans", "kept", "text"])

    return joined.mapInArrow(
        run, "doc_id long, text_key long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary, text string")


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def cleaned_documents(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text",
                      size_column: str | None = "n_chars", words: int | None = None) -> DataFrame:
    """``docs`` with later copies of repeated passages cut out of the text, by whole characters.

    Passages have ``length`` bytes or, where ``words`` is given, so many words between ASCII white space.
    All rows and columns stay; ``size_column``, where there is one, is set to the new number of characters. A missing text
    stays missing. Missing doc_ids come last, equal ones follow a hash of their texts; repeated rows are cut alike, as one
    document. Texts may be of any length. No rows give no rows.
    """
    names = docs.columns
    marks = written(repeated_spans(keyed(docs, id_column, text_column), length, "first", words=words), "spans")
    marks = bounded_broadcast(marks).withColumnsRenamed({"doc_id": "doc_id__", "text_key": "key__", "spans": "spans__"})
    key = F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))
    same = F.col(f"`{id_column}`").cast("long").eqNullSafe(F.col("doc_id__")) & (key == F.col("key__"))
    joined = docs.join(marks, same, "left").select(*[docs[f"`{c}`"] for c in names], "spans__")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column, BLOCK):
            texts = batch.column(names.index(text_column)).to_pylist()
            cut = []
            for text, spans in zip(texts, batch.column(len(names)).to_pylist(), strict=True):
                if spans:
                    data = text.encode()
                    text = without(data, [whole_characters(data, s["start"], s["end"]) for s in spans]).decode()
                cut.append(text)
            columns = [batch.column(i) for i in range(len(names))]
            columns[names.index(text_column)] = pa.array(cut, columns[names.index(text_column)].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    found = joined.mapInArrow(run, docs.schema)
    if size_column in names:
        found = found.withColumn(size_column, F.length(F.col(f"`{text_column}`")).cast(docs.schema[size_column].dataType))
    return found


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = deduplicate(documents_of(spark, folder), LENGTH, "none")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"), "text")


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLES: dict[str, str] = {}
