"""Byte-level BPE encoding and decoding.

Texts are cut into words before any merge, by rules usually written as a regular expression: contractions, runs of
letters, of digits and of other signs, each with one space before it, and white space. Here every code point gets a
class by table, and the rules are a small automaton over the classes. A code point is a function from states to states;
such functions compose associatively and there are few different ones, so all states of a block come from two sweeps
over many chunks side by side, and all cuts from one table look-up.

The slices between cuts go through a cache of merged words. Every token keeps its place in the text's bytes, which is
where decoding puts it back.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents_of, identified, slices, text_bytes

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 1 << 20
CHUNK = 1024
CACHED_WORDS = 400_000
NO_PAIR = 1 << 31
SHORT = 64  # bytes up to which a word is merged by plain search

# Code points with the Unicode property White_Space.
WHITE_SPACE = (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Classes of code points. Of a white-space run before other signs the last code point stands alone: a space leads the
# next word, anything else is a word of its own. An apostrophe may open a contraction of one or two letters.
LETTER, NUMBER, OTHER, SPACE, LEADING, ALONE, SHORT_FORM, LONG_FORM = range(8)
# What the word being read is made of, after a code point; OPEN: the next code point starts a word.
OPEN, LETTERS, NUMBERS, OTHERS, SPACES, LED, TWO_LEFT, ONE_LEFT = range(8)


def step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a word starts at this code point."""
    if kind == LETTER and state in (TWO_LEFT, ONE_LEFT):
        return (ONE_LEFT if state == TWO_LEFT else OPEN), False
    if kind in (SHORT_FORM, LONG_FORM) and state not in (OTHERS, LED):
        return (ONE_LEFT if kind == SHORT_FORM else TWO_LEFT), True
    if kind in (LEADING, ALONE):
        return (LED if kind == LEADING else OPEN), True
    run = {LETTER: LETTERS, NUMBER: NUMBERS, SPACE: SPACES}.get(kind, OTHERS)
    return run, state != run and not (state == LED and run != SPACES)


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tables: next state, word start, function of each class, composition of functions, value of functions.

    Classes from 8 on are those of a text's first code point, which forget the state before.
    """
    steps = [[step(s if kind < 8 else OPEN, kind % 8) for s in range(8)] for kind in range(16)]
    after = np.array([[x for x, _ in row] for row in steps], dtype=np.uint8)
    starts = np.array([[x for _, x in row] for row in steps])
    known = {tuple(range(8)): 0}
    found = [tuple(range(8))]
    generators = [tuple(int(x) for x in row) for row in after]
    for f in found:  # grows while it is read, until nothing new comes up
        for g in generators:
            both = tuple(g[x] for x in f)
            if both not in known:
                known[both] = len(found)
                found.append(both)
    compose = np.array([[known[tuple(g[x] for x in f)] for g in found] for f in found], dtype=np.int32)
    return after, starts, np.array([known[g] for g in generators], dtype=np.int32), compose, np.array(found, dtype=np.uint8)


@cache
def code_point_classes() -> np.ndarray:
    letters = {"L": LETTER, "N": NUMBER}
    table = np.array([letters.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    table[list(WHITE_SPACE)] = SPACE
    return table


def classes(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The class of every code point, with what follows it in the same text taken into account."""
    kinds = code_point_classes()[points]
    follows = np.ones(len(points), dtype=bool)  # whether the next code point belongs to the same text
    follows[firsts[1:] - 1] = follows[-1:] = False
    before_word = np.flatnonzero((kinds == SPACE) & follows)
    before_word = before_word[kinds[before_word + 1] != SPACE]
    kinds[before_word] = np.where(points[before_word] == 0x20, LEADING, ALONE)
    quotes = np.flatnonzero((points == ord("'")) & follows)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, dtype=points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        kinds[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT_FORM
        whole = follows[np.minimum(quotes + 1, len(points) - 1)]
        pair = np.zeros(len(quotes), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        kinds[quotes[pair & whole]] = LONG_FORM
    kinds[firsts] += 8
    return kinds


def word_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where words start; ``firsts`` are the places of the texts' first code points."""
    if not len(points):
        return np.zeros(0, dtype=np.int64)
    after, starts, function, compose, value = automaton()
    kinds = classes(points, firsts)
    chunks = -(-len(kinds) // CHUNK)
    grid = np.full(chunks * CHUNK, ALONE, dtype=np.uint8)
    grid[: len(kinds)] = kinds
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    total = np.zeros(chunks, dtype=np.int32)
    for row in grid:  # each chunk as one function, all chunks side by side
        total = compose[total, function[row]]
    reach = 1
    while reach < chunks:  # functions of all chunks up to each one, by doubling
        total[reach:] = compose[total[:-reach], total[reach:]]
        reach *= 2
    state = np.zeros(chunks, dtype=np.uint8)
    state[1:] = value[total[:-1], OPEN]
    marks = np.empty(grid.shape, dtype=bool)
    for i, row in enumerate(grid):
        marks[i] = starts[row, state]
        state = after[row, state]
    return np.flatnonzero(marks.T.reshape(-1)[: len(kinds)])


def blocks(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts bytes into blocks between texts, or within a long one before a space that certainly leads a word."""
    plain = np.zeros(256, dtype=bool)
    plain[0x21:0x7F] = True
    start = 0
    while start < len(raw):
        size, end = BLOCK, len(raw)
        while start + size < len(raw):
            inner = offsets[(offsets > start) & (offsets <= start + size)]
            if len(inner):
                end = int(inner[-1])
                break
            part = raw[start: start + size + 1]
            safe = np.flatnonzero((part[1:-1] == 0x20) & plain[part[:-2]] & plain[part[2:]])
            if len(safe):
                end = start + int(safe[-1]) + 1
                break
            size *= 2
        yield start, end
        start = end


class Encoder:
    """Merges words by rank and remembers what became of them."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.flat = array("i")
        self.ends = array("q", [0])

    def merged(self, word: bytes) -> list[int]:
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        if len(word) > SHORT:
            return self.merged_long(word)
        parts = [word[i: i + 1] for i in range(len(word))]
        pairs = [ranks.get(word[i: i + 2], NO_PAIR) for i in range(len(word) - 1)]
        while pairs and (best := min(pairs)) < NO_PAIR:
            at = pairs.index(best)
            whole = parts[at] + parts[at + 1]
            parts[at: at + 2] = [whole]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(whole + parts[at + 1], NO_PAIR)
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + whole, NO_PAIR)
        return [ranks[p] for p in parts]

    def merged_long(self, word: bytes) -> list[int]:
        """The same merges, lowest rank and leftmost first, with the pairs in a heap."""
        n, ranks = len(word), self.ranks
        parts: list[bytes | None] = [word[i: i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i: i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    pair = parts[left] + parts[after[left]]
                    if (r := ranks.get(pair)) is not None:
                        heapq.heappush(heap, (r, left, len(pair)))
        return [ranks[p] for p in parts if p is not None]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each word."""
        if len(self.places) > CACHED_WORDS:
            self.forget()
        for word in set(words).difference(self.places):
            self.places[word] = len(self.ends) - 1
            self.flat.extend(self.merged(word))
            self.ends.append(len(self.flat))
        place = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
        ends = np.array(self.ends)
        counts = ends[place + 1] - ends[place]
        shift = ends[place] - np.concatenate([[0], np.cumsum(counts)[:-1]])
        return np.array(self.flat)[np.repeat(shift, counts) + np.arange(counts.sum())], counts

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, the byte place of each token in its own text, and the ids' number per text."""
        ids, places = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        filled = offsets[:-1][np.diff(offsets) > 0]
        for start, end in blocks(raw, offsets):
            data = raw[start:end].tobytes()
            points = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
            sizes = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            at = np.concatenate([[0], np.cumsum(sizes)])
            firsts = np.searchsorted(at, filled[(filled >= start) & (filled < end)] - start)
            if not len(firsts) or firsts[0]:
                firsts = np.concatenate([[0], firsts])
            cuts = np.append(at[word_starts(points, firsts)], end - start).tolist()
            found, counts = self.words([data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
            ids.append(found)
            sizes = self.sizes[found]
            places.append(start + np.cumsum(sizes) - sizes)
        flat, place = np.concatenate(ids), np.concatenate(places)
        number = np.searchsorted(place, offsets)
        return flat, (place - np.repeat(offsets[:-1], np.diff(number))).astype(np.int32), number


def load_tokens(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which must be 0, 1, 2, …"""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, filter(bytes.strip, lines)))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be consecutive from 0")
    return [token for _, token in ranked]


ENCODERS: dict[str, Encoder] = {}


def encoder_of(key: str, shared) -> Encoder:
    """The encoder of this worker process, kept from task to task with the words it has met."""
    if key not in ENCODERS:
        ENCODERS[key] = Encoder(shared.value)
    return ENCODERS[key]


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, places) per row: the token ids of the text and the byte at which each token starts.

    ``vocabulary`` is the path of a rank file on the driver; its tokens, some tens of thousands, are sent to all tasks.
    An empty or missing text has no tokens. Repeated rows are encoded each for itself, rows without doc_id too; texts may
    be of any length; other columns are left out, whatever their names; no rows give no rows.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(load_tokens(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary, shared)
        for batch in slices(batches, "text", 4 * BLOCK):
            ids, places, number = encoder.encode(*text_bytes(batch.column("text")))
            ends = pa.array(number, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (ids, places)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "ids", "places"])

    return identified(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>, places array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes the ids stand for, each token put where its place says.

    A place that does not continue the tokens before it is an error: something between was lost.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(load_tokens(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        for batch in batches:
            texts = []
            for ids, places in zip(batch.column("ids"), batch.column("places"), strict=True):
                found, place = ids.values.to_numpy(), places.values.to_numpy()
                ends = np.cumsum(sizes[found])
                if len(found) and (place[0] or (ends[:-1] != place[1:]).any()):
                    raise ValueError("tokens are missing or out of place")
                texts.append(b"".join(map(tokens.__getitem__, found.tolist())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids", "places").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path(VOCABULARY)
    rows = decode(encode(documents_of(spark, folder), vocabulary), vocabulary)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op9_byte_bpe": op9_byte_bpe}
ORACLES: dict[str, str] = {}
