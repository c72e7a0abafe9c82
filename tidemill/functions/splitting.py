"""Places where texts are cut into overlapping chunks, as arrays; a helper of the chunking operator.

The places of every separator are found once for a whole text. A stretch is cut at the coarsest separator it holds; what
is still too long is cut at finer ones. Short pieces are packed: where a chunk ends and where the next one starts are
two searches in the sorted places, so the work grows with the chunks, not with the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Split points from coarse to fine, chunk size and overlap in characters.
SEPARATORS = ("\n\n", "\n", ".", " ", "")
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def places_of(points: np.ndarray, separator: str) -> np.ndarray:
    """All places where the separator starts."""
    found = np.flatnonzero(points[: max(0, len(points) - len(separator) + 1)] == ord(separator[0]))
    for i, sign in enumerate(separator[1:], 1):
        found = found[points[found + i] == ord(sign)]
    return found


def apart(places: np.ndarray, width: int) -> np.ndarray:
    """Of places that overlap, those a search from the left meets, each after the end of the one before."""
    if width == 1 or not len(places):
        return places
    kept, i = [], 0
    while i < len(places):
        kept.append(places[i])
        i = int(np.searchsorted(places, places[i] + width))
    return np.array(kept)


def packed(edges: np.ndarray, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Neighbouring pieces, each shorter than ``size``, as chunks that repeat up to ``overlap`` of the one before."""
    first = 0
    while True:
        last = int(np.searchsorted(edges, edges[first] + size, side="right")) - 1
        yield int(edges[first]), int(edges[last])
        if last == len(edges) - 1:
            return
        back = np.searchsorted(edges, (edges[last] - overlap, edges[last + 1] - size))
        first = min(max(first, int(back.max())), last)


def strides(low: int, high: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Fixed windows over a stretch that offers no better split point."""
    for start in range(low, max(high - overlap, low + 1), size - overlap):
        yield start, min(start + size, high)


def chunk_spans(places: Sequence[np.ndarray | None], widths: Sequence[int], low: int, high: int, level: int, size: int,
                overlap: int) -> Iterator[tuple[int, int]]:
    """Chunks of a stretch, cut at separators from ``level`` on; the empty separator has no places."""
    for at in range(level, len(places)):
        if places[at] is None:
            yield from strides(low, high, size, overlap)
            return
        inside = places[at][np.searchsorted(places[at], low): np.searchsorted(places[at], high - widths[at] + 1)]
        if not len(inside):
            continue
        inside = apart(inside, widths[at])
        edges = np.concatenate([[low], inside[inside > low], [high]])
        long = np.flatnonzero(np.diff(edges) >= size)
        start = 0
        for piece in [*long.tolist(), len(edges) - 1]:
            if piece > start:
                yield from packed(edges[start: piece + 1], size, overlap)
            if piece < len(edges) - 1:
                yield from chunk_spans(places, widths, int(edges[piece]), int(edges[piece + 1]), at + 1, size, overlap)
            start = piece + 1
        return
    yield low, high


def chunks_of(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
              separators: Sequence[str] = SEPARATORS) -> list[dict]:
    """``[{start, text}]`` of one text, outer blanks stripped and empty chunks left out."""
    if not text:
        return []
    points = code_points(text)
    places = [places_of(points, s) if s else None for s in separators]
    found = []
    for low, high in chunk_spans(places, [len(s) for s in separators], 0, len(text), 0, size, overlap):
        part = text[low:high]
        kept = part.strip()
        if kept:
            found.append({"start": low + len(part) - len(part.lstrip()), "text": kept})
    return found
