"""Word and shingle hashes of whole Arrow batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * K2
    h = (h ^ (h >> np.uint64(27))) * K3
    return h ^ (h >> np.uint64(31))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def text_bytes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, A-Z lowered on wish, and the offsets of the texts; nulls are empty."""
    wide = texts.cast(pa.large_binary())
    if wide.null_count:
        wide = wide.fill_null(b"")
    bounds = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if not len(wide) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    data = np.frombuffer(wide.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return (lower_table()[data] if lower else data), bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and text number of each word, a run without white space of ASCII."""
    blank = np.zeros(256, bool)
    blank[list(SPACES)] = True
    blank = blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= blank[:-1]
    after[:-1] |= blank[1:]
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, taken in steps of eight bytes over all words that are long enough."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    h = left.astype(np.uint64) * K1
    active, at = np.arange(len(starts)), starts.copy()
    while len(active):
        got = eight[at]
        short = np.minimum(left[active], 8).astype(np.uint64)
        got = got & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * short))
        h[active] = mix((h[active] ^ got) * K1 + K2)
        left[active] -= 8
        longer = left[active] > 0
        active, at = active[longer], at[longer] + 8
    return h


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, non-negative and below 2^63.

    A text with fewer than ``width`` words, but one at least, has its whole word sequence as only shingle.
    """
    data, bounds = text_bytes(texts)
    starts, ends, owner = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    rolled = words.copy()
    for k in range(1, min(width, len(words))):
        rolled[:-k] = mix(rolled[:-k] * K1 + words[k:])
    rolled >>= np.uint64(1)
    sets = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]).view(np.int64))
        elif b > a:
            h = np.uint64(b - a) * K2
            for word in words[a:b]:
                h = mix(np.array([h * K1 + word]))[0]
            sets.append(np.array([h >> np.uint64(1)]).view(np.int64))
        else:
            sets.append(np.zeros(0, np.int64))
    return sets
