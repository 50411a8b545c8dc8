"""Word hashes of whole Arrow batches by array steps, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
BATCH_BYTES = 4 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_bytes = np.arange(256)
#: Bytes between words: ASCII white space; or all of ASCII but lower-case letters and digits.
SPACE = (_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13))
SIGNS = (_bytes < 128) & ~((_bytes >= 48) & (_bytes <= 57)) & ~((_bytes >= 97) & (_bytes <= 122))
_draw = np.random.default_rng(20)
BYTE = _draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i mod 2 ** 64 for i < n."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, BLOCK), base, dtype=np.uint64)
        steps[0] = 1
        held = _powers[base] = np.multiply.accumulate(steps)
    return held[:n]


def stir(x: np.ndarray) -> np.ndarray:
    """A mixing bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every lower-cased word, and the n + 1 offsets of each text's words.

    A block ends at a text's end or behind a gap; only a word longer than a block makes a longer one.
    """
    out, at, found = [], [], 0
    i, n, size = 0, len(data), BLOCK
    while i < n:
        j = min(i + size, n)
        if j < n:
            gap = np.flatnonzero(gaps[LOWER[data[i:j]]])
            text = int(offsets[np.searchsorted(offsets, j, "right") - 1])
            cut = max(i + int(gap[-1]) + 1 if len(gap) else i, text)
            if cut == i:
                size *= 2
                continue
            j = cut
        b = LOWER[data[i:j]]
        inside = np.zeros(len(b) + 2, dtype=bool)
        inside[1:-1] = ~gaps[b]
        ends_of = offsets[np.searchsorted(offsets, i, "right"):np.searchsorted(offsets, j, "left")] - i
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        first[ends_of] = inside[1:-1][ends_of]
        last[ends_of - 1] = inside[1:-1][ends_of - 1]
        a, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(BYTE[b] * powers(BASE, len(b)), out=total[1:])
        h = (total[e] - total[a]) * powers(BACK, len(b) + 1)[a]
        out.append(stir(h + (e - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        at.append(a + i)
        found += len(a)
        i, size = j, BLOCK
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(out), np.searchsorted(np.concatenate(at), offsets, "left")


def runs(h: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and position of every run of n words."""
    sizes = np.maximum(np.diff(offsets) - n + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start = offsets[text] + at
    out = np.zeros(len(text), dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + h[start + k]
    return stir(out), text, at
