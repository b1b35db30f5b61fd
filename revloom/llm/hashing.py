"""Words of whole texts as 64 bit hashes, computed on Arrow buffers without a Python object per word.

A word is a run of bytes outside 0x20 and 0x09-0x0D of the UTF-8 text with A-Z lower-cased; a null text is empty. Equal
words have equal hashes; different words differ but for a chance of about 2^-64 per pair (a polynomial modulo 2^64 with
a value drawn per byte, then mixed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at a time; a longer single text is a piece of its own. Bounds the memory of a task.
PIECE_BYTES = 1 << 20

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    lowered = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    return mix((lowered + 1).astype(np.uint64) * _M3), space


_VALUE, _SPACE = _tables()
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    up, down = _POWERS["up"][:n], _POWERS["down"][:n]
    if n > PIECE_BYTES + 1:
        _POWERS.clear()
    return up, down


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more entry than texts). Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, begins) for runs of whole texts of about `most` bytes."""
    if not len(texts):
        return
    whole, starts = text_bytes(texts)
    first = 0
    while first < len(starts) - 1:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, side="right")) - 1)
        last = min(last, len(starts) - 1)
        yield first, whole[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, index of each text's first word with the number of words at the end)."""
    texts = len(starts) - 1
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(texts + 1, np.int64)
    inside = np.empty(len(data) + 1, dtype=bool)
    np.logical_not(_SPACE[data], out=inside[:-1])
    inside[-1] = False
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[starts] = True
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    begin = np.flatnonzero(inside & (~before | cut))
    end = np.flatnonzero(before & (~inside | cut))
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[data] * up[:-1], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _M3)
    return hashes, np.searchsorted(begin, starts).astype(np.int64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram beginning at each word but the last n - 1."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = words[:size].copy()
    for i in range(1, n):
        out = mix(out * _M3 + words[i : i + size])
    return out
