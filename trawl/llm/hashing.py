"""Stable 64-bit hashes of words and of runs of words, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

# Texts whose words are found at once; what is kept at hand grows with it, results don't depend on it.
TEXT_BYTES = 2_000_000
# Longer words are hashed one by one.
SHORT_WORD = 64

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LOWER_BYTES = np.frombuffer(_LOWER, np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xC2B2AE3D27D4EB4F)
_INK = np.array([c not in b"\x20\x09\x0a\x0b\x0c\x0d" for c in range(256)])
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as they are."""
    return (text or "").encode("utf-8", "replace").split()


def split_lower(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(_LOWER).split()


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def runs(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of every run of ``size`` words."""
    n = max(0, len(hashes) - size + 1)
    total = np.full(n, seed + size, np.uint64)
    for i in range(size):
        total = (total ^ hashes[i : i + n]) * _MORE
        total ^= total >> np.uint64(32)
    return total


class Words(NamedTuple):
    """The words of several texts, each with one space after it."""

    joined: np.ndarray
    # Where each word starts in ``joined``, and the end of that.
    start: np.ndarray
    # The number of each text's first word, and the number of words.
    first: np.ndarray


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``TEXT_BYTES`` together, as first and last number."""
    ends = _bytes_of(texts)[1]
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(ends, ends[begin] + TEXT_BYTES, "right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield begin, end
        begin = end


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of texts, and where each starts and the last ends in it; null is as empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    return data, offsets - offsets[0]


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """The words of ``texts`` (between ASCII white space), found for all at once.

    They are as they are, or with A-Z lower-cased.
    """
    data, bounds = _bytes_of(texts)
    if lower:
        data = _LOWER_BYTES[data]
    ink = _INK[data]
    inside = bounds[bounds < len(data)]
    starts = ink.copy()
    starts[1:] &= ~ink[:-1]
    starts[inside] = ink[inside]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:]
    last = bounds[bounds > 0] - 1
    ends[last] = ink[last]
    begins = np.flatnonzero(starts)
    start = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(np.flatnonzero(ends) - begins + 2, out=start[1:])
    joined = np.full(start[-1], 32, np.uint8)
    letters = np.ones(len(joined), bool)
    letters[start[1:] - 1] = False
    joined[letters] = data[ink]
    return Words(joined, start, np.searchsorted(begins, bounds))


def word_hashes(words: Words) -> np.ndarray:
    """The hash of every word, from eight of its bytes at a time."""
    joined, begin = words.joined, words.start[:-1]
    size = np.diff(words.start) - 1
    blocks = np.zeros(len(joined) // 8 + 2, "<u8")
    blocks.view(np.uint8)[: len(joined)] = joined
    total = mix(size.astype(np.uint64))
    which = slice(None)
    for done in range(0, SHORT_WORD, 8):
        if done:
            which = np.flatnonzero(size > done)
        at, left = begin[which] + done, np.minimum(size[which] - done, 8)
        if not len(at):
            break
        block, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
        value = blocks[block] >> shift
        # A shift by 64 gives 0.
        value |= blocks[block + 1] << (np.uint64(64) - shift)
        total[which] = mix((total[which] ^ (value & _FIRST_BYTES[left])) * _MORE)
    for i in np.flatnonzero(size > SHORT_WORD).tolist():
        word = joined[begin[i] : begin[i] + size[i]].tobytes()
        total[i] = xxhash.xxh3_64_intdigest(word)
    return total


def least_of_runs(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbouring values."""
    if len(values) < size:
        return values[:0]
    known = 1
    while known < size:
        step = min(known, size - known)
        values = np.minimum(values[:-step], values[step:])
        known += step
    return values
