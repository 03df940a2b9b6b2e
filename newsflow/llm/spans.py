"""Words of an Arrow batch as byte spans and 64-bit keys, without making a string per word.

A word is a maximal run of ASCII letters and digits and of other characters, lower-cased. Separators are every
other ASCII character and the blocks of signs outside ASCII: U+0080-U+00BF (without the ordinal signs and micro), U+2000-U+2BFF,
U+3000-U+303F and U+1F000-U+1FFFF. All work is numpy over the text bytes, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
_LONG_WORD = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits each depend on all input bits."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[ord("a"):ord("z") + 1] = _LETTERS[ord("A"):ord("Z") + 1] = True
_LETTERS[128:] = True
_WORD_BYTES = _LETTERS.copy()
_WORD_BYTES[ord("0"):ord("9") + 1] = True


@dataclass
class Words:
    """Words of some rows: ``data[start:end]`` are the bytes of one; words of row r are ``bounds[r]:bounds[r + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.count)

    def text(self, at: int) -> str:
        return self.data[self.start[at]:self.end[at]].tobytes().decode("utf-8", "replace")


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) pieces of at most ``limit`` bytes, one row at least; null becomes empty."""
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        base = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The text bytes of a null-free array and the offset of each row, from 0."""
    wide = isinstance(texts, pa.LargeStringArray)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _word_mask(data: np.ndarray, digits: bool) -> np.ndarray:
    mask = (_WORD_BYTES if digits else _LETTERS)[data]
    if not len(data) or int(data.max()) < 128:
        return mask
    ahead = np.append(data[1:], 0)
    signs = np.flatnonzero((data == 0xC2) & (ahead != 0xAA) & (ahead != 0xB5) & (ahead != 0xBA))
    blocks = np.flatnonzero(((data == 0xE2) & (ahead <= 0xAF)) | ((data == 0xE3) & (ahead == 0x80)))
    faces = np.flatnonzero((data == 0xF0) & (ahead == 0x9F))
    for found, width in ((signs, 2), (blocks, 3), (faces, 4)):
        for step in range(width):
            mask[np.minimum(found + step, len(data) - 1)] = False
    return mask


def split_words(texts: pa.Array, digits: bool = True, lower: bool = True) -> Words:
    """The words of a null-free array of texts."""
    data, offsets = raw_bytes(pc.utf8_lower(texts) if lower else texts)
    mask = _word_mask(data, digits)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate([[False], mask[:-1]]) if len(mask) else mask
    after = np.concatenate([mask[1:], [False]]) if len(mask) else mask
    start = np.flatnonzero(mask & (~before | first[:-1]))
    end = np.flatnonzero(mask & (~after | first[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def word_keys(words: Words, size: int | None = None) -> np.ndarray:
    """A 64-bit key per word, or per prefix of ``size`` bytes. Bytes beyond the 64th are hashed at once."""
    length = words.end - words.start
    if size is not None:
        length = np.minimum(length, size)
    key = np.full(len(length), 0x51ED270B, dtype=np.uint64)
    live = np.arange(len(length))
    for step in range(int(min(length.max(initial=0), _LONG_WORD))):
        live = live[length[live] > step]
        key[live] = (key[live] ^ _BYTE_KEYS[words.data[words.start[live] + step]]) * _MULTIPLIER
    for at in np.flatnonzero(length > _LONG_WORD):
        tail = words.data[words.start[at] + _LONG_WORD:words.start[at] + length[at]]
        key[at] ^= np.uint64(xxhash.xxh64_intdigest(tail.tobytes()))
    return mix(key + length.astype(np.uint64))


def windows(keys: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A key per run of ``width`` words of one row, and the bounds of rows in them.

    A row with fewer words, but one at least, has one window of all its words.
    """
    count = np.diff(bounds)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    row = np.repeat(np.arange(len(count)), made)
    at = bounds[:-1][row] + np.arange(out_bounds[-1]) - out_bounds[:-1][row]
    stop = bounds[1:][row]
    value = np.full(len(at), width, dtype=np.uint64)
    for step in range(width):
        place = at + step
        there = place < stop
        value = np.where(there, (value ^ keys[np.minimum(place, max(len(keys) - 1, 0))]) * _MULTIPLIER, value)
        value ^= value >> np.uint64(29)
    return mix(value), out_bounds
