"""Hashes of the words of many texts at once.

Words are runs of bytes other than space and 0x09-0x0D; only A-Z are lowered. The hash of a word sums a random
number for each byte times one for its place in the word, so that equal words have equal hashes in any text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20  # of texts that are hashed in one go; a longer text goes in pieces that end at a blank

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_OF_BYTE = mix64((_LOWER + 1000).astype(np.uint64))
_NEAR = mix64(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1 << 32)) | np.uint64(1)


def _of_place(place: np.ndarray, most: int) -> np.ndarray:
    if most < len(_NEAR):
        return _NEAR[place]
    return mix64(place.astype(np.uint64) + np.uint64(1 << 32)) | np.uint64(1)


def _hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other in ``data``, and how many each text has."""
    at = np.flatnonzero(~_BLANK[data])
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    first = np.empty(len(at), bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    inner = np.searchsorted(at, ends[:-1])
    first[inner[inner < len(at)]] = True
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, sizes)
    sums = np.add.reduceat(_OF_BYTE[data[at]] * _of_place(place, int(sizes.max())), starts)
    upto = np.searchsorted(at[starts], ends)
    return mix64(sums + sizes.astype(np.uint64)), np.diff(upto, prepend=0)


def _long(data: np.ndarray) -> np.ndarray:
    found, start = [], 0
    while start < len(data):
        size = GROUP_BYTES
        while (end := start + size) < len(data):
            blanks = np.flatnonzero(_BLANK[data[start:end]])
            if len(blanks):
                end = start + int(blanks[-1]) + 1
                break
            size *= 2
        end = min(end, len(data))
        found.append(_hashes(data[start:end], np.array([end - start]))[0])
        start = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def text_hashes(text: bytes | None) -> np.ndarray:
    """The hash of each word of one text, in its order."""
    return _long(np.frombuffer(text or b"", np.uint8))


def word_groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first, hashes, counts)`` for groups of consecutive rows of a binary column, of about ``GROUP_BYTES`` each:
    the number of the first row, the hashes of all words, and the number of words in each row. Null is empty."""
    rows = len(column)
    if not rows:
        return
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + rows + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, side="right")) - 1)
        part = data[offsets[first]:offsets[last]]
        if len(part) > GROUP_BYTES:  # one long text
            hashes = _long(part)
            yield first, hashes, np.array([len(hashes)])
        else:
            yield first, *_hashes(part, offsets[first + 1:last + 1] - offsets[first])
        first = last
