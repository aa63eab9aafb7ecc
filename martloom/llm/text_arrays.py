"""Whole Arrow batches of text as numpy arrays: words, word hashes and distinct shingle hashes without a loop over words.

A batch's texts lie in one UTF-8 buffer. Words are runs of bytes of one class, so all of them are found with a few passes
over that buffer. A word's 64-bit hash is a polynomial over random byte values, taken as a difference of running sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _byte_class(inside: set[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[sorted(inside)] = True
    return table


#: Bytes of `[^\x20\x09-\x0D]+`, and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased.
NOT_SPACE = _byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})
ALPHANUMERIC = _byte_class({*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)})

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_VALUE = np.random.Generator(np.random.PCG64(0x5EED)).integers(1, _MASK, 256, dtype=np.uint64)


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64, by doubling."""
    out = np.empty(count, dtype=np.uint64)
    out[:1] = 1
    filled, step = 1, base
    while filled < count:
        more = min(filled, count - filled)
        out[filled : filled + more] = out[:more] * np.uint64(step)
        filled += more
        step = step * step & _MASK
    return out


class _PowerTable:
    """Powers of the base and of its inverse, grown as longer batches come."""

    def __init__(self) -> None:
        self.up = self.down = _powers(_ODD, 1)

    def reach(self, count: int) -> None:
        if len(self.up) < count:
            size = 1 << (count - 1).bit_length()
            self.up, self.down = _powers(_ODD, size), _powers(pow(_ODD, -1, 1 << 64), size)


_POWER = _PowerTable()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def utf8_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


#: Bytes whose running sums are held at a time.
PIECE_BYTES = 1 << 19


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word data[start:end], a run of words of about PIECE_BYTES at a time."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        at = start[i]
        j = max(i + 1, int(np.searchsorted(end, at + PIECE_BYTES, "right")))
        piece = data[at : end[j - 1]]
        _POWER.reach(len(piece) + 1)
        running = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[piece] * _POWER.up[: len(piece)], out=running[1:])
        out[i:j] = (running[end[i:j] - at] - running[start[i:j] - at]) * _POWER.down[start[i:j] - at]
        i = j
    return mix(out)


class Words:
    """The words of a batch of texts: hash of each, and per text the place of its first word (`first`, one entry more)."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, inside: np.ndarray) -> None:
        raw, at = utf8_buffer(texts)
        data = _LOWER[raw]
        word = inside[data]
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        starts_text = at[:-1][at[:-1] < at[1:]]
        opens[starts_text] = word[starts_text]
        closes = word.copy()
        closes[:-1] &= ~word[1:]
        ends_text = at[1:][at[:-1] < at[1:]] - 1
        closes[ends_text] = word[ends_text]
        start, last = np.flatnonzero(opens), np.flatnonzero(closes)
        self.first = np.searchsorted(start, at)
        self.hash = _hashes(data, start, last + 1)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def word_counts(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return Words(texts, NOT_SPACE).counts()


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Per text its sorted distinct hashes of `size` words in a row; all words as one if there are fewer, none if none."""
    h, first = words.hash, words.first
    factor = _powers(0xD6E8FEB86659FD93, size + 2)[1:]
    whole = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
    for j in range(size):
        whole += h[j : j + len(whole)] * factor[j]
    whole = mix(whole)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = int(b - a)
        if n >= size:
            found = np.sort(whole[a : b - size + 1])
            sets.append(found[np.concatenate(([True], found[1:] != found[:-1]))])
        elif n:
            short = np.array([(h[a:b] * factor[:n]).sum(dtype=np.uint64) + np.uint64(n)], dtype=np.uint64)
            sets.append(mix(short * factor[size]))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets
