"""Vectorised work on the UTF-8 bytes of a batch of texts (runs on executors)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; temporary arrays are some 40 times that.
SLICE_BYTES = 1 << 21
_U = np.uint64
_MASK = (1 << 64) - 1


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n + 1 offsets of its texts; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None or offsets.size == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return body, at - at[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (splitmix64's)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


def _pieces(body: np.ndarray, space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SLICE_BYTES that begin after a white-space byte, so they cut no word."""
    at, n = 0, len(body)
    while at < n:
        end = min(n, at + SLICE_BYTES)
        while end < n:
            stop = min(n, end + SLICE_BYTES)
            found = np.flatnonzero(space[body[end:stop]])
            if len(found):
                end += int(found[0]) + 1
                break
            end = stop
        yield at, end
        at = end


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z lower-cased, and the text each belongs to."""
    space, lower = _space_table(), _lower_table()
    first = np.zeros(len(body) + 1, bool)
    first[offsets[:-1]] = True  # a text's first byte begins a word even after a letter
    hashes, texts = [], []
    base = _U(0x9E3779B97F4A7C15)
    for a, b in _pieces(body, space):
        part = body[a:b]
        letter = ~space[part]
        start = letter.copy()
        start[1:] &= ~letter[:-1] | first[a + 1 : b]
        at = np.flatnonzero(letter)
        if not len(at):
            continue
        starts = np.flatnonzero(start)
        to = np.searchsorted(at, starts)
        lengths = np.diff(np.append(to, len(at)))
        place = np.arange(len(at)) - np.repeat(to, lengths)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(lengths.max()), base, _U))
            values = (lower[part[at]].astype(_U) + _U(1)) * powers[place]
            words = np.add.reduceat(values, to) ^ (lengths.astype(_U) * _U(0xD6E8FEB86659FD93))
        hashes.append(mix64(words))
        texts.append(np.searchsorted(offsets, starts + a, side="right") - 1)
    if not hashes:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(texts)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their n + 1 offsets.

    A shingle is ``width`` words in a row; a text with fewer words, but some, has one shingle of them all.
    """
    words, texts = word_hashes(body, offsets)
    n = len(offsets) - 1
    counts = np.bincount(texts, minlength=n)
    ends = np.concatenate([[0], np.cumsum(counts)])
    with np.errstate(over="ignore"):
        run = mix64(words * _U(3) + _U(1))
        for k in range(1, width):
            run = mix64(run[:-1] * _U(0x9FB21C651E98DF25) + words[k:]) if len(run) > 1 else run[:0]
    sets = []
    for i in range(n):
        a, b = ends[i], ends[i + 1]
        if b - a >= width:
            sets.append(np.unique(run[a : b - width + 1]))
        elif b > a:
            short = words[a:b]
            with np.errstate(over="ignore"):
                value = mix64(short[:1] + _U(b - a) * _U(0xA24BAED4963EE407))
                for k in range(1, b - a):
                    value = mix64(value * _U(0x9FB21C651E98DF25) + short[k : k + 1])
            sets.append(value)
        else:
            sets.append(words[:0])
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if n else words[:0]), np.concatenate([[0], np.cumsum(sizes)])
