"""Hashes of words and word sequences for whole Arrow columns of text, as numpy arrays.

A word's hash is a polynomial over its bytes, taken from running sums over the text, so the
cost is a few vector operations per byte and no Python loop runs over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 20

SEPARATOR, WORD, SYMBOL = 0, 1, 2
#: The six ASCII white space characters; what lies between them is a word.
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)


def _classes(symbols: bool) -> np.ndarray:
    """Class of each byte: white space separates. With ``symbols``, ASCII punctuation forms
    tokens of its own and control bytes separate."""
    table = np.full(256, WORD, np.uint8)
    if symbols:
        for byte in range(128):
            if not chr(byte).isalnum():
                table[byte] = SYMBOL if byte > 0x20 and byte != 0x7F else SEPARATOR
    table[list(WHITE)] = SEPARATOR
    return table


PLAIN, SPLIT = _classes(False), _classes(True)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)

_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < size:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def token_hashes(
    column: pa.Array, classes: np.ndarray = PLAIN, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, offsets of the rows in that array). Tokens are maximal runs of bytes
    of one class other than the separators."""
    data, rows = utf8(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    kind = classes[data]
    edge = np.empty(len(data) + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[rows] = True
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] != SEPARATOR
    starts, ends = starts[real], ends[real]
    folded = _LOWER if lower else _SAME
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + _BLOCK, "right")))
        block = folded[data[origin : ends[last - 1]]].astype(np.uint64)
        up, down = _power_tables(max(_BLOCK + 1, len(block) + 1))
        block += np.uint64(1)
        block *= up[: len(block)]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(block, out=sums[1:])
        a, b = starts[first:last] - origin, ends[first:last] - origin
        hashes[first:last] = (sums[b] - sums[a]) * down[a]
        first = last
    return mix(hashes), np.searchsorted(starts, rows)


def _places(rows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Places with ``reach`` more tokens after them in their row, and the rows' offsets among them."""
    counts = np.maximum(np.diff(rows) - reach, 0)
    out = np.concatenate(([0], np.cumsum(counts)))
    return np.arange(out[-1]) + np.repeat(rows[:-1] - out[:-1], counts), out


def equal_neighbours(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each pair of ``grams(..., (1,))``, whether its two tokens are equal."""
    at, _ = _places(rows, 1)
    return hashes[at] == hashes[at + 1]


def grams(hashes: np.ndarray, rows: np.ndarray, gaps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of word sequences: a token and those ``gaps`` places after it, within one row.
    Returns (hashes, offsets of the rows). ``gaps=(1,)`` gives pairs, ``(2,)`` pairs around one
    skipped word, ``(1, 2, 3, 4)`` five words."""
    at, out_rows = _places(rows, max(gaps))
    if not len(at):
        return np.zeros(0, np.uint64), out_rows
    h = hashes[at]
    for gap in gaps:
        h = mix(h * np.uint64(_BASE) + hashes[at + gap] + np.uint64(gap))
    return h, out_rows


def batches(column: pa.Array, size: int = 1 << 21):
    """Cut a text column in slices of about ``size`` bytes (one row at least): (from, to)."""
    _, rows = utf8(column)
    first, n = 0, len(rows) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(rows, rows[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = last


def row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[rows[1:]] - total[rows[:-1]]
