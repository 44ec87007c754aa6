"""64-bit hashes of words and word shingles of whole Arrow batches of texts, without a Python step per word."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text hashed at once; a longer text is cut at white space.
PIECE = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over the whole word."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits.
_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_VALUE[65:91] = _VALUE[97:123]
_tables: dict[str, np.ndarray] = {}


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        _tables["up"], _tables["down"] = _powers(max(n, PIECE + 1), _BASE), _powers(max(n, PIECE + 1), _INVERSE)
    return _tables["up"], _tables["down"]


def _words(data: np.ndarray, starts: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data``, and their first bytes; a word also ends where a text starts."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if between is _MARK:
        # The capitals of the Latin-1 block are 0xC3 0x80 to 0xC3 0x9E, without the multiplication sign 0x97.
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97))
        data = data.copy()
        data[capital + 1] += 0x20
    inside = ~between[data]
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.logical_not(inside[:-1], out=fresh[1:])
    fresh[starts[starts < n]] = True
    first = np.flatnonzero(inside & fresh)
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = fresh[1:] | ~inside[1:]
    end = np.flatnonzero(inside & last) + 1
    up, down = _grown(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:n], out=total[1:])
    return mix((total[end] - total[first]) * down[first] + (end - first).astype(np.uint64)), first


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset:
        column = pa.concat_arrays([column.slice(0, 0), column])
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data and data.size else np.empty(0, np.uint8)), ends


def word_hashes(column: pa.Array, letters: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, word hashes, n + 1 offsets of n texts' words), for runs of texts that follow each other.

    Words are runs of bytes other than white space (0x20, 0x09 to 0x0D), A to Z lower-cased. With ``letters``
    they are runs of ASCII letters and digits and of anything beyond ASCII, and Latin-1 capitals are folded too.
    """
    between = _MARK if letters else _SPACE
    data, ends = _texts(column)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE, "right")) - 1)
        lo, hi = int(ends[row]), int(ends[to])
        if hi - lo <= PIECE:
            hashes, first = _words(data[lo:hi], (ends[row:to] - lo).astype(np.int64), between)
            yield row, hashes, np.searchsorted(first, ends[row : to + 1] - lo)
        else:
            parts, at = [], lo
            while at < hi:
                cut = min(hi, at + PIECE)
                while cut < hi and not _SPACE[data[cut]]:
                    gap = np.flatnonzero(_SPACE[data[cut : cut + PIECE]])
                    cut = min(hi, cut + (int(gap[0]) if len(gap) else PIECE))
                parts.append(_words(data[at:cut], np.zeros(1, np.int64), between)[0])
                at = cut
            hashes = np.concatenate(parts)
            yield row, hashes, np.array([0, len(hashes)])
        row = to


_STEP = mix(np.arange(11, 75, dtype=np.uint64)) | _U(1)
_LENGTH = mix(np.arange(101, 165, dtype=np.uint64))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text in turn, the sorted distinct hashes of its shingles of ``width`` words.

    A text of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    empty = np.empty(0, np.uint64)
    for _, words, ends in word_hashes(column):
        n = len(words)
        joined = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width if len(joined) else 0):
            joined += words[k : k + len(joined)] * _STEP[k % 64]
        joined = mix(joined)
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if hi - lo >= width:
                yield np.unique(joined[lo : hi - width + 1])
            elif hi > lo:
                whole = (words[lo:hi] * _STEP[np.arange(hi - lo) % 64]).sum(dtype=np.uint64, keepdims=True)
                yield mix(whole + _LENGTH[(hi - lo) % 64 : (hi - lo) % 64 + 1])
            else:
                yield empty
