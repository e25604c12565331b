"""Vectorised text primitives used inside Arrow tasks.

A chunk of texts is one UTF-8 byte array plus row offsets, taken straight
from the Arrow buffers: no per-row Python strings. Words are maximal runs of
bytes other than ASCII white space (0x20, 0x09-0x0D), after lower-casing
A-Z. NULL texts are empty. Every hash is a fixed function of the bytes, so a
task that is run again gives the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; the arrays of a task are a few dozen times as large.
CHUNK_BYTES = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the word."""
    x = np.asarray(x, dtype=_U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit pseudo-random words for ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed * 0x632BE59BD9B4E019 % 2**64))


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = stream(1, 256)
_BYTE = _PLAIN[FOLD]  # equal for the two cases of a letter
_BASE = 0xD1342543DE82EF95
_POW: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, dtype=_U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=_U))
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of each. A process
    keeps those of one chunk (16 MB in all) for every user of this module; a text
    that is longer than a chunk has its own, which go with it."""
    size = CHUNK_BYTES + 1
    if n > size:
        return tuple(_power_tables(n))
    if not _POW:
        _POW[:] = _power_tables(size)
    return _POW[0][:n], _POW[1][:n]


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of len(arr) + 1) of a string column; NULL counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each (one row at least)."""
    for b in batches:
        _, off = utf8(b.column(b.schema.get_field_index(column)))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield b.slice(at, end - at)
            at = end


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of every word and the word offsets of the rows."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    word = ~SPACE[raw]
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, off)


def span_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of the (case-folded) bytes of every span."""
    if not len(s):
        return np.zeros(0, _U)
    p, inv = powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, _U)
        np.cumsum((_BYTE if fold else _PLAIN)[raw] * p[: len(raw)], out=total[1:])
        return mix((total[e] - total[s]) * inv[np.minimum(s, len(raw))] + (e - s).astype(_U))


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets of the rows)."""
    s, e, w = word_spans(raw, off)
    return span_hashes(raw, s, e), w


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (``len(h) - k + 1`` of them)."""
    m = max(0, len(h) - k + 1)
    out = np.zeros(m, _U)
    with np.errstate(over="ignore"):
        for i, f in enumerate(stream(100 + k, k) | _U(1)):
            out += h[i : i + m] * f
    return mix(out)


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes per row; with fewer words, the
    whole sequence as one; empty without words."""
    h, w = word_hashes(raw, off)
    grams = ngram_hashes(h, k)
    out = []
    for a, b in zip(w[:-1].tolist(), w[1:].tolist(), strict=True):
        if b - a >= k:
            g = np.sort(grams[a : b - k + 1])
            out.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
        else:
            out.append(ngram_hashes(h[a:b], b - a) if b > a else np.zeros(0, _U))
    return out


def distinct(values: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """The distinct values of a small-range integer array in linear time.
    ``scratch`` has one int32 cell per possible value; it needs no clearing."""
    order = np.arange(len(values), dtype=np.int32)
    scratch[values] = order
    return values[scratch[values] == order]
