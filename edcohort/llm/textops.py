"""Vectorised word hashing shared by the operators that run NumPy inside Arrow tasks.

A *word* is a maximal run of bytes outside U+0020 and U+0009-U+000D (the contract's
``[^\\x20\\x09-\\x0D]+``); UTF-8 continuation bytes are never white space, so working
on bytes is exact.  Everything is computed per slice of whole documents of about
``SLICE_BYTES``; a longer document is cut into blocks at white space, so memory is
bounded by the slice plus 8 bytes per word of the longest document.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 500_000


def tidied(batches):
    """The batches; after each, memory that was freed goes back to the system: Python workers live on
    between tasks and stages, and would else hold on to their greatest use."""
    for b in batches:
        yield b
        del b
        pa.default_memory_pool().release_unused()
        if _TRIM is not None:
            _TRIM(0)


#: glibc's malloc_trim, where there is one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_U64 = np.uint64
#: Odd multiplier of the polynomial word hash; 5 mod 8, so powers differ in few low bits.
_BASE = 0x9E3779B97F4A7C15 - 0x10  # ...C05, 5 mod 8


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x + _U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


mix = _splitmix

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = _splitmix(np.arange(1, 257, dtype=np.uint64))
#: Byte values after lower-casing A-Z only.
_LOWER = _BYTES.copy()
_LOWER[65:91] = _LOWER[97:123]

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n, kept for the largest n so far."""
    size = max(n, SLICE_BYTES)
    got = _POWERS.get(0)
    if got is None or len(got[0]) < size:
        base = np.full(size, _BASE, dtype=np.uint64)
        base[0] = 1
        inv = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        inv[0] = 1
        got = _POWERS[0] = (np.multiply.accumulate(base), np.multiply.accumulate(inv))
    return got


#: Bytes from which a word's hash is XXH3 of its bytes: a polynomial modulo 2**64 has collisions among long words.
LONG_WORD = 65


def _long_words(out: np.ndarray, raw: np.ndarray, s: np.ndarray, e: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``out`` with the hashes of the long words put in."""
    for k in np.flatnonzero(e - s >= LONG_WORD).tolist():
        h = xxhash.xxh3_64()
        for at in range(int(s[k]), int(e[k]), 1 << 20):
            h.update(table[raw[at:min(at + (1 << 20), int(e[k]))]].tobytes())
        out[k] = h.intdigest()
    return out


def _block_hashes(raw: np.ndarray, starts_at: np.ndarray, lower: bool):
    """Word hashes of one block, and the start byte of each word."""
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = ~_IS_SPACE[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[starts_at] = True
    cut[0] = cut[-1] = True
    begin = word & cut[:-1]
    begin[1:] |= word[1:] & ~word[:-1]
    end = word & cut[1:]
    end[:-1] |= word[:-1] & ~word[1:]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    power, inverse = _powers(len(raw))
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((_LOWER if lower else _BYTES)[raw] * power[:len(raw)], out=total[1:])
    out = _splitmix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
    return _long_words(out, raw, s, e, _LOWER if lower else _BYTES), s


def hashed_docs(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first, last, hashes, bounds) for slices of documents: the word hashes of
    documents first..last-1 in order, document i's at hashes[bounds[i - first]:bounds[i - first + 1]].
    Null texts have no words."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    _, off_buf, data_buf = texts.buffers()
    off = np.frombuffer(off_buf, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1)
        j = min(j, n)
        lo, hi = int(off[i]), int(off[j])
        if hi - lo <= 2 * SLICE_BYTES:
            h, s = _block_hashes(data[lo:hi], (off[i:j + 1] - lo), lower)
            bounds = np.searchsorted(s, off[i:j + 1] - lo)
        else:  # one long document: blocks cut at white space
            parts, at = [], lo
            while at < hi:
                to = min(at + SLICE_BYTES, hi)
                while to < hi and not _IS_SPACE[data[to]]:
                    gaps = np.flatnonzero(_IS_SPACE[data[to:to + 65536]])
                    to = min(to + (int(gaps[0]) if len(gaps) else 65536), hi)
                parts.append(_block_hashes(data[at:to], np.array([0]), lower)[0])
                at = to
            h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            bounds = np.array([0, len(h)])
        yield i, j, h, bounds
        i = j


_ORDERED = _splitmix(np.arange(1001, 1065, dtype=np.uint64)) | _U64(1)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each window of n word hashes (empty if there are fewer)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = words[:len(words) - n + 1] * _ORDERED[0]
    for k in range(1, n):
        out = out + words[k:len(words) - n + 1 + k] * _ORDERED[k]
    return _splitmix(out)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingle hashes; with fewer words, the whole sequence as one."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < n:
        return gram_hashes(words, len(words)) ^ _U64(len(words))
    return np.unique(gram_hashes(words, n))


def crc_of_ids(ids) -> np.ndarray:
    """Unsigned crc32 of each doc_id written as text; a null id counts as the empty text."""
    return np.array([zlib.crc32(b"" if v is None else str(v).encode()) for v in ids], dtype=np.int64)


def word_hash(word: str, lower: bool = True) -> int:
    """The hash that ``hashed_docs`` gives this word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(_block_hashes(raw, np.array([0]), lower)[0][0])


def byte_values() -> np.ndarray:
    """The value of each byte in hashes that tell all bytes apart."""
    return _BYTES


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts in them) of an array without nulls."""
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), off


def byte_blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first, last, bytes, bounds): the bytes of documents first..last-1, document i's at
    bytes[bounds[i - first]:bounds[i - first + 1]].  A long document comes in several blocks cut at
    white space, each with the same first."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if texts.null_count:
        texts = texts.fill_null("")
    if not n:
        return
    _, off_buf, data_buf = texts.buffers()
    off = np.frombuffer(off_buf, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1))
        at, hi = int(off[i]), int(off[j])
        if hi - at <= 2 * SLICE_BYTES:
            yield i, j, data[at:hi], off[i:j + 1] - at
        else:
            while at < hi:
                to = min(at + SLICE_BYTES, hi)
                gaps = np.flatnonzero(_IS_SPACE[data[to:min(to + 65536, hi)]])
                to = hi if to == hi else to + (int(gaps[0]) if len(gaps) else min(65536, hi - to))
                yield i, j, data[at:to], np.array([0, to - at])
                at = to
        i = j


def run_hashes(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray, table: np.ndarray, prefix: int):
    """Runs of bytes with ``inside`` set, cut at document bounds: (start, end, hash, hash of the first
    ``prefix`` bytes; None for a prefix of 0), with the bytes mapped by ``table`` (256 values)."""
    if not len(raw):
        e = np.empty(0, np.int64)
        return e, e, np.empty(0, np.uint64), np.empty(0, np.uint64)
    word = inside[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[bounds] = True
    cut[0] = cut[-1] = True
    begin = word & cut[:-1]
    begin[1:] |= word[1:] & ~word[:-1]
    end = word & cut[1:]
    end[:-1] |= word[:-1] & ~word[1:]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    power, inverse = _powers(len(raw))
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(table[raw] * power[:len(raw)], out=total[1:])
    whole = _long_words(_splitmix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)), raw, s, e, table)
    if not prefix:
        return s, e, whole, None
    p = np.minimum(e, s + prefix)
    return s, e, whole, _splitmix((total[p] - total[s]) * inverse[s] + _U64(1 << 40))


def _eights(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ``size`` (1 to 8) bytes from ``at`` on as integers; ``raw`` has 8 bytes to spare at its end."""
    got = np.ndarray(len(raw) - 7, "<u8", raw.data, strides=(1,))[at]
    return got & (~_U64(0) >> (_U64(64) - _U64(8) * size.astype(np.uint64)))


def spaced_out(raw: np.ndarray) -> np.ndarray:
    """A copy with 8 bytes to spare, as ``same_bytes`` needs it."""
    return np.concatenate([raw, np.zeros(8, np.uint8)])


def same_bytes(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """For each pair of byte runs, one in ``a`` and one in ``b``, whether they are equal."""
    out = a_size == b_size
    for k in np.flatnonzero(out & (a_size >= LONG_WORD)).tolist():
        out[k] = np.array_equal(a[a_at[k]:a_at[k] + a_size[k]], b[b_at[k]:b_at[k] + b_size[k]])
    open_ = np.flatnonzero(out & (a_size < LONG_WORD) & (a_size > 0))
    done = 0
    while len(open_):
        size = np.minimum(a_size[open_] - done, 8)
        out[open_] = _eights(a, a_at[open_] + done, size) == _eights(b, b_at[open_] + done, size)
        done += 8
        open_ = open_[out[open_] & (a_size[open_] > done)]
    return out
