"""Vectorised word splitting and hashing over Arrow string columns.

Texts are handled as UTF-8 bytes in pieces of a few megabytes, so that a task's
memory depends on the piece (or on its longest single text), not on the table.
Null texts behave like empty ones everywhere: they have no words.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
_LONG_WORD = 64

_IDX = np.arange(256)
#: bytes outside [^\x20\x09-\x0D]
SPACE = (_IDX == 0x20) | ((_IDX >= 0x09) & (_IDX <= 0x0D))
#: bytes outside [^\x00-\x2F\x3A-\x60\x7B-\x7F], once A-Z are lower-cased
NON_ALNUM = ~(((_IDX >= 0x30) & (_IDX <= 0x39)) | ((_IDX >= 0x61) & (_IDX <= 0x7A)) | (_IDX >= 0x80))
_LOWER = _IDX.astype(np.uint8)
_LOWER[0x41:0x5B] += 0x20

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)


def release() -> None:
    """Give memory that is free inside this process back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of consecutive documents, each word followed by one space.

    ``buf`` holds the bytes, ``starts``/``ends`` the words in it, ``first`` the
    index of each document's first word with the total as last entry.
    """

    def __init__(self, buf: np.ndarray, counts: np.ndarray):
        self.buf = buf
        self.ends = np.flatnonzero(buf == 0x20)
        self.starts = np.empty_like(self.ends)
        if len(self.ends):
            self.starts[0] = 0
            self.starts[1:] = self.ends[:-1] + 1
        self.counts = counts
        self.first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=self.first[1:])

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return word_hashes(self.buf, self.starts, self.ends, seed)

    def window_ok(self, size: int) -> np.ndarray:
        """For each word: does a window of ``size`` words of its document start there?"""
        n = int(self.first[-1])
        ok = np.ones(n, bool)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return ok & (left >= size)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def bytes_of(self, word_from: int, word_to: int) -> bytes:
        """Words word_from..word_to-1, joined by one space."""
        return self.buf[self.starts[word_from]:self.ends[word_to - 1]].tobytes()


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    lens = (ends - starts).astype(np.int64)
    h = mix(lens.astype(np.uint64) * _C1 + np.uint64(seed * 2 + 1))
    if not len(starts):
        return h
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    long = lens > _LONG_WORD
    at = np.flatnonzero(~long) if long.any() else None
    k = 0
    while True:
        s = starts + k if at is None else starts[at] + k
        left = (lens if at is None else lens[at]) - k
        if not len(s):
            break
        v = eight[s]
        short = left < 8
        keep = np.where(short, left, 8).astype(np.uint64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        v = v & np.where(short, (np.uint64(1) << (keep * np.uint64(8) & np.uint64(63))) - np.uint64(1), full)
        if at is None:
            h = (h ^ v) * _C2
            h ^= h >> np.uint64(32)
        else:
            g = (h[at] ^ v) * _C2
            h[at] = g ^ (g >> np.uint64(32))
        more = left > 8
        if not more.any():
            break
        at = np.flatnonzero(more) if at is None else at[more]
        k += 8
    for i in np.flatnonzero(long):
        word = buf[starts[i]:ends[i]].tobytes()
        h[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "<u8")[0]
    return mix(h)


def window_hashes(wh: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, by doubling; the last size-1 are undefined."""
    n = len(wh)
    out, done = None, 0
    power, width = wh, 1
    left = size
    while left:
        if left & 1:
            out = power.copy() if out is None else _join(out, power, done, n)
            done += width
        left >>= 1
        if left:
            power = _join(power, power, width, n)
            width *= 2
    return mix(out ^ np.uint64(size))


def _join(a: np.ndarray, b: np.ndarray, by: int, n: int) -> np.ndarray:
    """a at each position followed by b ``by`` positions later."""
    out = a * _C3
    out ^= out >> np.uint64(29)
    if by < n:
        out[: n - by] += b[by:] * _C1
    out ^= out >> np.uint64(32)
    return out * _C2


def utf8(texts: pa.Array) -> pa.Array:
    """Null texts as empty ones; a chunked column in one piece."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    return pc.fill_null(texts, "")


def offsets_and_data(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 on and the bytes of a string array without nulls."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, off, data = texts.buffers()
    n = len(texts)
    if n == 0 or data is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(off, width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    return off - off[0], np.frombuffer(data, np.uint8)[off[0]:off[-1]]


def split_words(texts: pa.Array, outside: np.ndarray = SPACE, lower: bool = False) -> Words:
    """Words of each text; ``outside`` marks the bytes that separate them."""
    spaced = pc.binary_join_element_wise(utf8(texts), "", " ")
    off, data = offsets_and_data(spaced)
    if lower:
        data = _LOWER[data]
    gap = outside[data]
    inside = ~gap
    after = np.empty_like(inside)
    after[:1] = False
    after[1:] = inside[:-1]
    buf = data[inside | after]  # words, each with the separator behind it
    buf[outside[buf]] = 0x20
    ends = np.cumsum(gap & after)
    at = np.concatenate([[0], ends])[off]  # words that end before each offset
    return Words(buf, np.diff(at))


def pieces(columns: list[pa.Array], text: int, size: int = PIECE_BYTES) -> Iterator[list[pa.Array]]:
    """Cut a batch's columns where the text column passes ``size`` bytes."""
    texts = columns[text]
    n = len(texts)
    if n == 0:
        return
    lens = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(lens)
    at = 0
    while at < n:
        base = total[at] - lens[at]
        to = max(at + 1, int(np.searchsorted(total, base + size, side="right")))
        yield [c.slice(at, to - at) for c in columns]
        at = to
