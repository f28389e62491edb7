"""Word bounds and rolling hashes over Arrow text, whole batches at a time.

Everything here runs inside Spark tasks on the raw UTF-8 buffer of one Arrow
column: a byte table says which bytes separate words, so no Python string is
made per word.  Hashes are polynomials modulo 2**64 over prefix sums
(Rabin-Karp), finished by a bit mixer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
"""Documents are taken together up to this many bytes; a longer one stands alone."""

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
"""For ``bytes.translate``: A-Z lower-cased."""

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 20
_WORD_BASE = 0x9E3779B97F4A7C13  # odd, = 3 modulo 8
_GRAM_BASE = 0xC2B2AE3D27D4EB4B


def separators(kind: str) -> np.ndarray:
    """256 booleans.  ``space``: 0x20 and 0x09-0x0D; ``alnum``: every ASCII byte but letters and digits."""
    lut = np.zeros(256, bool)
    if kind == "space":
        lut[[0x20, *range(0x09, 0x0E)]] = True
    elif kind == "alnum":
        lut[:128] = [not chr(b).isalnum() for b in range(128)]
    else:
        raise ValueError(f"unknown word kind {kind!r}")
    return lut


def fold_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut[buf]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """base**i and its inverse modulo 2**64, grown on demand, kept per worker."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 12)
            self.up, self.down = (self._series(x, size) for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_WORD, _GRAM = _Powers(_WORD_BASE), _Powers(_GRAM_BASE)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Chunk:
    """Some documents of a batch: ``first`` is the row of the batch that holds the first."""

    first: int
    buf: np.ndarray  # bytes of all texts, one behind the other
    off: np.ndarray  # byte offsets, one more than documents

    @property
    def size(self) -> int:
        return len(self.off) - 1


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Documents in order, whole, several to a chunk.  Nulls are empty."""
    parts = texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]
    row = 0
    for part in parts:
        if part.null_count:
            part = part.fill_null("")
        kind = np.int64 if pa.types.is_large_string(part.type) else np.int32
        n = len(part)
        if not n:
            continue
        off = np.frombuffer(part.buffers()[1], kind)[part.offset:part.offset + n + 1].astype(np.int64)
        data = part.buffers()[2]
        buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            to = min(to, n)
            yield Chunk(row + at, buf[off[at]:off[to]], off[at:to + 1] - off[at])
            at = to
        row += n


@dataclass
class Words:
    """Byte bounds of the words of a chunk; ``off`` says where each document's words begin."""

    start: np.ndarray
    end: np.ndarray
    off: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def find_words(chunk: Chunk, sep: np.ndarray) -> Words:
    inside = ~sep[chunk.buf]
    n = len(inside)
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = chunk.off[:-1][chunk.off[:-1] < n]
        first[edges] = inside[edges]
        edges = chunk.off[1:][chunk.off[1:] > 0] - 1
        last[edges] = inside[edges]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, chunk.off))


def hash_words(buf: np.ndarray, words: Words) -> np.ndarray:
    """One 64-bit hash per word, by prefix sums over stretches of about CHUNK_BYTES."""
    out = np.empty(len(words.start), np.uint64)
    at, n = 0, len(out)
    while at < n:
        origin = int(words.start[at])
        to = max(at + 1, int(np.searchsorted(words.end, origin + CHUNK_BYTES, side="right")))
        s, e = words.start[at:to] - origin, words.end[at:to] - origin
        size = int(e[-1])
        up, down = _WORD.upto(size + 1)
        prefix = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTES[buf[origin:origin + size]] * up[:size], out=prefix[1:])
        out[at:to] = (prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64)
        at = to
    return mix(out)


class Rolling:
    """Hashes of any run of words in O(1) from prefix sums over the word hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        up, self.down = _GRAM.upto(len(hashes) + 1)
        self.prefix = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=self.prefix[1:])

    def run(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of words lo..hi-1 (the length is not mixed in)."""
        return mix((self.prefix[hi] - self.prefix[lo]) * self.down[lo])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all k consecutive words (across documents too: mask with :func:`inside`)."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.down[:n])


def inside(words: Words, k: int) -> np.ndarray:
    """Starts of the k-word windows that stand in one document."""
    n = np.maximum(np.diff(words.off) - k + 1, 0)
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = words.off[:-1] - np.concatenate(([0], np.cumsum(n)[:-1]))
    return np.arange(total) + np.repeat(shift, n)


def i64(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed number, for a Spark long."""
    return np.ascontiguousarray(x).view(np.int64)


def word_blocks(raw: bytes, overlap: int = 0) -> Iterator[list[bytes]]:
    """Words between blanks in runs of about a megabyte; each run starts with the last ``overlap`` words before it."""
    held: list[bytes] = []
    at, given = 0, False
    while at < len(raw):
        cut = _BLANK.search(raw, at + _BLOCK)
        to = cut.start() if cut else len(raw)
        held = held + raw[at:to].split()
        at = to
        if len(held) > overlap:
            yield held
            held, given = held[len(held) - overlap:], True
    if held and not given:
        yield held
