"""Shingle hashes of many texts at once, and compact bytes for sorted numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
import zstandard

from .common import BLANKS, words_of

#: Bits of a shingle hash that are kept. Two texts are compared by these; at a thousand shingles each they agree by
#: chance in one of them once in some hundred million pairs.
BITS = 48
SHINGLE_WORDS = 5
#: Words whose letters are spread out at a time, so that a long text takes little more than itself.
WORDS_AT_ONCE = 1 << 15


class _WordHashes(dict):
    """Hash by word, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = x = xxhash.xxh3_64_intdigest(word)
        return x


_seen = _WordHashes()


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hashes of words; a bounded table remembers the frequent ones."""
    if len(_seen) > 400_000:
        _seen.clear()
    return np.fromiter(map(_seen.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every window of ``k`` words; a document with fewer words is one window.

    ``hashes`` are the words of all documents end to end, ``counts`` the number of words of each.
    """
    n = len(hashes)
    of = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    at = np.arange(n)
    odd = mixed(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        part = np.zeros(n, dtype=np.uint64)
        part[: max(n - j, 0)] = hashes[j:] * odd[j]
        total += np.where(at + j < ends, part, np.uint64(j + 1))
    starts = ends - np.repeat(counts, counts)
    whole = (at + k <= ends) | ((at == starts) & (ends - starts < k))
    return mixed(total[whole]) >> np.uint64(64 - BITS), of[whole]


def text_shingles(texts: Sequence[str | None], k: int = SHINGLE_WORDS, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of texts; with ``lower`` A to Z count as a to z."""
    docs = [words_of(t) for t in texts]
    counts = np.array([len(d) for d in docs], dtype=np.int64)
    return shingles(word_hashes([w for d in docs for w in (b"\n".join(d).lower().split(b"\n") if lower and d else d)]), counts, k)


class Words:
    """Hashes of the words of many texts, worked out over all their bytes at once.

    A word's hash is the sum of a random number per byte value times one per place, spread afterwards. ``doc`` is the
    text of each word, ``begin`` its first byte in ``data``, where texts stand one after the other with a line feed
    between them; ``counts`` are the words per text.
    """

    def __init__(self, raw: Sequence[bytes]):
        self.data = data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
        self.text_begin = np.cumsum(sizes) - sizes
        blank = np.ones(len(data) + 1, dtype=bool)
        blank[1:] = _BLANK[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        self.begin, end = edge[::2], edge[1::2]
        self.doc = np.searchsorted(self.text_begin, self.begin, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(raw)).astype(np.int64)
        size = end - self.begin
        place = mixed(np.arange(int(size.max(initial=0)), dtype=np.uint64) + np.uint64(101)) | np.uint64(1)
        self.hashes = np.zeros(len(size), dtype=np.uint64)
        for a in range(0, len(size), WORDS_AT_ONCE):
            some = size[a : a + WORDS_AT_ONCE]
            here = slice(self.begin[a], self.begin[a + len(some) - 1] + some[-1])
            at = np.cumsum(some) - some
            letters = _BYTE[data[here][~blank[1:][here]]]
            letters *= place[np.arange(len(letters)) - np.repeat(at, some)]
            self.hashes[a : a + len(some)] = mixed(np.add.reduceat(letters, at) ^ some.astype(np.uint64))


_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative numbers as bytes: differences where they only rise, byte planes, compressed."""
    x = numbers.astype(np.uint64)
    rising = len(x) > 1 and bool(np.all(x[1:] >= x[:-1]))
    if rising:
        x = np.diff(x, prepend=np.uint64(0))
    width = 4 if not len(x) or int(x.max()) < 1 << 32 else 8
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width + rising]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    width, rising = data[0] & ~1, data[0] & 1
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8)
    x = np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").reshape(-1).astype(np.uint64)
    return np.cumsum(x, dtype=np.uint64) if rising else x
