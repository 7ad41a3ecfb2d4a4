"""Words, shingles and document sets as 64-bit numbers, vectorised over batches of documents.

A word is a run of bytes other than ASCII white space, A-Z lower-cased, so the words of a text are those
of ``[^\\x20\\x09-\\x0D]+`` over its UTF-8 bytes. A shingle is ``width`` words in a row; a shorter text has
its whole sequence as its one shingle, and a text without words has none. Distinct words or shingles
share a number with a chance of about 2 ** -60 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_STEP = 0x9E3779B97F4A7C1B  # 3 modulo 8: its powers repeat as late as they can
_INVERSE = pow(_STEP, -1, 1 << 64)
#: Texts are hashed in runs of about so many bytes, which bounds the memory.
RUN_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte, upper and lower case alike, and which bytes are white space."""
    byte = np.arange(256)
    byte[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return mix(byte.astype(np.uint64) + np.uint64(0x243F6A8885A308D3)), space


class Hasher:
    """Hashes runs of texts; powers are kept for the longest run seen."""

    def __init__(self) -> None:
        self.number, self.space = _byte_tables()
        self.up = self.down = np.ones(1, np.uint64)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word of all texts in order, and the number of words of each text."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if len(data) + 1 > len(self.up):
            self.up, self.down = _powers(_STEP, len(data) + 1), _powers(_INVERSE, len(data) + 1)
        gap = self.space[data]
        before = np.concatenate(([True], gap[:-1]))
        start, end = np.flatnonzero(before & ~gap), np.flatnonzero(~before & gap)
        total = np.concatenate((np.zeros(1, np.uint64),
                                np.cumsum(self.number[data] * self.up[: len(data)], dtype=np.uint64)))
        hashes = mix((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64))
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        upto = np.searchsorted(start, ends)
        return hashes, np.diff(np.concatenate(([0], upto)))

    def shingles(self, texts: list[bytes], width: int) -> Iterator[np.ndarray]:
        """All shingles of each text, in order, repeats included."""
        hashes, counts = self.words(texts)
        offset = 0
        rolled = None
        if len(hashes) >= width:
            rolled = hashes[: len(hashes) - width + 1].copy()
            for i in range(1, width):
                rolled = mix(rolled + np.uint64(i)) + hashes[i : len(hashes) - width + 1 + i]
            rolled = mix(rolled)
        for n in counts.tolist():
            if n >= width:
                yield rolled[offset : offset + n - width + 1]
            elif n:
                yield np.array([xxhash.xxh3_64_intdigest(hashes[offset : offset + n].tobytes(), n)], np.uint64)
            else:
                yield np.empty(0, np.uint64)
            offset += n


def runs(texts: list[bytes], most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts in runs of about RUN_BYTES, or so many; a longer text is a run of its own."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > most:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x


def sets(texts: list[bytes], width: int, hasher: Hasher) -> Iterator[np.ndarray]:
    """The set of shingles of each text, sorted."""
    for a, b in runs(texts):
        for s in hasher.shingles(texts[a:b], width):
            yield distinct(s)


def set_key(hashes: np.ndarray) -> int:
    """One signed 64-bit number for a set; equal sets have equal keys."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)
