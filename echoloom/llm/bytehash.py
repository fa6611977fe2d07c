"""Vectorised hashing of byte text: words, word shingles and sliding byte windows.

Everything here works on NumPy arrays over one concatenated buffer, so that a batch of
documents costs a fixed number of array passes and no Python loop over words or bytes.

A word is a maximal run of bytes outside ``{0x20, 0x09..0x0D}``; ASCII capitals are
lower-cased first when asked for.  All hashes are 64 bits wide and depend on the bytes alone
(no per-process seed), so executors agree with each other.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_MASK = (1 << 64) - 1


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = x + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


#: One pseudo-random 64-bit value per byte value.
BYTE_VALUE = splitmix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))
#: Odd, hence invertible modulo 2**64.
BASE = 0x9E6C63D0676A9A99
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class _PowerTable:
    """Powers of BASE and of its inverse, grown on demand up to the longest batch seen."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(BASE, n), _powers(BASE_INVERSE, n)
        return self.up, self.down


_TABLE = _PowerTable()


def release_tables() -> None:
    """Forgets the powers; the next batch makes its own."""
    _TABLE.up = _TABLE.down = np.zeros(0, dtype=U64)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def to_bytes(text) -> bytes:
    """UTF-8 of a text; null is empty."""
    if text is None:
        return b""
    return text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")


class PrefixHash:
    """Polynomial prefix hashes of a buffer; any range hash is then O(1)."""

    def __init__(self, buf: np.ndarray) -> None:
        n = len(buf)
        up, self._down = _TABLE.get(n + 1)
        self.sums = np.zeros(n + 1, dtype=U64)
        with np.errstate(over="ignore"):
            np.cumsum(BYTE_VALUE[buf] * up[:n], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash for each buf[start:end]; equal bytes have equal hashes wherever they stand."""
        with np.errstate(over="ignore"):
            return splitmix((self.sums[end] - self.sums[start]) * self._down[start])

    def windows(self, width: int) -> np.ndarray:
        """The hashes of all buf[i:i+width]."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=U64)
        with np.errstate(over="ignore"):
            return splitmix((self.sums[width:] - self.sums[:n]) * self._down[:n])


def row_windows(rows: np.ndarray, width: int) -> np.ndarray:
    """For each row of a byte matrix the hashes of all row[i:i+width], as PrefixHash has them."""
    n, long = rows.shape
    up, down = _powers(BASE, long), _powers(BASE_INVERSE, long)
    sums = np.zeros((n, long + 1), dtype=U64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_VALUE[rows] * up, axis=1, out=sums[:, 1:])
        return splitmix((sums[:, width:] - sums[:, : long + 1 - width]) * down[: long + 1 - width])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words in a buffer."""
    word = np.zeros(len(buf) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[buf]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a newline after each text, and the offset of each text (one more at the end)."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8), offsets


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and where each text's words begin."""
    hashes, first, _, _ = located_words(texts, lower)
    return hashes, first


def located_words(texts: list[bytes], lower: bool = True):
    """As word_hashes, and each word's start and end as byte offsets within its text."""
    if not texts:
        empty = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=U64), np.zeros(1, dtype=np.int64), empty, empty
    buf, offsets = join_texts(texts)
    if lower:
        buf = _LOWER[buf]
    start, end = word_spans(buf)
    hashes = PrefixHash(buf).ranges(start, end)
    first = np.searchsorted(start, offsets)
    base = np.repeat(offsets[:-1], np.diff(first))
    return hashes, first, start - base, end - base


def combine(hashes: np.ndarray, size: int) -> np.ndarray:
    """An order-dependent hash for each run of `size` neighbours."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        out = splitmix(hashes[:n] + U64(size))
        for k in range(1, size):
            out = splitmix(out * U64(0xD6E8FEB86659FD93) + hashes[k : k + n])
    return out


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Each text's sorted set of distinct shingles of `size` words.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    hashes, first = word_hashes(texts)
    grams = combine(hashes, size)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        n = b - a
        if n >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(combine(hashes[a:b], n) if n else np.zeros(0, dtype=U64))
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` neighbours, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out[:n]


def byte_batches(rows, limit: int = 1 << 19):
    """Cuts an iterable of (key, bytes) into lists of at most `limit` bytes, one text at least."""
    batch, held = [], 0
    for row in rows:
        if batch and held + len(row[1]) > limit:
            yield batch
            batch, held = [], 0
        batch.append(row)
        held += len(row[1])
    if batch:
        yield batch
