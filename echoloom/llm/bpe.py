"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one *last token* that a correct encoding of the
prefix can end in.  It is the one token ``t`` that ends there, is reachable by the merges, and
forms a valid pair with the last token of the prefix before ``t``.  Storing that token per prefix
gives exact appends (old entries never change) and cheap re-encoding after edits (entries before
the edit stay).  Unlike repeated merging it is linear in the piece, so very long pieces are safe.

Ranks come from a tiktoken-style file whose path is a parameter; nothing is trained here.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.bytehash import PrefixHash, splitmix, to_bytes
from echoloom.llm.common import give_back

#: Pieces and pairs that a worker remembers before it starts afresh; bounds memory only.
CACHE_ENTRIES = 600_000
#: Longer units are not remembered.
UNIT_CHARS = 64
#: A space beside other white space.
SPACE_RUN = re.compile(r" \s|\s ")
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _with_space(words: list[str]) -> list[str]:
    """The words of a text that was split at spaces, each but the first with its space."""
    return words[:1] + [" " + w for w in words[1:]]


class PrefixBpe:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {i: b for b, i in ranks.items()}
        by_tail: dict[bytes, set[int]] = {}
        for b in ranks:
            by_tail.setdefault(b[-2:], set()).add(len(b))
        #: The lengths, longest first, of tokens that end in given two bytes (or are one byte).
        self.lengths = {tail: tuple(sorted(n, reverse=True)) for tail, n in by_tail.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._units: dict[str, bytes] = {}
        self._lookup: _Lookup | None = None

    # -- the merge table -------------------------------------------------------------------

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes `token`; itself twice for a byte; None if no merges reach it."""
        known = self._halves.get(token, 0)
        if known != 0:
            return known
        word = self.token[token]
        if len(word) == 1:
            out = (token, token)
        else:
            parts = [word[i : i + 1] for i in range(len(word))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            out = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        self._halves[token] = out
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes together leaves the boundary between them."""
        key = (left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > CACHE_ENTRIES:
                self._pairs.clear()
            known = self._pairs[key] = self._boundary_holds(left, right)
        return known

    def _boundary_holds(self, left: int, right: int) -> bool:
        if self.halves(left) is None or self.halves(right) is None:
            return False
        # Undo, latest merge first, the merges next to the boundary; at each state a merge across
        # it that would have come before the merge undone last breaks the pair.
        before = None
        while True:
            joined = self.ranks.get(self.token[left] + self.token[right])
            if joined is not None and self.halves(joined) == (left, right) and (before is None or joined < before):
                return False
            a, b = len(self.token[left]) > 1, len(self.token[right]) > 1
            if not a and not b:
                return True
            # Of equal ranks the left one merges first, so the right one is undone first.
            if a and (not b or left > right):
                before, left = left, self.halves(left)[1]
            else:
                before, right = right + 1, self.halves(right)[0]

    # -- pieces ----------------------------------------------------------------------------

    def last_tokens(self, piece: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of each prefix; `known` holds those of a leading part already."""
        last = list(known or [])
        for end in range(len(last) + 1, len(piece) + 1):
            for n in self.lengths.get(piece[max(0, end - 2) : end], ()):
                if n > end:
                    continue
                token = self.ranks.get(piece[end - n : end])
                if token is not None and (self.fits(last[end - n - 1], token) if n < end else self.halves(token) is not None):
                    break
            else:
                token = self.ranks[piece[end - 1 : end]]
            last.append(token)
        return last

    def walk(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.token[out[-1]])
        return out[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.walk(self.last_tokens(piece))

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many pieces; the prefix tables of those of a like length advance in step."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        for least, most in ((1, 12), (13, 32), (33, 96)):
            some = np.flatnonzero((lengths >= least) & (lengths <= most))
            if len(some):
                for i, ids in zip(some.tolist(), self._in_step([pieces[i] for i in some.tolist()])):
                    out[i] = ids
        for i in np.flatnonzero(lengths > 96).tolist():
            out[i] = np.array(self.encode_piece(pieces[i]), dtype="<u4").tobytes()
        return out

    def _in_step(self, pieces: list[bytes]) -> list[bytes]:
        if self._lookup is None:
            self._lookup = _Lookup(self)
        look = self._lookup
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(-size, kind="stable")  # the longest first: those still running are a leading part
        size = size[order]
        buf = np.frombuffer(b"".join([pieces[i] for i in order.tolist()]), dtype=np.uint8)
        first = np.cumsum(size) - size
        sums = PrefixHash(buf)
        last = np.full(len(buf), -1, dtype=np.int64)
        whole = np.full(len(pieces), -1, dtype=np.int64)
        for end in range(1, int(size[0]) + 1):
            running = np.searchsorted(-size, -end, side="right")
            open_ends = first[:running] + end  # exclusive ends of the prefixes without a last token
            for n in range(min(end, look.longest), 0, -1):
                start = open_ends - n
                at, token = look.tokens(sums.ranges(start, open_ends), n)
                if n == end:
                    complete = open_ends[at] - first[:running][at] == size[:running][at]
                    whole[at[complete]] = token[complete]
                    good = look.reachable(token)
                else:
                    good = look.fits(last[start[at] - 1], token)
                last[open_ends[at[good]] - 1] = token[good]
                if good.any():
                    rest = np.ones(len(open_ends), dtype=bool)
                    rest[at[good]] = False
                    open_ends = open_ends[rest]
                if not len(open_ends):
                    break
        steps, cursor, live = [], first + size, np.arange(len(pieces))
        direct = whole >= 0
        while len(live):
            token = np.where(direct[live], whole[live], last[cursor[live] - 1])
            steps.append((live, token))
            cursor[live] -= look.size[token]
            live = live[cursor[live] > first[live]]
        owner = np.concatenate([a for a, _ in steps])
        depth = np.repeat(np.arange(len(steps)), [len(a) for a, _ in steps])
        tokens = np.concatenate([t for _, t in steps])[np.lexsort((-depth, owner))].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(pieces))) * 4
        out, a = [b""] * len(pieces), 0
        for i, b in zip(order.tolist(), ends.tolist()):
            out[i] = tokens[a:b]
            a = b
        return out

    # -- texts -----------------------------------------------------------------------------

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        No match of the pattern reaches over a single space between two other characters that
        are not white space: the next match starts there.  So a text splits at such spaces into
        units that are matched, encoded and remembered by themselves.
        """
        units = self._units
        if len(units) > CACHE_ENTRIES:
            units.clear()
        split = [[text] if SPACE_RUN.search(text) else _with_space(text.split(" ")) for text in texts]
        new = list(set().union(*split).difference(units))
        found = [self.pattern.findall(unit) for unit in new]
        pieces = list(set().union(*found))
        packed = dict(zip(pieces, self.encode_pieces([to_bytes(p) for p in pieces])))
        ready = {unit: b"".join(map(packed.__getitem__, some)) for unit, some in zip(new, found)}
        units.update((u, ids) for u, ids in ready.items() if len(u) <= UNIT_CHARS)
        for some in split:
            try:
                yield b"".join(map(units.__getitem__, some))
            except KeyError:  # a long unit, which is not remembered
                yield b"".join([units[u] if u in units else ready[u] for u in some])

    def encode_packed(self, text: str) -> bytes:
        return next(self.encode_many([text]))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text or ""), dtype="<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Lookup:
    """Array forms of the rank table and of the pair test."""

    SLOTS = 1 << 20

    def __init__(self, bpe: PrefixBpe) -> None:
        self.bpe = bpe
        ids = sorted(bpe.token)
        self.size = np.zeros(ids[-1] + 1, dtype=np.int64)
        by_length: dict[int, list[int]] = {}
        for i in ids:
            self.size[i] = len(bpe.token[i])
            by_length.setdefault(len(bpe.token[i]), []).append(i)
        self.longest = max(by_length)
        self._tables = {}
        for n, some in by_length.items():
            buf = np.frombuffer(b"".join(bpe.token[i] for i in some), dtype=np.uint8)
            start = np.arange(len(some)) * n
            hashes = PrefixHash(buf).ranges(start, start + n)
            order = np.argsort(hashes)
            present = np.zeros(1 << 16, dtype=bool)
            present[(hashes >> np.uint64(48)).astype(np.int64)] = True
            self._tables[n] = (hashes[order], np.array(some, dtype=np.int64)[order], present)
        #: -1: not known yet; direct-mapped, so that it never grows.
        self._reached = np.full(len(self.size), -1, dtype=np.int8)
        self._keys = np.full(self.SLOTS, -1, dtype=np.int64)
        self._fits = np.zeros(self.SLOTS, dtype=bool)

    def tokens(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes of n-byte strings are tokens, and which tokens."""
        if n not in self._tables:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        keys, ids, present = self._tables[n]
        at = np.flatnonzero(present[(hashes >> np.uint64(48)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
        hit = keys[slot] == hashes[at]
        return at[hit], ids[slot[hit]]

    def reachable(self, token: np.ndarray) -> np.ndarray:
        for t in np.unique(token[self._reached[token] < 0]).tolist():
            self._reached[t] = self.bpe.halves(t) is not None
        return self._reached[token] == 1

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        slot = (splitmix(key.astype(np.uint64)) & np.uint64(self.SLOTS - 1)).astype(np.int64)
        good = self._fits[slot]
        missing = np.flatnonzero(self._keys[slot] != key)
        if len(missing):
            new, place = np.unique(key[missing], return_inverse=True)
            found = np.array([self.bpe._boundary_holds(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()])
            good[missing] = found[place]
            self._keys[slot[missing]] = key[missing]
            self._fits[slot[missing]] = good[missing]
        return good


class PrefixTable:
    """One growing piece: appends are exact, and an edit re-encodes from where it starts."""

    def __init__(self, bpe: PrefixBpe, piece: bytes = b"") -> None:
        self.bpe, self.piece, self.last = bpe, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.last = self.bpe.last_tokens(self.piece, self.last)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Puts `new` in place of piece[start:end]; the entries before `start` are kept."""
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.last = self.bpe.last_tokens(self.piece, self.last[:start])

    def tokens(self) -> list[int]:
        whole = self.bpe.ranks.get(self.piece)
        return [whole] if whole is not None else self.bpe.walk(self.last)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> PrefixBpe:
    return PrefixBpe(read_ranks(path), pattern)


def encoded(bpe: PrefixBpe, column: pa.Array, limit: int = 1_000_000) -> Iterator[bytes]:
    """The packed ids of a text column, about `limit` characters at a time to bound memory."""
    held: list[str] = []
    size = 0
    for cell in column:
        held.append(cell.as_py() or "")
        size += len(held[-1])
        if size >= limit:
            yield from bpe.encode_many(held)
            held, size = [], 0
    yield from bpe.encode_many(held)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Token counts and digests of every document, and its ids (binary, `<u4`) if asked for.

    One narrow pass without a shuffle.  Null and empty texts have no tokens and the digests of
    no bytes; repeated rows and null ids give a row each; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ranks_path, pattern)
        longest = max(bpe.token) + 1
        words = [bpe.token.get(i, b"") for i in range(longest)]
        for batch in batches:
            counts, ids_digest, text_digest, packed = [], [], [], []
            for ids in encoded(bpe, batch.column(1)):
                values = np.frombuffer(ids, dtype="<u4")
                counts.append(len(values))
                ids_digest.append(hashlib.sha256(ids).hexdigest())
                text_digest.append(hashlib.sha256(b"".join(map(words.__getitem__, values.tolist()))).hexdigest())
                if with_ids:
                    packed.append(ids)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(packed, pa.binary())] * with_ids, names=names)
        encoder.cache_clear()  # the tables of 50,000 tokens would stay in idle workers
        del bpe, words
        give_back()

    schema = RESULT + ", ids binary" * with_ids
    names = [part.split()[0] for part in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
