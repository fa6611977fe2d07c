"""Exact substring dedup with a logarithmic family of sampled suffix arrays.

Every byte goes that is covered by a ``min_len``-byte string which also starts in a document of a
smaller id.

*Sampling.*  Of each ``min_len``-byte string the grams of GRAM bytes with the least hash are its
anchors, so equal strings have equal anchors at equal places, and one position in about
``(min_len - GRAM) / 2`` is an anchor.  Only the suffixes around anchors are indexed.  An anchor's
context is every byte that a string holding the anchor can reach.

*The index family.*  Anchors are dealt by their hash.  Within a task they come in batches in the
order of doc_id: a batch is sorted (its suffix array), scanned together with the levels already
there, and becomes a level itself; levels of like size are merged, so that their sizes grow
geometrically.  A level only ever holds smaller ids than the batch scanned against it.

*Two scans.*  The first compares whole contexts by hash: a context that an earlier document has is
covered as a whole.  Only for the first holder of a context, and only if the gram has another
context, the bytes are sent to the second scan, which compares each ``min_len``-byte string.

What travels is a blob of NumPy arrays for each batch of documents and part, not a row for each
anchor; a batch sends one posting for a context however many of its documents hold it, so that a
passage in a third of all documents costs one posting a batch.  Answers come back as bit strings
aligned with the blobs.  Hashes that decide are 96 bits wide (48 of the gram, 48 of the context).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.bytehash import U64, PrefixHash, row_windows, sliding_min, splitmix, to_bytes
from echoloom.llm.common import give_back, partitions, total_bytes

GRAM = 24
#: Text bytes of a batch of documents; bounds the memory of the tasks that read texts.
BATCH_BYTES = 4 << 20
#: Text bytes whose anchors are found at a time; their hashes stay in the cache.
SLICE_BYTES = 1 << 17
#: Anchors that an index task gets on average.
PART_ANCHORS = 1 << 20
#: Rows of a batch that enters the index family.
STEP = 1 << 19
POSTS = "part int, batch int, ids binary, owner binary, grams binary, contexts binary, spans binary"
VERDICTS = "batch int, part int, kind int, verdict binary"
NONE, COVERED, UNDECIDED = 0, 1, 2


class LogFamily:
    """Sorted levels of (word, key, check, order) rows whose sizes fall geometrically.

    The word mixes key and check, so that one fast sort orders the rows; rows are equal if key and
    check are, and rows of one word that differ in them are told apart.

    Rows must be added in ascending order, with all rows of one order value in the same batch.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []

    @staticmethod
    def word(key, check):
        with np.errstate(over="ignore"):
            return check ^ (key * U64(0x9E3779B97F4A7C15))

    @classmethod
    def groups(cls, key, check):
        """The rows in the order of their words, and where among them each distinct pair begins."""
        word = cls.word(key, check)
        by = np.argsort(word)
        if len(by):
            head = cls._heads(key[by], check[by])
            if (head[1:] & (word[by][1:] == word[by][:-1])).any():  # different pairs of one word
                by = np.lexsort((check, key, word))
                head = cls._heads(key[by], check[by])
        else:
            head = np.zeros(0, dtype=bool)
        return by, head

    @staticmethod
    def _heads(key, check):
        head = np.ones(len(key), dtype=bool)
        head[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        return head

    @classmethod
    def _level(cls, key, check, order):
        """Each distinct pair with its smallest order; also the sorted rows and their groups."""
        by, head = cls.groups(key, check)
        at = by[head]
        least = np.minimum.reduceat(order[by], np.flatnonzero(head))
        return (cls.word(key[at], check[at]), key[at], check[at], least), by, np.cumsum(head) - 1

    def add(self, key: np.ndarray, check: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Which rows have an equal row of a smaller order, in this batch or in any level."""
        if not len(key):
            return np.zeros(0, dtype=bool)
        level, by, group = self._level(key, check, order)
        known = np.zeros(len(level[0]), dtype=bool)
        for other in self.levels:
            known |= self._in_level(level, other)
        out = np.empty(len(by), dtype=bool)
        out[by] = (order[by] > level[3][group]) | known[group]
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            level = self._merge(self.levels.pop(), level)
        self.levels.append(level)
        return out

    @staticmethod
    def _in_level(level, other) -> np.ndarray:
        """The merge scan: both runs are sorted by word; within a word every row is looked at."""
        out = np.zeros(len(level[0]), dtype=bool)
        row, at = np.arange(len(level[0])), np.searchsorted(other[0], level[0])
        while len(row):
            here = at < len(other[0])
            row, at = row[here], at[here]
            here = other[0][at] == level[0][row]
            row, at = row[here], at[here]
            same = (other[1][at] == level[1][row]) & (other[2][at] == level[2][row])
            out[row[same]] = True
            row, at = row[~same], at[~same] + 1
        return out

    def _merge(self, older, newer):
        return self._level(*(np.concatenate([a, b]) for a, b in zip(older[1:], newer[1:])))[0]

    def merged(self):
        """The (key, check, order) of all rows as one level, and the family becomes that level."""
        empty = np.zeros(0, U64)
        level = self.levels[0] if self.levels else (empty, empty, empty, np.zeros(0, np.int64))
        for newer in self.levels[1:]:
            level = self._merge(level, newer)
        self.levels = [level]
        return level[1:]


class _Batch:
    """The anchors of one batch of documents, the same in every pass."""

    def __init__(self, table: pa.Table, min_len: int, parts: int) -> None:
        gram, self.min_len, self.parts = gram_size(min_len), min_len, parts
        self.reach = min_len - gram  # how far left of an anchor a string may start
        ids = np.array([-1 if i is None else i for i in table.column("doc_id").to_pylist()], dtype=np.int64)
        named = np.array([i is not None for i in table.column("doc_id").to_pylist()], dtype=bool)
        self.rows = np.lexsort((ids, ~named))  # by id, the rows without one last
        texts = table.column("text")
        self.texts = [to_bytes(texts[int(i)].as_py()) for i in self.rows]
        self.ids, self.named = ids[self.rows], named[self.rows]
        self.offsets = np.zeros(len(self.texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in self.texts], out=self.offsets[1:])
        self.buf = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        self._parts: list[tuple[int, np.ndarray]] | None = None
        self._anchor(gram)

    def _anchor(self, gram: int) -> None:
        empty = np.zeros(0, dtype=np.int64)
        found = [(empty, empty.astype(U64), empty.astype(U64)), *(self._anchors_of(a, b, gram) for a, b in self._slices())]
        self.at, grams, contexts = (np.concatenate(some) for some in zip(*found))
        self.doc = np.searchsorted(self.offsets, self.at, side="right") - 1
        self.left = np.maximum(self.at - self.reach, self.offsets[self.doc])
        self.right = np.minimum(self.at + self.min_len, self.offsets[self.doc + 1])
        # One posting for each gram and context: that of the smallest id, which stands first.
        by, head = LogFamily.groups(grams, contexts)
        first = np.minimum.reduceat(by, np.flatnonzero(head)) if len(by) else by
        order = np.argsort(first)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.first = first[order]  # the anchor that stands for each posting
        self.posting = np.empty(len(by), dtype=np.int64)
        self.posting[by] = place[np.cumsum(head) - 1]
        self.grams, self.contexts = grams[self.first], contexts[self.first]

    def _slices(self):
        """Runs of documents of about SLICE_BYTES."""
        a = 0
        while a < len(self.texts):
            b = max(a + 1, int(np.searchsorted(self.offsets, self.offsets[a] + SLICE_BYTES, side="right")) - 1)
            yield a, b
            a = b

    def _anchors_of(self, a: int, b: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, grams and contexts of the anchors of documents a to b."""
        base, width = self.offsets[a], self.reach + 1
        buf, offsets = self.buf[base : self.offsets[b]], self.offsets[a : b + 1] - base
        use = self.named[a:b] & (np.diff(offsets) >= self.min_len)
        if not use.any():
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64), np.zeros(0, dtype=U64)
        sums = PrefixHash(buf)
        hashes = sums.windows(gram)
        rank = np.maximum(hashes >> U64(32), U64(1)).astype(np.uint32)
        least = sliding_min(rank, width)  # for each string start, up to n - min_len
        edge = np.zeros(len(buf) + 1, dtype=np.int32)  # the starts at which a whole string fits into a document in use
        np.add.at(edge, offsets[:-1][use], 1)
        np.add.at(edge, (offsets[1:] - self.min_len + 1)[use], -1)
        starts = np.cumsum(edge[: len(least)]) > 0
        # The largest minimum among the strings that hold a position; it is an anchor if that is its own.
        none = np.uint32(0xFFFFFFFF)
        turned = np.full(len(rank) + width - 1, none, dtype=np.uint32)
        turned[width - 1 : width - 1 + len(least)] = np.where(starts, ~least, none)
        lowest = sliding_min(turned, width)[: len(rank)]
        at = np.flatnonzero((~lowest == rank) & (lowest != none))
        doc = np.searchsorted(offsets, at, side="right") - 1
        left = np.maximum(at - self.reach, offsets[doc])
        right = np.minimum(at + self.min_len, offsets[doc + 1])
        with np.errstate(over="ignore"):
            context = splitmix(sums.ranges(left, right) + (at - left).astype(U64) * U64(0x9E3779B97F4A7C15))
        return at + base, hashes[at] >> U64(16), context >> U64(16)

    def parts_of(self) -> list[tuple[int, np.ndarray]]:
        """The postings of each part, in the order in which every pass lists them."""
        if self._parts is None:
            part = (self.grams % U64(self.parts)).astype(np.min_scalar_type(self.parts))  # few bits: a radix sort
            by = np.argsort(part, kind="stable")
            cut = np.flatnonzero(part[by][1:] != part[by][:-1]) + 1
            self._parts = [(int(part[some[0]]), some) for some in np.split(by, cut) if len(some)]
        return self._parts


def gram_size(min_len: int) -> int:
    return max(1, min(GRAM, min_len // 2))


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel().astype(U64)


def _pack_docs(batch: _Batch, docs: np.ndarray) -> tuple[bytes, bytes]:
    """The ids of the documents that hold some postings, and which posting is whose."""
    some, owner = np.unique(docs, return_inverse=True)
    ids = batch.ids[some]
    return zlib.compress(np.diff(ids, prepend=0).astype("<i8").tobytes(), 1), zlib.compress(np.diff(owner, prepend=0).astype("<i4").tobytes(), 1)


def _unpack_docs(ids: bytes, owner: bytes) -> np.ndarray:
    ids = np.cumsum(np.frombuffer(zlib.decompress(ids), dtype="<i8"))
    return ids[np.cumsum(np.frombuffer(zlib.decompress(owner), dtype="<i4"))]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[k] for r in rows], kinds[kind]) for k, (name, kind) in enumerate(fields)})


def _post(min_len: int, parts: int):
    def run(key, table):
        batch, out = _Batch(table, min_len, parts), []
        for part, some in batch.parts_of():
            ids, owner = _pack_docs(batch, batch.doc[batch.first[some]])
            out.append((part, key[0].as_py(), ids, owner, _six(batch.grams[some]), _six(batch.contexts[some]), b""))
        return _table(out, POSTS)

    return run


def _in_order(table: pa.Table):
    """The blobs of a part: batch of each, its rows, all ids, and the rows' order by id."""
    batches = table.column("batch").to_pylist()
    ids = [_unpack_docs(a, b) for a, b in zip(table.column("ids").to_pylist(), table.column("owner").to_pylist())]
    ends = np.cumsum([len(x) for x in ids])
    ids = np.concatenate(ids)
    return batches, ends, ids, np.argsort(ids, kind="stable")


def _steps(ids: np.ndarray, limit: int):
    """Cuts sorted ids into slices of about `limit` rows that split no id."""
    a = 0
    while a < len(ids):
        b = int(np.searchsorted(ids, ids[min(len(ids), a + limit) - 1], side="right"))
        yield slice(a, b)
        a = b


def _first_scan(key, table):
    batches, ends, ids, by = _in_order(table)
    grams = np.concatenate([_from_six(x) for x in table.column("grams").to_pylist()])
    contexts = np.concatenate([_from_six(x) for x in table.column("contexts").to_pylist()])
    family, verdict = LogFamily(), np.zeros(len(ids), dtype=np.uint8)
    for step in _steps(ids[by], STEP):
        rows = by[step]
        verdict[rows[family.add(grams[rows], contexts[rows], ids[rows])]] = COVERED
    gram = np.sort(family.merged()[0])
    several = np.unique(gram[1:][gram[1:] == gram[:-1]])  # grams with more than one context
    if len(several):
        slot = np.minimum(np.searchsorted(several, grams), len(several) - 1)
        verdict[(several[slot] == grams) & (verdict == NONE)] = UNDECIDED
    out, a = [], 0
    for batch, b in zip(batches, ends.tolist()):
        out.append((batch, key[0].as_py(), 0, zlib.compress(verdict[a:b].tobytes(), 1)))
        a = b
    return _table(out, VERDICTS)


def _answers(batch: _Batch, table: pa.Table, kind: int) -> dict[int, bytes]:
    return {p: zlib.decompress(v) for p, k, v in zip(*(table.column(c).to_pylist() for c in ("part", "kind", "verdict"))) if k == kind}


def _verdicts(batch: _Batch, table: pa.Table) -> np.ndarray:
    out, said = np.zeros(len(batch.first), dtype=np.uint8), _answers(batch, table, 0)
    for part, some in batch.parts_of():
        out[some] = np.frombuffer(said[part], dtype=np.uint8)
    return out


def _ask(min_len: int, parts: int):
    """Sends the bytes around the undecided postings to the second scan."""

    def run(key, texts, verdicts):
        if not texts.num_rows or not verdicts.num_rows:
            return _table([], POSTS)
        batch, out = _Batch(texts, min_len, parts), []
        verdict = _verdicts(batch, verdicts)
        width = batch.reach + min_len
        padded = np.concatenate([np.zeros(batch.reach, np.uint8), batch.buf, np.zeros(min_len, np.uint8)])
        for part, some in batch.parts_of():
            some = some[verdict[some] == UNDECIDED]
            if not len(some):
                continue
            anchors = batch.first[some]
            at = batch.at[anchors]
            ids, owner = _pack_docs(batch, batch.doc[anchors])
            around = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
            spans = np.stack([at - batch.left[anchors], batch.right[anchors] - at], axis=1).astype("<u4")
            out.append((part, key[0].as_py(), ids, owner, _six(batch.grams[some]), zlib.compress(around.tobytes(), 1), spans.tobytes()))
        return _table(out, POSTS)

    return run


def _second_scan(min_len: int):
    reach = min_len - gram_size(min_len)
    width = reach + min_len

    def run(key, table):
        batches, ends, ids, by = _in_order(table)
        grams = np.concatenate([_from_six(x) for x in table.column("grams").to_pylist()])
        around = np.concatenate([np.frombuffer(zlib.decompress(x), dtype=np.uint8).reshape(-1, width) for x in table.column("contexts").to_pylist()])
        spans = np.concatenate([np.frombuffer(x, dtype="<u4").reshape(-1, 2) for x in table.column("spans").to_pylist()]).astype(np.int64)
        covered = np.zeros((len(ids), reach + 1), dtype=bool)
        family, back = LogFamily(), np.arange(reach + 1)
        for step in _steps(ids[by], max(1, STEP // (reach + 1))):
            rows = by[step]
            fits = (back <= spans[rows, :1]) & (min_len - back <= spans[rows, 1:])
            row, shift = np.nonzero(fits)
            strings = row_windows(around[rows], min_len)[row, reach - shift]
            seen = family.add(grams[rows][row], strings, ids[rows][row])
            covered[rows[row[seen]], shift[seen]] = True
        bits = np.packbits(covered, axis=1)
        out, a = [], 0
        for batch, b in zip(batches, ends.tolist()):
            out.append((batch, key[0].as_py(), 1, zlib.compress(bits[a:b].tobytes(), 1)))
            a = b
        return _table(out, VERDICTS)

    return run


def _removed(batch: _Batch, verdicts: pa.Table) -> np.ndarray:
    """Which bytes of the batch go."""
    change = np.zeros(len(batch.buf) + 1, dtype=np.int32)
    if len(batch.first):
        verdict = _verdicts(batch, verdicts)
        first_id = batch.ids[batch.doc[batch.first]][batch.posting]
        later = batch.ids[batch.doc] > first_id
        whole = later | (verdict[batch.posting] == COVERED)
        np.add.at(change, batch.left[whole], 1)
        np.add.at(change, batch.right[whole], -1)
        said, shifts = _answers(batch, verdicts, 1), batch.reach + 1
        bits = np.zeros((len(batch.first), (shifts + 7) // 8), dtype=np.uint8)
        for part, some in batch.parts_of():
            if part in said:
                bits[some[verdict[some] == UNDECIDED]] = np.frombuffer(said[part], dtype=np.uint8).reshape(-1, bits.shape[1])
        open_ = np.flatnonzero(~whole & (verdict[batch.posting] == UNDECIDED))
        row, shift = np.nonzero(np.unpackbits(bits[batch.posting[open_]], axis=1, count=shifts))
        start = batch.at[open_[row]] - shift
        np.add.at(change, start, 1)
        np.add.at(change, start + batch.min_len, -1)
    return np.cumsum(change[:-1]) > 0


def _on_characters(buf: bytes, gone: np.ndarray) -> np.ndarray:
    """Gives back the bytes of characters that would go in part."""
    data = np.frombuffer(buf, dtype=np.uint8)
    if not gone.any() or (data < 0x80).all():
        return gone
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    whole = np.logical_and.reduceat(gone, lead)
    return np.repeat(whole, np.diff(np.append(lead, len(data))))


def _finish(min_len: int, parts: int, digests: bool):
    def run(key, texts, verdicts):
        batch = _Batch(texts, min_len, parts)
        gone = _removed(batch, verdicts)
        counts, spans, kept = [], [], []
        for text, a, b in zip(batch.texts, batch.offsets[:-1].tolist(), batch.offsets[1:].tolist()):
            own = gone[a:b]
            if not digests:
                own = _on_characters(text, own)
            counts.append(int(own.sum()))
            spans.append(int((own[1:] & ~own[:-1]).sum() + own[:1].sum()))
            kept.append(text if not counts[-1] else np.frombuffer(text, dtype=np.uint8)[~own].tobytes())
        rows = texts.take(pa.array(batch.rows))
        sizes = [len(t) for t in batch.texts]
        found = {"n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(counts, pa.int64()), "n_spans": pa.array(spans, pa.int64())}
        if digests:
            digest = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
            return pa.table({"doc_id": rows.column("doc_id")} | found | {"kept_sha256": digest})
        was_null = texts.column("text").take(pa.array(batch.rows)).is_null().to_pylist()
        text = pa.array([None if null else k.decode("utf-8", "surrogatepass") for k, null in zip(kept, was_null)], pa.string())
        return pa.table({"text": text, "rest": rows.column("rest")} | found)

    return run


def _dealt(docs: DataFrame, min_len: int, rest) -> tuple[DataFrame, int]:
    size = total_bytes(docs)
    count = max(1, -(-size // BATCH_BYTES))
    parts = partitions(docs.sparkSession, 2 * size // max(1, min_len - gram_size(min_len) + 1), PART_ANCHORS)
    place = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *rest, F.pmod(F.xxhash64(place), F.lit(count)).cast("int").alias("batch")
    )
    return chosen, parts


def _giving_back(run):
    """The same function of a key and one or two tables, which leaves no memory behind in the worker."""
    if run.__code__.co_argcount == 2:
        def done(key, table):
            out = run(key, table)
            give_back()
            return out
    else:
        def done(key, texts, verdicts):
            out = run(key, texts, verdicts)
            give_back()
            return out
    return done


def _run(docs: DataFrame, min_len: int, rest: list, schema: str, digests: bool) -> DataFrame:
    texts, parts = _dealt(docs, min_len, rest)
    by_batch = texts.groupBy("batch")
    verdicts = by_batch.applyInArrow(_giving_back(_post(min_len, parts)), POSTS).groupBy("part").applyInArrow(_giving_back(_first_scan), VERDICTS)
    asked = by_batch.cogroup(verdicts.groupBy("batch")).applyInArrow(_giving_back(_ask(min_len, parts)), POSTS)
    strings = asked.groupBy("part").applyInArrow(_giving_back(_second_scan(min_len)), VERDICTS)
    answers = verdicts.unionByName(strings)
    return by_batch.cogroup(answers.groupBy("batch")).applyInArrow(_giving_back(_finish(min_len, parts, digests)), schema)


def substring_digests(docs: DataFrame, min_len: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of (doc_id, text).

    Null and empty texts have no bytes; texts shorter than `min_len` keep all.  Rows of an equal id
    take nothing from each other.  A row with a null id keeps all its bytes and takes none away.
    """
    return _run(docs, min_len, [], "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", True)


def remove_substrings(docs: DataFrame, min_len: int = 99) -> DataFrame:
    """The documents, all columns, without the repeated strings; characters never go in part.

    n_chars, where there is such a column, becomes the new length.  A text of which nothing but
    white space is left is dropped with its row, unless nothing was removed from it.
    """
    others = [c for c in docs.columns if c != "text"]
    rest = F.struct(*[docs[c] for c in others]).alias("rest")
    kind = docs.select(rest).schema["rest"].dataType.simpleString()
    out = _run(docs, min_len, [rest], f"text string, rest {kind}, n_bytes long, n_removed long, n_spans long", False)
    out = out.where("n_removed = 0 or trim(both ' \\n\\t\\r' from text) <> ''")
    length = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    cells = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, length).otherwise(F.col("rest.n_chars")) if "n_chars" in others else None}
    return out.select(*[(cells[c] if c in cells else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
