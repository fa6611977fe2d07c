"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so whole-document similarity says nothing; what counts is
the share of an item's shingles that a document holds.  Items are partitioned by the size of their
shingle sets.  An item of n shingles is contained at ``percent`` if at most ``n - ceil(n * percent /
100)`` of them are missing, so at least one of any ``missing + 1`` is present.  A partition's sketch
length is that number at its largest size, and an item's sketch are its least hashes of that number
(bottom-k MinHash): a document that contains the item holds a sketch hash, whatever its length.
Candidates found that way are verified on the exact shingle sets.  Nothing is missed, and only
documents with a sketch hash cost more than one lookup.

Items go to the executors in groups of bounded bytes (GROUP_BYTES of shingle hashes), one narrow
pass over the documents for each group; a usual benchmark is one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.bytehash import U64, byte_batches, combine, shingle_sets, to_bytes, word_hashes

#: Bytes of shingle hashes that are sent to the executors at once.
GROUP_BYTES = 16 << 20
FOUND = "doc_id long, item_id long, n_item long, n_common long, containment double"


def sketch_length(size: int, percent: int) -> int:
    """Hashes of an item that cannot all be missing, for the size partition that `size` is in.

    Partitions hold the sizes from a power of two to the next; the length for the largest of them
    is enough for all.
    """
    largest = (1 << size.bit_length()) - 1
    return min(size, largest - -(-largest * percent // 100) + 1)


class ItemIndex:
    """The sketches and the shingle sets of a group of items."""

    def __init__(self, items: list[tuple[int, bytes]], size: int, percent: int) -> None:
        self.size, self.percent = size, percent
        self.ids = [i for i, _ in items]
        words = word_hashes([t for _, t in items])[1]
        #: Shingle lengths in use: `size`, and the lengths of items with fewer words.
        self.width = [min(size, int(b - a)) for a, b in zip(words[:-1], words[1:])]
        self.widths = sorted({w for w in self.width if w})
        self.sets = shingle_sets([t for _, t in items], size)
        sketch = [(h, k) for k, grams in enumerate(self.sets) for h in grams[: sketch_length(len(grams), percent)].tolist()] if items else []
        sketch.sort()
        self.keys = np.array([h for h, _ in sketch], dtype=U64)
        self.owner = np.array([k for _, k in sketch], dtype=np.int64)

    def contained(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shingles of the item, of which the text holds) for items contained in texts."""
        if not len(self.keys):
            return
        hashes, first = word_hashes(texts)
        hits: list[np.ndarray] = []
        grams_of, starts_of = {}, {}
        for width in self.widths:
            grams = combine(hashes, width)
            inside = np.ones(len(grams), dtype=bool)
            for k in range(1, width):  # not over the end of a text
                cut = first[1:-1] - k
                inside[cut[(cut >= 0) & (cut < len(grams))]] = False
            at = np.flatnonzero(inside)
            grams_of[width], starts_of[width] = grams[at], at
            slot = np.minimum(np.searchsorted(self.keys, grams_of[width]), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[slot] == grams_of[width])
            text = np.searchsorted(first, at[hit], side="right") - 1
            lowest, highest = np.searchsorted(self.keys, grams_of[width][hit]), np.searchsorted(self.keys, grams_of[width][hit], side="right")
            pairs = [np.stack([np.repeat(text, highest - lowest), self.owner[_spans(lowest, highest)]], axis=1)] if len(hit) else []
            hits += pairs
        if not hits:
            return
        for text, item in np.unique(np.concatenate(hits), axis=0).tolist():
            width, grams = self.width[item], self.sets[item]
            a, b = np.searchsorted(starts_of[width], [first[text], first[text + 1]])
            common = int(np.isin(grams, grams_of[width][a:b]).sum())
            if 100 * common >= self.percent * len(grams):
                yield text, item, len(grams), common


def _spans(lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
    count = highest - lowest
    return np.repeat(lowest - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _groups(items: list[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes]]]:
    yield from byte_batches(items, GROUP_BYTES // 2)


def _search(group: list[tuple[int, bytes]], size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(group, size, percent)
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (to_bytes(t.as_py()) for t in batch.column(1)))
            for part in byte_batches(rows):
                found = [(part[t][0], index.ids[i], n, common, common / n) for t, i, n, common in index.contained([text for _, text in part])]
                if found:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["doc_id", "item_id", "n_item", "n_common", "containment"])

    return run


def read_items(benchmark: DataFrame) -> Iterator[tuple[int, bytes]]:
    """The items one by one: the driver holds one partition of the benchmark at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.where("text is not null").distinct().toLocalIterator():
        yield row["item_id"], to_bytes(row["text"])


def contained_items(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_item, n_common, containment) for every document that contains an item.

    Null and empty texts, and texts without words, contain nothing and are contained in nothing.  An
    item of fewer than `size` words is one shingle of its own length, searched at that length.
    Repeated documents each get their rows; repeated items count once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], FOUND)
    for group in _groups(read_items(benchmark)):
        out = out.union(docs.mapInArrow(_search(group, size, percent), FOUND))
    return out


def _clean(group: list[tuple[int, bytes]], size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(group, size, percent)
        for batch in batches:
            place = batch.schema.get_field_index("text")
            keep, start = np.ones(batch.num_rows, dtype=bool), 0
            for part in byte_batches(enumerate(to_bytes(t.as_py()) for t in batch.column(place))):
                for text, *_ in index.contained([t for _, t in part]):
                    keep[start + text] = False
                start += len(part)
            yield batch.filter(pa.array(keep))

    return run


def without_items(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, that contain no item."""
    for group in _groups(read_items(benchmark)):
        docs = docs.mapInArrow(_clean(group, size, percent), docs.schema)
    return docs
