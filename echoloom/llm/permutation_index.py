"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots.  Each pivot has an inverted file of the
vectors that rank it, with the rank.  A query walks the files of its own nearest pivots and adds up
how far apart the ranks are (the footrule distance; a pivot that a vector does not rank counts as
ranked last).  The nearest by footrule are measured again on the original vectors.

*Sizes.*  Pivots are fitted on a bounded sample (PIVOT_SAMPLE vectors, chosen by a hash of their
content); every vector is indexed.  The index is partitioned by documents: a block of rows (an Arrow
batch) has its own inverted files, and copies of a vector are one entry in them.  A block measures
SHARE of its entries again, whatever its size, and LEAST of them for each neighbour that is asked for,
without which a handful of rows could not fill a result.  Queries go to the blocks in groups of
QUERY_BYTES, one narrow pass over the rows for each group, whose few best rows are written to the
shared folder; the passes' results are cut to k for each query by a window that Spark also runs before
the shuffle, so that no task holds more than k rows of a query from each of its inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.llm.common import Passes, stored

PIVOTS = 256
#: Pivots that a vector ranks.
RANKED = 64
PIVOT_SAMPLE = 2048
#: Entries of a block that are measured again, as a share and for each neighbour.
SHARE, LEAST = 0.2, 4
#: Bytes of the vectors of a group of queries: what is sent to the tasks at once.
QUERY_BYTES = 8 << 20
#: Queries whose results are held at once in a task.
QUERY_STEP = 64
FOUND = "query_id long, vec_id long, score double"


def usable(column: str):
    """Not null, no null or non-finite component, and not zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(column, lambda x: x != 0)


def choose_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Up to PIVOTS different vectors of each length, from the bounded sample.

    The sample has the least hashes of vector content.  Only vectors under a hash bound, which lets
    about eight times the sample through, are made distinct; all are if that leaves too few.
    """
    hashed = vectors.select("vector", F.xxhash64("vector").alias("h"))
    share = min(1.0, 8 * PIVOT_SAMPLE / max(1, vectors.count()))
    for bound in [-(1 << 63) + int(share * (1 << 64)) - 1] * (share < 1) + [(1 << 63) - 1]:
        rows = [r["vector"] for r in hashed.where(F.col("h") <= bound).dropDuplicates(["h"]).orderBy("h").limit(PIVOT_SAMPLE).collect()]
        if len(rows) >= PIVOTS:
            break
    by_width: dict[int, list] = {}
    for row in rows:
        by_width.setdefault(len(row), []).append(row)
    return {width: np.array(some[:PIVOTS], dtype=np.float64) for width, some in by_width.items()}


def ranking(vectors: np.ndarray, pivots: np.ndarray, ranked: int) -> np.ndarray:
    """The nearest `ranked` pivots of each vector, nearest first; ties go to the earlier pivot."""
    far = (pivots**2).sum(axis=1) - 2.0 * vectors @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :ranked]


def entries(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies put together: different vectors, where each one's ids begin, and the ids, rising in an entry."""
    vectors = vectors + 0.0  # a negative zero is a zero
    odd = np.arange(1, 2 * vectors.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    mixed = (vectors.view(np.uint64) ^ (vectors.view(np.uint64) >> np.uint64(29))) * odd
    with np.errstate(over="ignore"):
        key = mixed.sum(axis=1, dtype=np.uint64)
    by = np.lexsort((ids, key))
    ids, vectors = ids[by], vectors[by]
    head = np.ones(len(ids), dtype=bool)
    head[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    once = head.copy()
    once[1:] |= ids[1:] != ids[:-1]
    start = np.flatnonzero(head[once])
    return vectors[head], np.append(start, once.sum()), ids[once]


class Block:
    """The inverted files of some rows of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, ranked: int) -> None:
        self.vectors, self.start, self.ids = entries(ids, vectors)
        self.ranked = min(ranked, len(pivots))
        order = ranking(self.vectors, pivots, self.ranked)
        pivot, rank = order.ravel(), np.tile(np.arange(self.ranked, dtype=np.int16), len(order))
        row = np.repeat(np.arange(len(order)), self.ranked)
        by = np.argsort(pivot, kind="stable")
        cut = np.searchsorted(pivot[by], np.arange(len(pivots) + 1))
        self.files = [(row[by[a:b]], rank[by[a:b]]) for a, b in zip(cut[:-1], cut[1:])]

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """The distance of every entry's ranking from a query's.

        Only the files of the query's pivots are read: what an entry ranks beyond them adds the same
        as those pivots being last for the query, which follows from the entry's total.
        """
        ranked = self.ranked
        # All as if nothing were shared, then each shared pivot corrects its two terms.
        total = np.full(len(self.vectors), ranked * (ranked + 1), dtype=np.int32)
        for place, pivot in enumerate(order.tolist()):
            row, rank = self.files[pivot]
            total[row] += np.abs(rank - np.int16(place)).astype(np.int32) - (ranked - place) - (ranked - rank)
        return total

    def candidates(self, order: np.ndarray, k: int, share: float) -> np.ndarray:
        """The entries nearest by footrule: those that are measured.  Without pivots all are."""
        count = len(self.vectors)
        wanted = max(LEAST * k, int(np.ceil(share * count)))
        if not self.ranked or wanted >= count:
            return np.arange(count)
        score = self.footrule(order).astype(np.int64) * count + np.arange(count)
        return np.argpartition(score, wanted - 1)[:wanted]

    def search(self, query: np.ndarray, order: np.ndarray, own: int, k: int, share: float = SHARE):
        """The k nearest rows but those of the id `own`, by Euclidean distance, ties to smaller ids."""
        some = self.candidates(order, k, share)
        gap = self.vectors[some] - query
        square = np.zeros(len(some))
        for column in (gap * gap).T:  # one after the other, as a plain loop adds them up
            square += column
        far = np.sqrt(square)
        # An entry's first id is its least but for `own`; entries that hold no other id are out.
        first, end = self.start[some], self.start[some + 1]
        first = first + (self.ids[first] == own)
        least = np.where(first < end, self.ids[np.minimum(first, len(self.ids) - 1)], np.iinfo(np.int64).max)
        best = np.lexsort((least, far, first >= end))[:k]
        rows = [self.ids[self.start[some[i]] : min(self.start[some[i]] + k + 1, self.start[some[i] + 1])] for i in best]
        ids = np.concatenate([np.zeros(0, np.int64), *rows])
        far = np.repeat(far[best], [len(r) for r in rows])
        ids, far = ids[ids != own], far[ids != own]
        best = np.lexsort((ids, far))[:k]
        return ids[best], far[best]


def _search(pivots: dict[int, np.ndarray], queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = {w: ranking(x, pivots[w], RANKED) if w in pivots else np.zeros((len(x), 0), int) for w, (_, x) in queries.items()}
        for batch in batches:
            column = batch.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            for width, (own_ids, asked) in queries.items():
                keep = np.flatnonzero(sizes == width)
                if not len(keep):
                    continue
                vectors = column.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
                ids = batch.column(0).to_numpy(zero_copy_only=False)[keep].astype(np.int64)
                block = Block(ids, vectors, pivots.get(width, np.zeros((0, width))), RANKED)
                out: list[tuple] = []
                for q, (own, query, order) in enumerate(zip(own_ids.tolist(), asked, ordered[width])):
                    found, far = block.search(query, order, own, k, share)
                    out.append((np.full(len(found), own), found, far))
                    if len(out) == QUERY_STEP or q == len(own_ids) - 1:
                        columns = [pa.array(np.concatenate([o[i] for o in out])) for i in range(3)]
                        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])
                        out = []

    return run


def _by_width(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    ids = table.column("vec_id").to_numpy()
    lists = table.column("vector").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = {}
    for width in np.unique(sizes).tolist():
        keep = np.flatnonzero(sizes == width)
        out[width] = ids[keep], lists.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def nearest(vectors: DataFrame, is_query, k: int = 10, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest k of all other rows for each query row.

    `vectors` has vec_id and embedding; `is_query` is a condition on vec_id.  Rows with a null id, or
    whose vector is null, empty, zero, or holds a null or non-finite component, take no part.  There
    is no distance between vectors of different lengths, so a query finds rows of its own length.
    Repeated rows of one id count once in a result, at their nearest; of a query id's different
    vectors the least, component by component, is asked.  Equal distances go to the smaller vec_id.
    Fewer candidates than k give fewer rows, an empty table none.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    pivots = choose_pivots(rows)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    size = asked.agg(F.sum(8 * F.size("vector")).alias("n")).first()["n"] or 0
    groups = max(1, -(-size // QUERY_BYTES))
    grouped = stored(asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups))))
    passes = Passes(spark, FOUND)
    for part in range(groups):
        own = grouped.where(F.col("part") == part).select("vec_id", "vector").orderBy("vec_id").toArrow()
        if own.num_rows:
            passes.add(rows.mapInArrow(_search(pivots, _by_width(own), k, share), FOUND))
    once = passes.all().groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
