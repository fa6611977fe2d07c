"""Connected components of a link table, distributed.

Alternating large-star and small-star rounds: every round points nodes at smaller neighbours, so
that a component ends as a star around its smallest node.  Node minima are partial aggregates and
the joins can be split on hot nodes, so that no neighbourhood is ever gathered in one task.  Links
that one task holds are first thinned to a spanning forest there; once no more than THIN_LINKS are
left, which one task holds in bounded memory, that thinning is the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.common import checkpointed


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        path, parent = [], self.parent
        while (up := parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            parent[y] = x
        return x

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.parent[b] = a
        return True


#: Links thinned at a time: bounds a task's memory.
THIN_LINKS = 250_000


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, seen, names = Forest(), 0, None

    def out() -> pa.RecordBatch:
        pairs = [(x, forest.find(x)) for x in list(forest.parent)]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)], names=names)

    for batch in batches:
        names, kind = batch.schema.names, batch.schema.types[0]
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.union(a, b)
        seen += batch.num_rows
        if seen >= THIN_LINKS:
            yield out()
            forest, seen = Forest(), 0
    if seen:
        yield out()


def smallest_reachable(links: DataFrame, rounds: int = 60) -> DataFrame:
    """For links (a, b): a row (node, root) for each linked node, root being its component's smallest.

    Links to oneself and repeated links are harmless; links with a null end are dropped.
    """
    kind = dict(links.dtypes)["a"]
    edges = links.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = checkpointed(edges.mapInArrow(_thin, f"a {kind}, b {kind}").distinct())
    before = None
    for _ in range(rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] <= THIN_LINKS:
            edges = edges.coalesce(1).mapInArrow(_thin, f"a {kind}, b {kind}").where("a <> b")
            break
        if now == before:
            break
        before = now
        # Large star: each node's larger neighbours point at its smallest neighbour or itself.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: each node's smaller neighbours, and itself, point at the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        inner = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(inner.union(least.select("a", F.col("m").alias("b"))).distinct())
    else:
        raise RuntimeError("the components have not settled")
    return checkpointed(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct()))
