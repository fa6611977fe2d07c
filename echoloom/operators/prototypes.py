"""Frozen prototype models: robust scaling, open-set assignment, overlap, and stability."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def robust_schema(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Median and interquartile range of each feature; a range near zero counts as one."""
    aggs = []
    for c in features:
        q = [F.percentile(c, F.lit(p)) for p in (0.25, 0.5, 0.75)]
        aggs += [q[1].alias(f"{c}_center"), F.when(q[2] - q[0] < 1e-9, 1.0).otherwise(q[2] - q[0]).alias(f"{c}_scale")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def scaled(df: DataFrame, schema: DataFrame, features: Sequence[str], by: Sequence[str] = (), clip: float = 5.0) -> DataFrame:
    """Features as centred, scaled and clipped numbers; a missing value stands at the median."""
    joined = df.join(F.broadcast(schema), list(by)) if by else df.crossJoin(F.broadcast(schema))  # a row for each group
    cells = {c: F.greatest(F.lit(-clip), F.least(F.lit(clip), F.coalesce((F.col(c) - F.col(f"{c}_center")) / F.col(f"{c}_scale"), F.lit(0.0)))) for c in features}
    return joined.withColumns(cells).drop(*[f"{c}{s}" for c in features for s in ("_center", "_scale")])


def distance(features: Sequence[str], suffix: str):
    total = F.lit(0.0)
    for c in features:
        total = total + (F.col(c) - F.col(f"{c}{suffix}")) * (F.col(c) - F.col(f"{c}{suffix}"))
    return F.sqrt(total)


def fit_prototypes(df: DataFrame, features: Sequence[str], by: Sequence[str], label: str, quantile: float = 0.95) -> DataFrame:
    """A centre of medians for each label within its group, with the radius that holds most members."""
    keys = [*by, label]
    centres = df.groupBy(*keys).agg(*[F.percentile(c, F.lit(0.5)).alias(f"{c}_proto") for c in features], F.count("*").alias("member_count"))
    gap = df.join(F.broadcast(centres), keys).withColumn("__d", distance(features, "_proto"))
    return centres.join(gap.groupBy(*keys).agg(F.percentile("__d", F.lit(quantile)).alias("radius")), keys)


def assign(df: DataFrame, prototypes: DataFrame, features: Sequence[str], by: Sequence[str], label: str, key: Sequence[str], margin: float = 0.05) -> DataFrame:
    """The nearest prototype within the group; accepted within its radius and clearly nearer than the next.

    Prototypes are broadcast (a model is some hundred rows); a row meets those of its own group only.
    """
    pairs = df.join(F.broadcast(prototypes.withColumnRenamed(label, "prototype")), list(by)).withColumn("distance", distance(features, "_proto"))
    order = Window.partitionBy(*key).orderBy("distance", "prototype")
    ranked = pairs.withColumn("__n", F.row_number().over(order)).withColumn("runner_up", F.lead("distance").over(order)).where("__n = 1")
    gap = F.when(F.col("runner_up") > 0, (F.col("runner_up") - F.col("distance")) / F.col("runner_up"))
    accepted = (F.col("distance") <= F.col("radius")) & F.coalesce(gap >= margin, F.lit(True))
    return ranked.select(*key, "prototype", "distance", gap.alias("margin"), accepted.alias("accepted"), F.when(accepted, F.col("prototype")).otherwise(F.lit("novel")).alias("assignment"))


def prototype_overlap(prototypes: DataFrame, features: Sequence[str], by: Sequence[str], label: str) -> DataFrame:
    """(radius + radius) / distance of every pair of prototypes in a group."""
    a = prototypes.select(*by, F.col(label).alias("left"), F.col("radius").alias("left_radius"), *[F.col(f"{c}_proto").alias(c) for c in features])
    b = prototypes.select(*by, F.col(label).alias("right"), F.col("radius").alias("right_radius"), *[F.col(f"{c}_proto").alias(f"{c}_other") for c in features])
    pairs = a.join(b, list(by)).where("left < right").withColumn("distance", distance(features, "_other"))
    return pairs.select(*by, "left", "right", "distance", F.try_divide(F.col("left_radius") + F.col("right_radius"), F.col("distance")).alias("overlap"))


def adjusted_rand(df: DataFrame, left: str, right: str) -> DataFrame:
    """Agreement of two labellings, from their contingency table; one row."""
    cells = df.groupBy(left, right).agg(F.count("*").cast("double").alias("n"))

    def pairs(column):
        return F.sum(column * (column - 1) / 2)

    both = cells.agg(pairs(F.col("n")).alias("both"), F.sum("n").alias("total"))
    rows = cells.groupBy(left).agg(F.sum("n").alias("n")).agg(pairs(F.col("n")).alias("a"))
    columns = cells.groupBy(right).agg(F.sum("n").alias("n")).agg(pairs(F.col("n")).alias("b"))
    one = both.crossJoin(rows).crossJoin(columns)  # a row each
    expected = F.col("a") * F.col("b") / (F.col("total") * (F.col("total") - 1) / 2)
    most = (F.col("a") + F.col("b")) / 2
    return one.select(F.when(most == expected, 1.0).otherwise((F.col("both") - expected) / (most - expected)).alias("ari"))


def temporal_split(df: DataFrame, group: str, day: str, train_until: str, test_from: str) -> DataFrame:
    """Train, test or embargo; a purge group goes as its earliest part goes, the rest is embargoed."""
    own = F.when(F.col(day) <= F.lit(train_until).cast("date"), "train").when(F.col(day) >= F.lit(test_from).cast("date"), "test").otherwise("embargo")
    out = df.withColumn("__own", own)
    first = F.first("__own").over(Window.partitionBy(group).orderBy(day, "__own"))
    return out.withColumn("split", F.when(F.col("__own") == first, F.col("__own")).otherwise("embargo")).drop("__own")


def density_clusters(points: np.ndarray, least: int, samples: int) -> np.ndarray:
    """Density clusters of some points: single linkage of mutual reachability, the most stable cuts.

    Labels from 0; -1 is noise.  For a bounded training sample of one group.
    """
    n = len(points)
    labels = np.full(n, -1)
    if n < max(2, least):
        return labels
    gap = np.sqrt(np.maximum(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1), 0))
    core = np.sort(gap, axis=1)[:, min(samples, n - 1)]
    reach = np.maximum(gap, np.maximum(core[:, None], core[None, :]))
    # The minimum spanning tree, then its edges by weight: a merge tree.
    best, via = reach[0].copy(), np.zeros(n, dtype=int)
    inside = np.zeros(n, dtype=bool)
    inside[0] = True
    edges = []
    for _ in range(n - 1):
        j = int(np.argmin(np.where(inside, np.inf, best)))
        edges.append((best[j], via[j], j))
        inside[j] = True
        nearer = reach[j] < best
        best[nearer], via[nearer] = reach[j][nearer], j
    members: dict[int, list[int]] = {i: [i] for i in range(n)}
    top = list(range(n))
    merges = []  # (node, weight, left, right)
    for weight, a, b in sorted(edges):
        a, b = top[a], top[b]
        node = n + len(merges)
        merges.append((node, weight, a, b))
        members[node] = members[a] + members[b]
        for i in members[node]:
            top[i] = node
    children = {node: (weight, a, b) for node, weight, a, b in merges}

    def visit(node: int, born: float):
        """(stability, chosen clusters) below a node that became a cluster at density `born`."""
        stability, at = 0.0, node
        while True:
            weight, a, b = children.get(at, (0.0, None, None))
            density = 1.0 / weight if weight > 0 else 1e12
            stability += 0.0
            if a is None:
                return stability, [node]
            big = [c for c in (a, b) if len(members[c]) >= least]
            if len(big) == 1:
                lost = len(members[at]) - len(members[big[0]])
                stability += lost * (density - born)
                at = big[0]
                continue
            stability += len(members[at]) * (density - born)
            if not big:
                return stability, [node]
            below = [visit(c, density) for c in big]
            total = sum(s for s, _ in below)
            return (stability, [node]) if stability >= total else (total, [c for _, some in below for c in some])

    root = merges[-1][0]
    weight, a, b = children[root]
    chosen = visit(root, 0.0)[1]
    if chosen == [root]:
        big = [c for c in (a, b) if len(members[c]) >= least]
        chosen = [c for node in big for c in visit(node, 1.0 / weight if weight > 0 else 1e12)[1]] if len(big) > 1 else []
    for k, node in enumerate(chosen):
        labels[members[node]] = k
    return labels
