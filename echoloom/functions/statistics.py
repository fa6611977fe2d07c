"""Statistics that Spark lacks: normal tails, false-discovery control, assignment."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def normal_upper_tail(z: pd.Series) -> pd.Series:
    """P(Z > z); a z that is missing or not finite gives 1."""
    return z.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2.0)) if v is not None and math.isfinite(v) else 1.0)


def _in_unit(p: str) -> Column:
    """p held within 0 and 1; a missing one is 1."""
    return F.when(F.col(p).isNull() | F.isnan(p), F.lit(1.0)).otherwise(F.least(F.greatest(F.col(p), F.lit(0.0)), F.lit(1.0)))


def _adjusted(keys: list[str]) -> Column:
    """The least __p * __m / __rank at or above a row's rank.  It runs down the ranks: a frame that ends
    with the partition would be gone through anew for each row."""
    above = Window.partitionBy(*keys).orderBy(F.desc("__rank")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.least(F.min(F.col("__p") * F.col("__m") / F.col("__rank")).over(above), F.lit(1.0))


def benjamini_hochberg(df: DataFrame, keys: list[str], p: str, q: str, ties: list[str]) -> DataFrame:
    """Adds q: the least p * m / rank among the ranks at or above a row's, within `keys`.

    Two running windows over one partitioning; `ties` makes the order total.  A key's rows are one task.
    """
    order = Window.partitionBy(*keys).orderBy("__p", *ties)
    ranked = df.withColumn("__p", _in_unit(p)).withColumn("__rank", F.row_number().over(order)).withColumn("__m", F.count("*").over(Window.partitionBy(*keys)))
    return ranked.withColumn(q, _adjusted(keys)).drop("__p", "__rank", "__m")


def benjamini_hochberg_by_value(df: DataFrame, keys: list[str], p: str, q: str) -> DataFrame:
    """The q of benjamini_hochberg for keys of many rows and fewer values of p; `df` is read twice.

    Rows of one p share the q of the last rank among them, so only the distinct values are ranked; a key's
    values are one task, its rows are not.
    """
    rows = df.withColumn("__p", _in_unit(p))
    values = rows.groupBy(*keys, "__p").agg(F.count("*").alias("__n"))
    upto = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("__rank", F.sum("__n").over(upto)).withColumn("__m", F.sum("__n").over(Window.partitionBy(*keys)))
    found = ranked.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)], F.col("__p").alias("__at"), _adjusted(keys).alias("__q"))
    same = F.col("__p") == F.col("__at")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__key{i}"))
    return rows.join(found, same).withColumn(q, F.col("__q")).drop("__p", "__at", "__q", *[f"__key{i}" for i in range(len(keys))])


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def best_assignment(benefit: np.ndarray) -> list[int]:
    """For each row the column that it takes, or -1: the sum of positive benefits is largest.

    Successive shortest augmenting paths with potentials.  A row may stay alone at benefit 0; entries
    of -inf cannot be taken.  Rows and columns are tried in order, so that ties fall the same way.
    """
    rows, columns = benefit.shape
    wide = np.full((rows, columns + rows), -np.inf)
    wide[:, :columns] = np.where(benefit >= 0, benefit, -np.inf)
    wide[np.arange(rows), columns + np.arange(rows)] = 0.0
    cost = -wide
    total = columns + rows
    over_row, over_column = np.zeros(rows), np.zeros(total)
    taken = np.full(total, -1)
    for start in range(rows):
        far = np.full(total, np.inf)
        via = np.full(total, -1)
        done = np.zeros(total, dtype=bool)
        row, best = start, 0.0
        end = -1
        while end < 0:
            with np.errstate(invalid="ignore"):
                step = best + cost[row] - over_row[row] - over_column
            better = ~done & (step < far - 1e-15)
            far[better], via[better] = step[better], row
            column = int(np.argmin(np.where(done, np.inf, far)))
            done[column], best = True, far[column]
            if taken[column] < 0:
                end = column
            else:
                row = taken[column]
        reached = np.flatnonzero(done)
        for column in reached:
            if taken[column] >= 0:
                over_row[taken[column]] += best - far[column]
        over_row[start] += best
        over_column[reached] -= best - far[reached]
        while end >= 0:
            row = via[end]
            before = np.flatnonzero(taken == row)
            taken[end] = row
            if row == start:
                break
            end = int(before[before != end][0])
    out = [-1] * rows
    for column in range(columns):
        if taken[column] >= 0:
            out[taken[column]] = column
    return out
