"""Joins on time that Spark has no operator for, and checked joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, take: Sequence[str], how: str = "left") -> DataFrame:
    """For each left row the latest right row at or before its time, by key.

    Both sides are merged in one sorted pass (a union and a running `last`), so that no pair of rows
    is ever formed; one shuffle by key.  Of right rows at one time the largest `take` values count.
    """
    packed = F.struct(F.col(right_time).alias(right_time), *[F.col(c).alias(c) for c in take if c != right_time])
    events = right.where(F.col(right_time).isNotNull()).select(*by, F.col(right_time).alias("__t"), packed.alias("__r"), F.lit(0).alias("__side"))
    own = left.select(*by, F.col(left_time).alias("__t"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"))
    merged = events.unionByName(own, allowMissingColumns=True)
    order = Window.partitionBy(*by).orderBy("__t", "__side", "__r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = merged.withColumn("__r", F.last("__r", ignorenulls=True).over(order)).where("__side = 1")
    if how == "inner":
        held = held.where("__r is not null")
    return held.select("__l.*", *[F.col(f"__r.{c}").alias(c if c not in left.columns else f"right_{c}") for c in take])


def latest(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given total order."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__n", rank).where("__n = 1").drop("__n")


def known_by(df: DataFrame, by: Sequence[str], effective: str, knowledge: str, decision: Column) -> DataFrame:
    """The latest row of each key by effective date among those known at the decision time."""
    return latest(df.where(F.col(knowledge) <= decision), by, [F.desc(effective), F.desc(knowledge)])


def week_interval_join(left: DataFrame, right: DataFrame, by: Sequence[str], day: str, week: str) -> DataFrame:
    """`day` between `week` and six days on: an equality once the day's Monday is known."""
    dated = left.withColumn(week, F.date_trunc("week", F.col(day)).cast("date"))
    return dated.join(right, [*by, week])


def near_cells(rows: DataFrame, cells: DataFrame, keys: Sequence[str], x: str, y: str, reach: int) -> DataFrame:
    """Rows whose cell is within `reach` (Chebyshev) of any of `cells`.

    Each cell names its neighbours, a fixed number, which makes an equality semi-join.
    """
    around = F.array(*[F.lit(k) for k in range(-reach, reach + 1)])
    marked = cells.withColumn("__i", F.explode(around)).withColumn("__j", F.explode(around))
    marked = marked.select(*keys, (F.col(x) + F.col("__i")).alias(x), (F.col(y) + F.col("__j")).alias(y)).distinct()
    return rows.join(marked, [*keys, x, y], "left_semi")


def unique_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """A join that fails if `right` has two rows of one key."""
    count = Window.partitionBy(*on)
    message = F.concat(F.lit("repeated key: "), F.to_json(F.struct(*on)))
    sole = right.withColumn("__n", F.count("*").over(count)).withColumn("__ok", F.when(F.col("__n") > 1, F.raise_error(message)).otherwise(F.lit(True)))
    return left.join(sole.where("__ok").drop("__n", "__ok"), list(on), how)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def appended(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a release that may only append did to old rows: removed or rewritten, by key.

    Whole rows are compared by hash, nulls included, so that one join on the keys is enough.
    """
    columns = sorted(set(old.columns) - set(keys))

    def digest(df: DataFrame, name: str) -> DataFrame:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
        return df.select(*keys, F.sha2(F.concat_ws("\x1f", *cells), 256).alias(name))

    both = digest(old, "__old").join(digest(new, "__new"), list(keys), "left")
    status = F.when(F.col("__new").isNull(), "removed").when(F.col("__new") != F.col("__old"), "rewritten")
    return both.withColumn("status", status).where("status is not null").select(*keys, "status")
