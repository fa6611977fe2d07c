"""Putting sources together: part files, aliases, enrichment, and hash partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from echoloom.operators.temporal import latest


def read_parts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Part files by column name; a column that some of them lack is null there."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def assembled(parts: Sequence[DataFrame]) -> DataFrame:
    """Frames on end by column name, as read_parts does files."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def with_partition(df: DataFrame, key: str, count: int) -> DataFrame:
    """The part of `count` that a key belongs to, the same wherever and whenever it is computed."""
    return df.withColumn("part", F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(count)).cast("int"))


def write_partitioned(df: DataFrame, path: str, key: str, count: int, order: Sequence[str]) -> None:
    """One folder a part, sorted inside, so that readers of a key open one part and skip row groups."""
    with_partition(df, key, count).repartition(count, "part").sortWithinPartitions("part", *order).write.partitionBy("part").option("compression", "zstd").parquet(path)


def renamed(df: DataFrame, aliases: Mapping[str, Sequence[str]], needed: Sequence[str]) -> DataFrame:
    """Columns under their canonical names, whichever alias they came by; a needed one that is missing is an error."""
    def plain(name: str) -> str:
        return "".join(c if c.isalnum() else "_" for c in name.strip().lower()).strip("_")

    have = {plain(c): c for c in df.columns}
    out = []
    for name, others in aliases.items():
        found = next((have[plain(c)] for c in (name, *others) if plain(c) in have), None)
        if found is None and name in needed:
            raise ValueError(f"no column for {name}")
        out.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def latest_rows(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """One row a key: the newest, and of equals the one of the least content."""
    rest = sorted(set(df.columns) - set(keys) - {newest})
    return latest(df, keys, [F.desc_nulls_last(newest), *[F.asc_nulls_last(F.col(c).cast("string")) for c in rest]])


def enriched(deliverable: DataFrame, rich: DataFrame, quality: DataFrame, keys: Sequence[str], shared: Sequence[str]) -> DataFrame:
    """The deliverable's days with what a richer source and the acquisitions' quality say of them.

    `shared` columns are the deliverable's where it has a value.  Weather and stage count as available on
    their day (strict) unless the rich source says when; a spectral value, on the first day on which its
    source date stands in any row of the field (reconstructed).
    """
    other = rich.select(*keys, *[F.col(c).alias(f"_rich_{c}") for c in shared], *[c for c in rich.columns if c not in (*keys, *shared)])
    out = deliverable.join(other, list(keys), "left")
    out = out.withColumns({c: F.coalesce(c, f"_rich_{c}") for c in shared}).drop(*[f"_rich_{c}" for c in shared])
    first = out.where("spectral_source_date is not null").groupBy("field_id", "spectral_source_date").agg(F.min("observation_date").alias("spectral_available_at"))
    out = out.join(first, ["field_id", "spectral_source_date"], "left").join(quality, ["field_id", "spectral_source_date"], "left")
    clocks = {c: (F.coalesce(F.col(c), F.col("observation_date")) if c in out.columns else F.col("observation_date")) for c in ("weather_available_at", "stage_available_at")}
    return out.withColumns(clocks)


