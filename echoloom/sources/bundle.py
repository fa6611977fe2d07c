"""Immutable releases: Parquet artifacts written aside, then renamed into place, with a manifest."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def content_hash(df: DataFrame) -> str:
    """An order-free hash of all rows: a sum of row hashes and the count, one aggregate."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(df.columns)]
    row = F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *cells), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(row), F.lit(0))).first()
    return hashlib.sha256(f"{n}:{total}".encode()).hexdigest()


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], policy: dict, partition_by: dict[str, list[str]] | None = None) -> dict:
    """Writes a release; fails if it is there already; nothing is seen of it until all is written."""
    target, fs = _path(spark, root)
    if fs.exists(target):
        raise FileExistsError(root)
    aside = f"{root.rstrip('/')}.part-{uuid.uuid4().hex}"
    manifest: dict = {"policy": policy, "tables": {}}
    for name, df in sorted(tables.items()):
        df.write.partitionBy(*(partition_by or {}).get(name, [])).option("compression", "zstd").parquet(f"{aside}/{name}.parquet")
        written = spark.read.schema(df.schema).parquet(f"{aside}/{name}.parquet")
        manifest["tables"][name] = {"rows": written.count(), "sha256": content_hash(written), "columns": sorted(df.columns)}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{aside}/manifest")
    if not fs.rename(_path(spark, aside)[0], target):
        raise OSError(f"{aside} cannot be renamed to {root}")
    return manifest


def manifest_of(spark: SparkSession, root: str) -> dict:
    return json.loads(spark.read.text(f"{root}/manifest").first()[0])


def verify(spark: SparkSession, root: str) -> list[str]:
    """The names of tables that differ from the manifest."""
    known = manifest_of(spark, root)["tables"]
    return [name for name, facts in sorted(known.items()) if content_hash(spark.read.parquet(f"{root}/{name}.parquet")) != facts["sha256"]]
