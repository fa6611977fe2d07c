"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.llm.bytehash import release_tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Only a local session (tests) may leave it unset; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="echoloom-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage through files in the shared folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Tables that this process has written to the shared folder and not taken away again.
_WRITTEN: list[str] = []


def _new_table(spark: SparkSession) -> str:
    _WRITTEN.append(f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def stored(df: DataFrame) -> DataFrame:
    """As checkpointed, but written as compressed Parquet: for tables of more than a few MB."""
    spark = df.sparkSession
    path = _new_table(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark for `release`: how many tables there are by now."""
    return len(_WRITTEN)


def release(spark: SparkSession, mark: int, but: int = 0) -> None:
    """Deletes the tables written since `mark`, save the last `but`: for steps whose result is stored."""
    gone = _WRITTEN[mark : len(_WRITTEN) - but]
    _WRITTEN[mark : len(_WRITTEN) - but] = []
    for path in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Passes:
    """Rows of several jobs in one stored table, so that no plan holds more than one of the jobs."""

    def __init__(self, spark: SparkSession, schema: str) -> None:
        self.spark, self.schema, self.path = spark, schema, None

    def add(self, df: DataFrame) -> None:
        self.path = self.path or _new_table(self.spark)
        df.write.mode("append").option("compression", "zstd").parquet(self.path)

    def all(self) -> DataFrame:
        if self.path is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)


def give_back() -> None:
    """Returns memory to the system at the end of a task: workers live on, and idle ones count.

    The tables of powers go, which grow to the longest batch seen, and what the allocator holds free.
    """
    release_tables()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """The UTF-8 bytes in a text column: sizes partitions, never results."""
    row = docs.agg(F.sum(F.octet_length(column)).alias("n")).first()
    return int(row["n"] or 0)


def partitions(spark: SparkSession, size: int, per_task: int) -> int:
    """Enough partitions that a task gets about `per_task` bytes, and at least the session's number."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-size // per_task))
