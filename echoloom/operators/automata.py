"""Order-dependent operators: machines that are fed the sorted rows of one key after the other.

The rows of many keys stand in one Arrow batch, so that a key costs no call and no frame of its own;
a machine lives on from batch to batch.  What can be said in columns afterwards is left to Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Records that are held before a batch is sent on.
RECORDS = 8192


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def run_machines(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], start: Callable, schema: str) -> DataFrame:
    """`start(row)` makes a key's machine from its first row; `day(row)` and `end()` give tuples of `schema`.

    A row is a tuple of the key and `columns`.  One shuffle by key; keys are bounded by nature (the days
    of a season), their number is not.
    """
    arranged = rows.select(key, *columns).repartition(key).sortWithinPartitions(key, *order)
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def batch_of(records: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*records), kind)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, now, held = None, object(), []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != now:
                    if machine is not None:
                        held += machine.end()
                    machine, now = start(row), row[0]
                held += machine.day(row)
                if len(held) >= RECORDS:
                    yield batch_of(held)
                    held = []
        if machine is not None:
            held += machine.end()
        if held:
            yield batch_of(held)

    return arranged.mapInArrow(run, schema)
