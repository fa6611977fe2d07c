"""All registered queries of the engine and their SQL twins, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from echoloom.plans import evidence, incident_view, learning, monitoring, relational, replay, serving, viewer

QUERIES: dict = {**monitoring.QUERIES, **evidence.QUERIES, **relational.QUERIES, **viewer.QUERIES, **serving.QUERIES, **replay.QUERIES, **learning.QUERIES, **incident_view.QUERIES}
ORACLES: dict[str, str] = {**monitoring.ORACLES, **evidence.ORACLES, **relational.ORACLES, **viewer.ORACLES, **serving.ORACLES, **replay.ORACLES, **learning.ORACLES, **incident_view.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.significant_cells(spark, sf_dir)
