"""The streaming path: the batch operators' own functions over Structured Streaming."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from echoloom.operators.signals import Policy
from echoloom.operators.stories import _NAMES, CORE, READ, InstanceMonitor, Story, finished


def weekly_activity(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Counts by Monday week and type; a week is final once the watermark has passed it."""
    weeks = F.window(F.col("ts").cast("timestamp"), "7 days", startTime="4 days")  # the epoch was a Thursday
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counts = timed.groupBy(weeks.alias("w"), "event_type").agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"))
    return counts.select(F.to_date("w.start").alias("timeline_bucket"), "event_type", "n", "users")


def user_sessions(events: DataFrame, gap: str = "3 days", late: str = "2 days") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    spans = timed.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n"))
    return spans.select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def story_stream(signals: DataFrame, policy: Policy = Policy(), quiet: str = "45 days") -> DataFrame:
    """Daily story records as causal signals arrive.

    The state of a crop instance is its machine, the same that the batch path runs, and a count of the
    days that came at or before the last one taken: they change nothing, but are told of in a record of
    the state "LATE_DAYS" (a member of no event, their number in reportable_day_count).  With a watermark
    on `ts`, a machine that heard nothing for `quiet` of event time is given up.
    """
    timed = signals.withColumn("ts", F.col("observation_date").cast("timestamp")).withWatermark("ts", "7 days").withColumn("next_start", F.lit(None).cast("date"))

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values("observation_date", kind="mergesort")[["crop_instance_id", *READ]]
        rows = list(rows.astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
        machine, late = pickle.loads(state.get[0]) if state.exists else (InstanceMonitor(rows[0], policy), 0)
        out: list[tuple] = []
        missed = 0
        for row in rows:
            if machine.before is None or row[4] > machine.before:
                out += machine.day(row)
            else:
                missed += 1
        if missed:
            late += missed
            out.append(machine.record(Story("none", machine.before, "LATE_DAYS", False), machine.before)[:11] + (late,) + (0, False, "no_new_event_response", None, None, machine.before, None, "unknown", "spectral_missing", None, False))
        state.update((pickle.dumps((machine, late)),))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(pd.Timestamp(machine.before).timestamp() * 1000)) + int(pd.Timedelta(quiet).total_seconds() * 1000))
        yield pd.DataFrame(out, columns=_NAMES)

    records = timed.groupBy("crop_instance_id").applyInPandasWithState(step, CORE, "machine binary", "append", GroupStateTimeout.EventTimeTimeout)
    return finished(records, policy)


def sliding_activity(events: DataFrame, length: str = "7 days", slide: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by type in windows that overlap: a week up to each day."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counts = timed.groupBy(F.window("ts", length, slide).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n")


def publish_increments(stream: DataFrame, root: str, checkpoint: str, keys: list[str]):
    """Appends each micro-batch once to a Parquet table by its batch number: a batch that is run again replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
