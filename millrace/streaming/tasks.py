"""Task states from a stream of status records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.status import TERMINAL


def latest_states(records: DataFrame, task: str = "task_id", ts: str = "ts", tie: str = "seq", state: str = "state", late: str = "1 hour") -> DataFrame:
    """The last state of each task of a stream (update or complete mode). Records later than ``late`` may be dropped."""
    return (
        records.withWatermark(ts, late)
        .groupBy(task)
        .agg(F.max_by(state, F.struct(ts, tie)).alias("state"), F.count(F.lit(1)).alias("n_records"), F.max(ts).alias("last_ts"))
        .withColumn("is_terminal", F.col("state").isin(*TERMINAL))
    )


def state_counts(records: DataFrame, ts: str = "ts", state: str = "state", window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Records of each state in tumbling windows; append mode emits a window once the watermark has passed it."""
    counted = records.withWatermark(ts, late).groupBy(F.window(ts, window), state).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), state, "n")
