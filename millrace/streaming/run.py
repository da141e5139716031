"""Running a stream over a bounded input until it is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Seconds after which a stream over a bounded input counts as stuck.
PATIENCE_S = 3600


def _set(spark: SparkSession, key: str, value: str | None) -> None:
    if value is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, value)


def drain(stream: DataFrame, checkpoint: str, to: str | None = None, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append", name: str | None = None) -> None:
    """Run ``stream`` to the end of its input: into Parquet files at ``to``, or batch by batch through ``each``. State is kept in RocksDB."""
    spark, before = stream.sparkSession, stream.sparkSession.conf.get(STATE_STORE, None)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.queryName(name) if name else writer
    _set(spark, STATE_STORE, ROCKS)
    try:
        query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(to)
        if not query.awaitTermination(PATIENCE_S):
            query.stop()
            raise TimeoutError(f"a stream over a bounded input ran for more than {PATIENCE_S} s")
    finally:
        _set(spark, STATE_STORE, before)
