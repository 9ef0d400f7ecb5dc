"""Streams: incremental append that resumes, windowed counts with a watermark, and first-seen rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState


def source(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """A table as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parque[t]")  # a pattern, as the table may be one file


def append(stream: DataFrame, folder: str) -> DataFrame:
    """What has come is written once, by the sink's log; run again with the same folder it goes on where it ended."""
    q = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def updated(stream: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """The newest row of each key. A batch writes the rows that it changed, in a folder by its number, which replaces them if it is run
    again; state that the watermark has left goes."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/result/batch={number}")

    q = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    spark, rest = stream.sparkSession, [c for c in stream.columns if c not in keys]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields), "batch long"])
    newest = spark.read.schema(schema).parquet(f"{folder}/result").groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_n"))
    return newest.select(*keys, *[F.col(f"_n.{c}").alias(c) for c in rest])


def hourly(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events of each hour and type; state older than the watermark goes."""
    at = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    n = at.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return n.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


#: Seconds after which a key that hasn't come again is forgotten.
REMEMBERED = 90 * 24 * 3600


def first_seen(stream: DataFrame, keys: list[str], id: str, at: str = "ts", late: str = "1 hour", remembered: int = REMEMBERED) -> DataFrame:
    """keys, id and duplicate_of: for each row the id of the first of its key, null for the first itself; a resumed stream remembers.

    State is one id for each key, and goes once the watermark has left the key's last row behind by remembered seconds: it is bounded
    by the keys of that time. Rows of a key in one batch count by time, then id."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(batches).sort_values(["_at", "_id"], kind="stable")
        first, last = state.get if state.exists else (int(rows["_id"].iloc[0]), 0)
        last = max(last, int(rows["_at"].max().timestamp() * 1000))
        state.update((first, last))
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + remembered * 1000 + 1)
        out = pd.DataFrame({k: rows[k].to_numpy() for k in keys})
        out[id] = rows["_id"].to_numpy()
        out["duplicate_of"] = pd.array([None if i == first else first for i in rows["_id"]], dtype="Int64")
        yield out

    kinds = ", ".join(f"`{k}` {stream.schema[k].dataType.simpleString()}" for k in keys)
    slim = stream.select(*keys, F.col(id).cast("long").alias("_id"), F.col(at).cast("timestamp").alias("_at")).withWatermark("_at", late)
    return slim.groupBy(*keys).applyInPandasWithState(run, f"{kinds}, `{id}` long, duplicate_of long", "first long, last long", "append", "EventTimeTimeout")
