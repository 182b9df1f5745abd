"""Streaming twins of the batch operators on the events table: tumbling windows, de-duplication, stateful runs.

Each run_* processes what is there (availableNow), writes to the shared folder and returns the written table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowmark.session import shared_dir, table


def source(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The table as a stream of files, times as UTC instants."""
    fixed = table(spark, sf_dir, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(fixed.schema)
    stream = reader.parquet(f"{sf_dir}/{name}.parquet") if fs.getFileStatus(folder).isDirectory() else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def finish(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a streaming query over all available input and read back its output."""
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = df.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def tumbling(events: DataFrame, minutes: int = 15, late: str = "7 days") -> DataFrame:
    """(slot_s, event_type, n, total) per tumbling window, final once the watermark has passed it."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.unix_seconds("window.start").alias("slot_s"), "event_type", "n", "total")


def partial_tumbling(events: DataFrame, minutes: int = 15) -> DataFrame:
    """Stateless partial sums per micro-batch row; they add up to the windows, with nothing late or dropped."""
    return events.select((F.floor(F.unix_seconds("ts") / (minutes * 60)) * minutes * 60).cast("bigint").alias("slot_s"), "event_type", "value")


def run_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finish(partial_tumbling(source(spark, sf_dir)))
    return rows.groupBy("slot_s", "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))


def run_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finish(source(spark, sf_dir).withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id"))
    return rows.agg(F.count("*").alias("n_events"), F.countDistinct("user_id").alias("n_users"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "7 days") -> DataFrame:
    """Session windows per user, the streaming twin of gaps and islands."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def run_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that the watermark has passed: (user_id, start_us, end_us, n)."""
    out = finish(sessions(source(spark, sf_dir)).select("user_id", "session_window.start", "session_window.end", "n"))
    return out.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


RUNS = "user_id bigint, events bigint, above bigint, longest bigint"


def _runs(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts per user that live across batches: events, values above 100, longest run of them so far."""
    n, above, run, longest = state.get if state.exists else (0, 0, 0, 0)
    rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
    hit = (rows["value"] > 100).to_numpy()
    place = np.arange(len(hit))
    length = place - np.maximum.accumulate(np.where(hit, -1 - run, place))  # of the run up to each event; the open run counts on
    n, above, run, longest = n + len(hit), above + int(hit.sum()), int(length[-1]), max(longest, int(length.max()))
    state.update((n, above, run, longest))
    yield pd.DataFrame({"user_id": [key[0]], "events": [n], "above": [above], "longest": [longest]})


def run_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir).where("user_id is not null").select("user_id", "ts", "event_id", "value").groupBy("user_id")
    out = rows.applyInPandasWithState(_runs, RUNS, "n bigint, above bigint, run bigint, longest bigint", "append", GroupStateTimeout.NoTimeout)
    return finish(out).groupBy("user_id").agg(F.max("events").alias("events"), F.max("above").alias("above"), F.max("longest").alias("longest"))
