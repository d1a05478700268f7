"""Structured Streaming jobs that follow run folders as they fill.

Late data: events older than the watermark are dropped by the state of sessions and of joined flags, which ends there; counts have
no watermark and take all. Every job's result equals that of a batch query over the same events, which is how they are tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.sources.files import scratch

GAP, LATE = "6 hours", "2 days"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/event[s].parquet"  # a pattern: the stream source takes a file for a folder otherwise
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    return stream.select(F.col("user_id").alias("run"), F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("ord"))


STORE = "spark.sql.streaming.stateStore.providerClass"


def drained(stream: DataFrame, mode: str, provider: str | None = None, where: str | None = None) -> DataFrame:
    """All that is there now, through the stream: batches are written as tables; in complete mode the last one counts.

    `provider`: the class of the state's store, where not the session's. `where`: a folder with state and batches of an earlier
    call, from which this one goes on; only its own batches count then.
    """
    conf, where = stream.sparkSession.conf, where or scratch(stream.sparkSession)
    before = conf.get(STORE, None)
    seen: list[int] = []

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{where}/out/{n:09d}")
        seen.append(n)

    if provider:
        conf.set(STORE, provider)
    try:
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    finally:
        if provider:
            conf.set(STORE, before) if before else conf.unset(STORE)
    if not seen:
        return stream.sparkSession.createDataFrame([], stream.schema)
    paths = [f"{where}/out/{n:09d}" for n in (seen if mode == "append" else seen[-1:])]
    return stream.sparkSession.read.schema(stream.schema).parquet(*paths)


def completed_runs(events: DataFrame, gap: str = GAP) -> DataFrame:
    """run, first, last, n: a run's files until none came for `gap`; two at exactly that distance are two sessions.

    In append mode a session comes out, and its state goes, once the latest event is `gap` and LATE past its last file.
    """
    kept = events.withWatermark("ts", LATE)
    sessions = kept.groupBy("run", F.session_window("ts", gap)).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))
    return sessions.select("run", "first", "last", "n")


def new_work(flags: DataFrame, markers: DataFrame, near: str = GAP, late: str = LATE) -> DataFrame:
    """run, flagged: the `flags(run, ts)` without one of the `markers(run, ts)`, of errors or of finished work, within `near` of them on either side.

    Two streams are joined, so that markers may come before or after their flags, and in any order: a flag waits in the state
    until the watermarks, `late` behind the latest event of each stream, show that no marker can come, and comes out then.
    """
    flagged = flags.withWatermark("ts", late).select("run", F.col("ts").alias("flagged"))
    marked = markers.withWatermark("ts", late).select(F.col("run").alias("_run"), F.col("ts").alias("marked"))
    both = F.expr(f"run = _run AND marked BETWEEN flagged - INTERVAL {near} AND flagged + INTERVAL {near}")
    return flagged.join(marked, both, "left_outer").filter("marked IS NULL").select("run", "flagged")


def folder_counts(events: DataFrame) -> DataFrame:
    """run, n, complete: whether events of both ends of a folder's work came."""
    return events.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("kind") == "purchase").alias("complete"))


def kind_counts(events: DataFrame) -> DataFrame:
    """kind, n: counts add up over arriving files as they do over a table."""
    return events.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))

