"""Streaming intake: batches that arrive as files are merged as they come, with the newest non-null value per cell.

The state is a run of latest versions per cell, kept as a Parquet folder per round in the shared folder. A round merges its
rows into the last state and writes the next; a repeated round overwrites the same folder, so a restart changes nothing. A
state that is missing or unfinished where one must be is an error, never an empty start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CELL = ["table_name", "entity", "code", "year"]
SCHEMA = "batch string, seq long, table_name string, entity string, code string, year int, value double"


def latest(rows: DataFrame) -> DataFrame:
    """Per cell the non-null value of the highest seq; of equal ones the later batch name."""
    top = rows.where("value IS NOT NULL").groupBy(*CELL).agg(F.max(F.struct("seq", "batch", "value")).alias("t"))
    return top.select("t.batch", "t.seq", *CELL, "t.value")


def merge_round(rows: DataFrame, round_no: int, state: str, every: int = 1) -> None:
    """Merge one round into the state of the round before."""
    spark = rows.sparkSession
    before = _state(spark, state, round_no - every)
    if before is None and round_no - every >= 0:
        raise ValueError(f"round {round_no} needs the finished state of round {round_no - every} in {state}")
    both = rows.unionByName(before) if before is not None else rows
    latest(both).write.mode("overwrite").parquet(f"{state}/round={round_no}")


def _state(spark: SparkSession, state: str, round_no: int) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/round={round_no}/_SUCCESS")
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.parquet(f"{state}/round={round_no}") if there else None


def follow(spark: SparkSession, folder: str, state: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """A query that merges Parquet files as they appear in `folder`; with `once` it takes what is there and ends."""
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, n: merge_round(rows, n, state))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def current(spark: SparkSession, state: str) -> DataFrame:
    """The state of the last finished round; an error if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(state)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    rounds = sorted((int(p.getPath().getName().split("=")[1]) for p in found if p.getPath().getName().startswith("round=")), reverse=True)
    done = next((r for r in (_state(spark, state, n) for n in rounds) if r is not None), None)
    if done is None:
        raise ValueError(f"no finished round in {state}")
    return done


def windowed_counts(stream: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events per type and window of event time with a watermark for late ones; works on streams and tables alike."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("events"))
