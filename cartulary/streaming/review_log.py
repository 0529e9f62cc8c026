"""Streams over append-only artefacts: the review log's latest states, and folders that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartulary.operators.review import status_of


def latest_states(events: DataFrame) -> DataFrame:
    """The latest event of each qa_id by (ts, event_id): for update mode. State is a row for each qa_id."""
    last = events.groupBy("qa_id").agg(F.max(F.struct("ts", "event_id", "action")).alias("e"))
    return last.select("qa_id", "e.event_id", "e.action", status_of(F.col("e.action")).alias("review_status"))


def windowed_actions(events: DataFrame, *, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Actions by window of event time, with a bound on lateness that also bounds the state."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "action").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "action", "n")


def ingest_new_files(spark: SparkSession, path: str, out: str, checkpoint: str, *, schema: str, key: str, per_trigger: int = 100) -> StreamingQuery:
    """Rows of files that are new in a folder, those whose key is already in `out` left out, appended batch by batch."""

    def merge(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([key])
        try:
            have = batch.sparkSession.read.parquet(out).select(key)
        except Exception as e:  # the first batch: there is no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        else:
            fresh = fresh.join(have, key, "left_anti")
        fresh.write.mode("append").parquet(out)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
