"""Structured Streaming intake: survey rows as they arrive, each participant once, moderated into the run folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, folder: str, schema: str, files: int = 50) -> DataFrame:
    """Rows of Parquet files as they arrive in a folder, at most ``files`` a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def first_answers(rows: DataFrame, key: str = "participant_id", at: str = "answered_at", late: str = "1 day") -> DataFrame:
    """One row a participant within the watermark; the state of older ones is let go."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def answers_by_window(rows: DataFrame, at: str = "answered_at", late: str = "10 minutes", window: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Answers and their mean length by topic and time window (tumbling, or sliding with ``slide``)."""
    span = F.window(at, window, slide) if slide else F.window(at, window)
    return rows.withWatermark(at, late).groupBy(span.alias("window"), "topic").agg(F.count("*").alias("answers"), F.avg(F.length("response_text")).alias("mean_length"))


def into_run(rows: DataFrame, root: str, step: Callable[[DataFrame], DataFrame], name: str = "statements"):
    """Each batch through ``step`` (an inference step, say) into a table of the run folder; a batch that comes again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/_stream_{name}").trigger(availableNow=True).start()
