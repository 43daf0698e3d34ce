"""Streaming intake over files that have arrived."""

from pyspark.sql import functions as F

from plenum.session import work_dir
from plenum.streaming import intake

SCHEMA = "participant_id bigint, topic string, response_text string, answered_at timestamp"


def test_each_participant_once(spark, tmp_path):
    folder, root = str(tmp_path / "in"), work_dir(spark)
    rows = spark.range(20).select((F.col("id") % 7).alias("participant_id"), F.lit("t").alias("topic"), F.lit("four").alias("response_text"), F.timestamp_seconds(F.col("id") * 60).alias("answered_at"))
    rows.repartition(3).write.parquet(folder)
    stream = intake.first_answers(intake.arriving(spark, folder, SCHEMA))
    q = intake.into_run(stream, root, lambda df: df.withColumn("seen", F.lit(True)))
    q.awaitTermination(60)
    got = spark.read.parquet(f"{root}/statements")
    assert got.count() == 7 and got.where("seen").select("participant_id").distinct().count() == 7


def test_windows(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(20).select(F.col("id").alias("participant_id"), F.lit("t").alias("topic"), F.lit("four").alias("response_text"), F.timestamp_seconds(F.col("id") * 60).alias("answered_at")).write.parquet(folder)
    counts = intake.answers_by_window(intake.arriving(spark, folder, SCHEMA))
    q = counts.writeStream.format("memory").queryName("answer_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r["answers"] for r in spark.table("answer_windows").collect()) == [5, 5, 5, 5]
