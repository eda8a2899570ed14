"""Streams driven to completion must equal the batch result."""

from pyspark.sql import functions as F

from stewardry.plans import catalogue, q_stream
from stewardry.plans.q_audit import CALLS
from stewardry.plans.workload import Workload
from stewardry.session import scratch_dir
from stewardry.streaming import streams

FOLDER = "/root/testdata/sf0.001"


def test_receipts_are_minted_once(spark):
    out = catalogue.QUERIES["stream_dedup_receipts"](spark, FOLDER)
    assert out.count() == out.distinct().count() > 0


def test_sessions_closed_by_the_watermark_equal_batch(spark):
    w = Workload(spark, FOLDER)
    streamed = q_stream.closed_sessions(w)
    calls = w.sql(CALLS).withColumn("ts", F.col("ts").cast("timestamp"))
    newest = calls.agg(F.max("ts")).first()[0]
    batch = (
        calls.groupBy(F.session_window("ts", "30 minutes").alias("s"), "user_id")
        .agg(
            F.count("*").alias("n_calls"), F.count_if(F.col("label") == "warn").alias("n_revised"),
            F.count_if(F.col("label") == "deny").alias("n_denied"),
        )
        .select("user_id", F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "n_calls", "n_revised", "n_denied")
    )
    closed = batch.filter(F.col("ended") <= F.lit(newest) - F.expr("INTERVAL 10 MINUTES"))
    assert streamed.select(*closed.columns).exceptAll(batch).count() == 0
    assert closed.exceptAll(streamed.select(*closed.columns)).count() == 0


def test_a_replayed_batch_leaves_one_copy(spark):
    path = scratch_dir(spark, "replay")
    write = streams.batch_writer(path)
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert spark.read.parquet(path).count() == 8


def test_rules_are_reloaded_per_batch(spark):
    w = Workload(spark, FOLDER)
    asked = []

    def load():
        asked.append(1)
        return f"pub-{len(asked)}", w.rules()

    path = scratch_dir(spark, "reload")
    streams.run_available(streams.decide_stream(q_stream.requests(w), load, path), "reload", spark)
    out = spark.read.option("basePath", path).parquet(path)
    assert out.count() == w.table("events").count()
    assert out.select("publication_id").distinct().count() == len(asked)
