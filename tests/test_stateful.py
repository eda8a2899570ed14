"""Streams with state of their own, over several batches, restarts and late rows."""

import datetime as dt

from pyspark.sql import functions as F

from stewardry.plans import catalogue, q_stream
from stewardry.plans.workload import Workload
from stewardry.session import scratch_dir
from stewardry.streaming import stateful, streams

FOLDER = "/root/testdata/sf0.001"
LOG = "access_request_id long, event_id long, ts timestamp, status string, exception_state string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def drive(spark, folder, schema, make, checkpoint, files=1):
    """Run a query over what is there, from its checkpoint; returns the finished query."""
    found = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).parquet(folder)
    query = make(found).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def put(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/slice-{number}")


def test_a_request_turns_stale_without_a_later_event(spark):
    folder, path, checkpoint = (scratch_dir(spark, f"status-{n}") for n in ("in", "out", "check"))
    make = lambda log: stateful.status_with_timers(log, 7).writeStream.outputMode("update").foreachBatch(streams.batch_writer(path))
    read = lambda: {r[0]: r["status"] for r in stateful.newest_status(spark.read.option("basePath", path).parquet(path)).collect()}
    put(spark, folder, 0, [(1, 10, at(1), "open", "active"), (2, 11, at(1), "open", None), (2, 12, at(1), "closed", None), (None, 1, at(2), "open", None)], LOG)
    drive(spark, folder, LOG, make, checkpoint)
    assert read() == {1: "open", 2: "closed", None: "open"}
    # the stream stops here and goes on from its checkpoint; other requests move the clock
    put(spark, folder, 1, [(3, 20, at(8), "open", None), (2, 19, at(7), "in_review", None)], LOG)
    drive(spark, folder, LOG, make, checkpoint)
    assert read() == {1: "open", 2: "in_review", 3: "open", None: "open"}
    put(spark, folder, 2, [(3, 30, at(9, 1), "closed", None)], LOG)
    drive(spark, folder, LOG, make, checkpoint)
    assert read() == {1: "stale", 2: "in_review", 3: "closed", None: "stale"}
    rows = spark.read.option("basePath", path).parquet(path).where("access_request_id = 1 and status = 'stale'").collect()
    assert len(rows) == 1 and rows[0]["exception_state"] == "active" and rows[0]["event_id"] == 10
    # a stale request lives again; one event that the watermark has passed is dropped
    put(spark, folder, 3, [(1, 40, at(10), "resolved", None), (2, 41, at(2), "closed", None)], LOG)
    query = drive(spark, folder, LOG, make, checkpoint)
    assert read() == {1: "resolved", 2: "in_review", 3: "closed", None: "stale"}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) == 3


CALL = "signature string, actor long, requested_at timestamp, note string"


def test_retries_beyond_the_delay_leave_one_receipt(spark, monkeypatch):
    monkeypatch.setattr(stateful, "dedup_receipts", lambda df, delay: df.withWatermark("requested_at", delay).dropDuplicatesWithinWatermark(["signature", "actor"]))
    folder, path, checkpoint = (scratch_dir(spark, f"receipts-{n}") for n in ("in", "out", "check"))
    make = lambda calls: stateful.receipts_once(calls, path)
    days = [
        [("a", 1, at(1), "first"), ("a", 1, at(1), "again"), ("a", 2, at(1), "other caller"), ("b", None, at(1), "nobody")],
        [("a", 1, at(5), "retry after days"), ("c", 3, at(5), "new")],
        [(f"s{i}", i, at(9), "many") for i in range(50)],
        [("b", None, at(15), "nobody again"), ("c", 3, at(15), "retry"), ("s7", 7, at(15), "retry"), ("d", 4, at(15), "new")],
    ]
    progress = []
    for number, rows in enumerate(days):
        put(spark, folder, number, rows, CALL)
        progress += drive(spark, folder, CALL, make, checkpoint).recentProgress
    out = spark.read.option("basePath", path).parquet(path)
    want = {("a", 1), ("a", 2), ("b", None), ("c", 3), ("d", 4)} | {(f"s{i}", i) for i in range(50)}
    assert {(r["signature"], r["actor"]) for r in out.collect()} == want and out.count() == len(want)
    # state holds the signatures of the delay, not those of the log
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] < 10 < len(want)


def test_a_replayed_batch_does_not_meet_its_own_receipts(spark):
    path = scratch_dir(spark, "receipts-replay")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "signature string, actor long").withColumn("bucket", stateful.receipt_bucket())
    writers = []

    class Fake:
        def withColumn(self, *_):
            return self

        @property
        def writeStream(self):
            return self

        def foreachBatch(self, write):
            writers.append(write)

    kept, stateful.dedup_receipts = stateful.dedup_receipts, lambda *_: Fake()
    try:
        stateful.receipts_once(None, path)
    finally:
        stateful.dedup_receipts = kept
    write = writers[0]
    write(rows.where("signature = 'a'"), 0)
    write(rows, 1)
    write(rows, 1)
    assert sorted(r["signature"] for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_late_rows_are_counted_apart(spark):
    got = catalogue.QUERIES["stream_verdict_windows"](spark, FOLDER)
    sums = got.agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late")).first()
    n = Workload(spark, FOLDER).table("events").count()
    assert sums["n_late"] > 0 and sums["n"] + sums["n_late"] == 2 * n


def test_the_log_arrives_in_several_batches(spark):
    w = Workload(spark, FOLDER)
    path = scratch_dir(spark, "arrivals-out")
    query = streams.run_available(q_stream.arrivals(w, late=True).writeStream.foreachBatch(streams.batch_writer(path)), "arrivals", spark)
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(sizes) == q_stream.SLICES and sum(sizes) == w.table("events").count()
