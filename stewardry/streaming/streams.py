"""Streaming forms: requests and calls that arrive one by one.

Every sink writes one folder per micro-batch and overwrites it on a replay, so a
batch that runs twice leaves one copy. Readers fold the batches.
"""

import os

from pyspark.sql import functions as F

from stewardry.operators import compose
from stewardry.operators.prepare import with_signature
from stewardry.session import scratch_dir
from stewardry.sources.sinks import ledger_rows


def file_stream(spark, folder, name, files_per_trigger=64):
    """An unbounded read of the parquet files of one table."""
    schema = spark.read.parquet(os.path.join(folder, name)).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def batch_writer(path, transform=None, partition_by=()):
    def write(batch, batch_id):
        rows = transform(batch, batch_id) if transform else batch
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(os.path.join(path, f"batch_id={batch_id}"))

    return write


def run_available(writer, label, spark):
    """Run a query over everything available, then stop; the checkpoint is in the shared folder."""
    query = (
        writer.option("checkpointLocation", scratch_dir(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def event_time(df, at):
    """Watermarks need an instant: zone-free times are read in the session zone (UTC)."""
    return df.withColumn(at, F.col(at).cast("timestamp"))


def decide_stream(requests, load_rules, path):
    """Decide each micro-batch against the publication current when it starts.

    ``load_rules()`` returns (publication id, rules); it is asked once per batch, so
    a new publication applies from the next batch on.
    """

    def judge(batch, batch_id):
        publication_id, rules = load_rules()
        return ledger_rows(compose.authorize(batch, rules, publication_id))

    return requests.writeStream.foreachBatch(batch_writer(path, judge, ("eval_date", "publication_id")))


def dedup_receipts(requests, delay="10 minutes"):
    """Retried calls of one caller mint one receipt while the retry arrives within the delay.

    The signature holds the question and its declared instant; other callers with the same question keep theirs.
    """
    return (
        event_time(with_signature(requests), "requested_at")
        .withWatermark("requested_at", delay)
        .dropDuplicatesWithinWatermark(["signature", "actor"])
    )


def verdict_windows(decisions, at, keys, size="1 hour", slide=None, delay="10 minutes"):
    """Counts per window and key; rows later than the watermark are dropped."""
    window = F.window(at, size, slide) if slide else F.window(at, size)
    return (
        event_time(decisions, at)
        .withWatermark(at, delay)
        .groupBy(window.alias("window"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), *keys, "n")
    )


def newest_per_key(batches, keys):
    """Update-mode output folded to the last value of each key."""
    values = [c for c in batches.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*values), F.col("batch_id"))
    return batches.groupBy(*keys).agg(last.alias("v")).select(*keys, "v.*")


def agent_sessions(calls, at, actor, gap="30 minutes", delay="10 minutes"):
    """Session windows over agent calls, emitted once the watermark closes them."""
    return _sessions(event_time(calls, at).withWatermark(at, delay), at, actor, gap)


def _sessions(calls, at, actor, gap):
    return (
        calls.groupBy(F.session_window(at, gap).alias("session"), actor)
        .agg(
            F.count("*").alias("n_calls"),
            F.count_if(F.col("label") == "warn").alias("n_revised"),
            F.count_if(F.col("label") == "deny").alias("n_denied"),
        )
        .select(
            actor, F.col("session.start").alias("started"), F.col("session.end").alias("ended"),
            "n_calls", "n_revised", "n_denied",
        )
    )


def with_open_sessions(closed, calls, at, actor, gap="30 minutes"):
    """``closed`` sessions of the stream with those still open at the end of the log, flagged ``open``.

    Sessions of an actor close in the order of time, so the calls after an actor's last closed session are the open ones.
    """
    last = closed.groupBy(F.col(actor).alias("_actor")).agg(F.max("ended").alias("_closed"))
    left = event_time(calls, at).join(last, F.col(actor).eqNullSafe(F.col("_actor")), "left")
    left = left.where(F.col("_closed").isNull() | (F.col(at) >= F.col("_closed"))).drop("_actor", "_closed")
    ongoing = _sessions(left, at, actor, gap)
    return closed.select(*ongoing.columns).withColumn("open", F.lit(False)).unionByName(ongoing.withColumn("open", F.lit(True)))


def request_status(log, delay="2 days"):
    """Latest state per access request and day; days the watermark has passed leave state."""
    newest = F.max_by(F.struct("ts", "event_id", "status", "exception_state"), F.struct("ts", "event_id"))
    return (
        event_time(log, "ts")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("day"), "access_request_id")
        .agg(newest.alias("s"))
        .select("access_request_id", F.col("day.start").alias("day"), "s.*")
    )


def status_now(batches, timeout_days):
    """Fold the status batches; a request silent for the timeout is stale."""
    newest = F.max_by(F.struct("ts", "status", "exception_state"), F.struct("ts", "event_id"))
    folded = batches.groupBy("access_request_id").agg(newest.alias("s")).select("access_request_id", "s.*")
    return folded.sparkSession.sql(
        """
        SELECT access_request_id, ts, exception_state,
          CASE WHEN ts < (SELECT max(ts) FROM {folded}) - make_dt_interval({days}) THEN 'stale' ELSE status END AS status
        FROM {folded}
        """,
        folded=folded,
        days=timeout_days,
    )
