"""Streams with state of their own: status timers, receipts against a ledger, sliding windows with late rows apart."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from stewardry.streaming.streams import batch_writer, dedup_receipts, event_time

# Folders that a ledger of receipts is dealt into, so that a batch reads only those its signatures may be in.
LEDGER_BUCKETS = 32


# --- status with timers ----------------------------------------------------------------


# Requests share groups: a call per request costs milliseconds of the worker, a request inside one microseconds.
STATUS_BUCKETS = 1024
STATUS = "access_request_id long, at_us long, event_id long, status string, exception_state string"
_STATE = (
    "ids array<long>, at_us array<long>, event_ids array<long>, statuses array<string>, exceptions array<string>, "
    "timers array<long>"
)
_FIELDS = ["id", "no_id", "at_us", "seq", "status", "exception_state"]
_FIRST, _LAST = -(2**63), 2**63 - 1


def _order(event):
    """Events of one batch by (ts, event_id), one without an instant last."""
    return event[0] == _FIRST, *event[:2]


def _follow(timeout_ms):
    def step(key, batches, state):
        now = state.getCurrentWatermarkMs()
        live = {r[0]: r[1:] for r in zip(*state.get)} if state.exists else {}
        seen = {}
        for batch in () if state.hasTimedOut else batches:
            for request, no_id, *event in zip(*[batch[c].tolist() for c in _FIELDS]):
                request = None if no_id else request
                if request not in seen or _order(event) >= _order(seen[request]):
                    seen[request] = event
        rows = []
        for request, event in seen.items():
            known = live.get(request)
            newest = event if known is None or tuple(event[:2]) > known[:2] else known[:4]
            # a timer must lie beyond the watermark; one that is due already fires with the next batch
            live[request] = (*newest, max(newest[0] // 1000 + timeout_ms, now + 1))
            rows.append((request, *newest))
        for request in [r for r, kept in live.items() if r not in seen and kept[4] < now]:
            at_us, event_id, _, exception, _ = live.pop(request)
            rows.append((request, at_us, event_id, "stale", exception))
        if live:
            state.update(tuple(list(c) for c in zip(*[(r, *kept) for r, kept in live.items()])))
            state.setTimeoutTimestamp(max(min(kept[4] for kept in live.values()), now))
        elif state.exists:
            state.remove()
        out = pd.DataFrame(rows, columns=["access_request_id", "at_us", "event_id", "status", "exception_state"])
        out["access_request_id"] = pd.array([r[0] for r in rows], dtype="Int64")
        yield out

    return step


def status_with_timers(log, timeout_days, delay_days=2):
    """Status changes per access request, and 'stale' from the stream itself when a request has been silent for the timeout.

    The state is one entry per live request, kept in buckets of requests: the newest event by (ts, event_id), and a timer.
    An event-time timer turns it stale once the newest instant of the log is more than ``timeout_days`` after it, without
    a later event of the request, and frees the entry. A bucket wakes for the first of its timers. A later event makes
    the request live again. Rows older than the watermark are dropped.
    """
    wait = (timeout_days - delay_days) * 86_400_000
    seen = event_time(log, "ts").withWatermark("ts", f"{delay_days} days")
    # nulls would turn whole columns of a bucket to floats
    seen = seen.select(
        "ts", F.pmod(F.xxhash64("access_request_id"), F.lit(STATUS_BUCKETS)).alias("bucket"),
        F.coalesce("access_request_id", F.lit(0)).cast("long").alias("id"), F.col("access_request_id").isNull().alias("no_id"),
        F.coalesce(F.unix_micros("ts"), F.lit(_FIRST)).alias("at_us"), F.coalesce("event_id", F.lit(_LAST)).cast("long").alias("seq"),
        "status", "exception_state",
    )
    changes = seen.groupBy("bucket").applyInPandasWithState(
        _follow(wait), STATUS, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
    return changes.select(
        "access_request_id", F.timestamp_micros(F.nullif("at_us", F.lit(_FIRST))).alias("ts"),
        F.nullif("event_id", F.lit(_LAST)).alias("event_id"), "status", "exception_state",
    )


def newest_status(batches):
    """The last change of each request: by batch, of one batch by instant; a stale row follows the event it speaks of."""
    order = F.struct("batch_id", "ts", "event_id")
    newest = F.max_by(F.struct("ts", "status", "exception_state"), order)
    return batches.groupBy("access_request_id").agg(newest.alias("s")).select("access_request_id", "s.*")


# --- receipts against the ledger -----------------------------------------------------------


def receipt_bucket(signature="signature", actor="actor"):
    return F.pmod(F.xxhash64(signature, actor), F.lit(LEDGER_BUCKETS)).cast("int")


def receipts_once(requests, path, delay="10 minutes"):
    """A writer that mints one receipt per signature and caller, however late a retry comes.

    State holds the signatures of ``delay`` only. What that lets through is held against the ledger written by earlier
    batches: only the buckets of the batch's signatures are read. A batch that runs again does not see its own rows.
    """
    fresh = dedup_receipts(requests, delay).withColumn("bucket", receipt_bucket())

    def only_new(batch, batch_id):
        spark = batch.sparkSession
        if batch_id == 0:
            return batch
        touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]
        schema = batch.select("signature", "actor", "bucket").schema.add("batch_id", "long")
        known = spark.read.schema(schema).option("basePath", path).parquet(path)
        known = known.where(F.col("bucket").isin(touched) & (F.col("batch_id") < batch_id))
        known = known.select(*[F.col(c).alias(f"_{c}") for c in ("signature", "actor", "bucket")])
        same = (F.col("bucket") == F.col("_bucket")) & F.col("signature").eqNullSafe(F.col("_signature"))
        return batch.join(known, same & F.col("actor").eqNullSafe(F.col("_actor")), "left_anti")

    return fresh.writeStream.foreachBatch(batch_writer(path, only_new, ("bucket",)))


# --- sliding windows -----------------------------------------------------------------------


def sliding_verdicts(verdicts, at, keys, size, slide, delay):
    """(window_start, *keys, n): verdicts per sliding window; windows the watermark has passed take no more rows."""
    return (
        event_time(verdicts, at)
        .withWatermark(at, delay)
        .groupBy(F.window(at, size, slide).alias("window"), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), *keys, "n")
    )


def late_verdicts(verdicts, at, keys, size, slide, delay, path):
    """A writer of the rows that ``sliding_verdicts`` drops, counted per window and key.

    A batch is counted once, per window, and written with its newest instants; the late windows are read from that. As in the window state, a batch drops what the watermark
    at the start of the batch before had passed: the newest instant of all batches but the last two, less the delay.
    """
    marks = f"{path}-marks"
    mark = batch_writer(marks)

    def late(batch, batch_id):
        spark = batch.sparkSession
        window = F.window(at, size, slide).alias("window")
        mark(batch.groupBy(window, *keys).agg(F.count("*").alias("n_late"), F.max(at).alias("newest")), batch_id)
        counted = spark.read.option("basePath", marks).parquet(marks)
        seen = counted.where(F.col("batch_id") < batch_id - 1)
        passed = seen.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("passed")).first()["passed"]
        rows = counted.where(F.col("batch_id") == batch_id)
        rows = rows.where(F.col("window.end") <= F.lit(passed)) if passed else rows.where("false")
        return rows.select(F.col("window.start").alias("window_start"), *keys, "n_late")

    return event_time(verdicts, at).writeStream.foreachBatch(batch_writer(path, late))
