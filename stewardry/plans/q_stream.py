"""Streaming queries: the given log drives each stream to completion."""

from pyspark.sql import functions as F

from stewardry.functions.expr import asset_path
from stewardry.operators import compose
from stewardry.plans import estate
from stewardry.plans.q_audit import CALLS, TABLE_PATH
from stewardry.plans.q_gate import ACCESS_LOG
from stewardry.plans.registry import cte, query
from stewardry.session import scratch_dir
from stewardry.streaming import stateful, streams


# The log arrives in this many slices of DAYS days each; every LATE-th event arrives two slices late.
SLICES, DAYS, LATE, FILES = 4, 8, 40, 2
# A slice is one batch. Where each holds this many rows a file, it comes in more files, up to two a core.
FILE_ROWS = 10_000
_SLICE = f"greatest(0, least({SLICES - 1}, CAST(floor(datediff({{day}}, DATE '2024-01-01') / {DAYS}) AS INT)))"


def arrivals(w, late=False):
    """The events as files that arrived one slice after the other, in the order of their time, some of them ``late``."""
    log = w.table("events")
    slot = F.expr(_SLICE.format(day="CAST(ts AS DATE)"))
    if late:
        slot = F.least(F.lit(SLICES - 1), slot + F.when(F.col("event_id") % LATE == 0, 2).otherwise(0))
    folder = scratch_dir(w.spark, "arrivals")
    sizes = log.where(slot.isNotNull()).groupBy(slot.alias("slot")).count().select("count").collect()
    least = min((r["count"] for r in sizes), default=0) if len(sizes) == SLICES else 0
    files = max(FILES, min(2 * w.spark.sparkContext.defaultParallelism, least // FILE_ROWS))
    for number in range(SLICES):
        log.where(slot == number).repartition(files).write.parquet(f"{folder}/slice-{number}")
    found = w.spark.readStream.schema(log.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files)
    return found.parquet(folder)


def events(w):
    return streams.file_stream(w.spark, w.folder, "events.parquet")


def requests(w, log=None):
    return w._asset_columns(w.sql(estate.REQUESTS, events=events(w) if log is None else log))


def collected(w, writer, path, label):
    streams.run_available(writer, label, w.spark)
    return w.spark.read.option("basePath", path).parquet(path)


@query("stream_decide", "SELECT request_id, state, decision, reason_code, 'pub-1' AS publication_id FROM answers", ["answers"])
def stream_decide(w):
    path = scratch_dir(w.spark, "stream-ledger")
    writer = streams.decide_stream(requests(w), lambda: ("pub-1", w.rules()), path)
    return collected(w, writer, path, "decide").select(
        "request_id", "state", "decision", "reason_code", "publication_id"
    )


@query("stream_dedup_receipts", "SELECT DISTINCT signature, actor FROM signed", ["signed"])
def stream_dedup_receipts(w):
    """Ten minutes of state; retries that come later are known from the ledger."""
    path = scratch_dir(w.spark, "stream-receipts")
    return collected(w, stateful.receipts_once(requests(w, arrivals(w)), path), path, "dedup").select("signature", "actor")


SIZE, SLIDE, DELAY = "12 hours", "6 hours", "1 day"


def _slice_sql(day):
    return f"greatest(0, least({SLICES - 1}, CAST(floor(date_diff('day', DATE '2024-01-01', CAST({day} AS DATE)) / {DAYS}) AS INT)))"


cte(
    "placed",
    f"""SELECT request_id, requested_at, db || '.' || sch || '.' || tbl AS asset, decision,
    least({SLICES - 1}, {_slice_sql("requested_at")} + CASE WHEN request_id % {LATE} = 0 THEN 2 ELSE 0 END) AS slot FROM answers""",
    "answers",
)
cte("marks", "SELECT slot, max(requested_at) AS newest FROM placed GROUP BY slot", "placed")


@query(
    "stream_verdict_windows",
    f"""SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, asset, decision,
      CAST(count(*) FILTER (NOT late) AS BIGINT) AS n, CAST(count(*) FILTER (late) AS BIGINT) AS n_late FROM (
      SELECT *, coalesce(window_start + INTERVAL {SIZE} <= (SELECT max(m.newest) FROM marks m WHERE m.slot < p.slot - 1) - INTERVAL {DELAY}, FALSE) AS late
      FROM (SELECT *, unnest([time_bucket(INTERVAL {SLIDE}, requested_at), time_bucket(INTERVAL {SLIDE}, requested_at) - INTERVAL {SLIDE}]) AS window_start FROM placed) p)
    GROUP BY 1, 2, 3""",
    ["marks"],
)
def stream_verdict_windows(w):
    """Verdicts per asset in sliding windows; the rows that came after their window had closed are counted beside."""
    path, log = scratch_dir(w.spark, "stream-windows"), arrivals(w, late=True)
    verdicts = compose.decide_in_place(requests(w, log), w.rules()).select("requested_at", asset_path(*TABLE_PATH).alias("asset"), "decision")
    keys = ["asset", "decision"]
    counted = stateful.sliding_verdicts(verdicts, "requested_at", keys, SIZE, SLIDE, DELAY)
    writer = counted.writeStream.outputMode("update").foreachBatch(streams.batch_writer(path))
    folded = streams.newest_per_key(collected(w, writer, path, "windows"), ["window_start", *keys])
    writer = stateful.late_verdicts(verdicts, "requested_at", keys, SIZE, SLIDE, DELAY, f"{path}-late")
    late = collected(w, writer, f"{path}-late", "late").groupBy("window_start", *keys).agg(F.sum("n_late").alias("n_late"))
    both = folded.withColumn("n_late", F.lit(0).cast("long")).unionByName(late.withColumn("n", F.lit(0).cast("long")))
    both = both.groupBy(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *keys)
    return both.agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))


@query(
    "stream_agent_sessions",
    """SELECT user_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started, strftime(ended, '%Y-%m-%d %H:%M:%S') AS ended, n_calls, n_revised, n_denied,
      ended > (SELECT max(ts) FROM calls) - INTERVAL 10 MINUTE AS open FROM (
      SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n_calls,
        count(*) FILTER (WHERE label = 'warn') AS n_revised, count(*) FILTER (WHERE label = 'deny') AS n_denied
      FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM calls))
      GROUP BY user_id, session_no)""",
    ["calls"],
)
def stream_agent_sessions(w):
    """Sessions the watermark has closed by the end of the log, and those that were open then."""
    calls = w.sql(CALLS).select("user_id", "ts", "label")
    found = streams.with_open_sessions(closed_sessions(w), calls, "ts", "user_id")
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started", "ended")})


def closed_sessions(w):
    path = scratch_dir(w.spark, "stream-sessions")
    calls = w.sql(CALLS, events=events(w)).select("user_id", "ts", "label")
    writer = streams.agent_sessions(calls, "ts", "user_id").writeStream.outputMode("append").foreachBatch(
        streams.batch_writer(path)
    )
    return collected(w, writer, path, "sessions").drop("batch_id")


@query(
    "stream_request_status",
    """SELECT access_request_id, CASE WHEN ts < (SELECT max(ts) FROM access_log) - INTERVAL 7 DAY THEN 'stale' ELSE status END AS status, exception_state FROM (
      SELECT *, row_number() OVER (PARTITION BY access_request_id ORDER BY ts DESC, event_id DESC) AS rn FROM access_log) WHERE rn = 1""",
    ["access_log"],
)
def stream_request_status(w):
    """Stale rows come from the stream's own timers, over a log that arrives in slices."""
    path = scratch_dir(w.spark, "stream-status")
    log = w.sql(ACCESS_LOG, events=arrivals(w))
    writer = stateful.status_with_timers(log, 7).writeStream.outputMode("update").foreachBatch(streams.batch_writer(path))
    return stateful.newest_status(collected(w, writer, path, "status")).select("access_request_id", "status", "exception_state")
