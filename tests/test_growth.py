"""Steps whose time or volume grew faster than their input."""

import datetime as dt

from pyspark.sql import functions as F

from stewardry.operators import compose, contract, resolve
from stewardry.plans import catalogue, q_stream
from stewardry.plans.workload import Workload
from stewardry.session import materialize, scratch_dir
from stewardry.streaming import stateful, streams
from tests.test_stateful import LOG, drive, put

FOLDER = "/root/testdata/sf0.001"


def labels_of(monkeypatch, *modules):
    """Labels of all tables that these modules write."""
    seen = []

    def noted(df, label, partition_by=None):
        seen.append(label)
        return materialize(df, label, partition_by)

    for module in modules:
        monkeypatch.setattr(module, "materialize", noted)
    return seen


def test_selectors_are_resolved_once_and_masks_alone_reach_columns(spark, monkeypatch):
    kept = []

    def noted(df, label, partition_by=None):
        kept.append(materialize(df, label, partition_by))
        return kept[-1]

    monkeypatch.setattr(resolve, "materialize", noted)
    w = Workload(spark, FOLDER)
    served = resolve.flatten(w.instructions(paths=False))
    assert len(kept) == 1 and "resolution_paths" not in kept[0].columns
    masked = [r[0] for r in w.policies().where("spec.masking is not null").select("policy_id").collect()]
    assert {r[0] for r in kept[0].where("grain = 'column'").select("policy_id").distinct().collect()} <= set(masked)
    assert served.exceptAll(resolve.flatten(w.instructions())).count() == 0 and served.count() == w.instructions().count()


def test_a_repeated_policy_masks_what_its_other_rows_reach(spark):
    """Rules and selectors of equal policy keys meet, whichever row holds them."""
    w = Workload(spark, FOLDER)
    policies = w.policies()
    masks = policies.where("spec.masking is not null and spec.selector.tables is not null").limit(1)
    target = F.col("spec").withField("selector", F.col("spec.selector").withField("tables", F.array(F.lit("t7"))).withField("databases", F.lit(None).cast("array<string>")).withField("schemas", F.lit(None).cast("array<string>")))
    bare = masks.withColumn("spec", target.withField("masking", F.lit(None).cast(policies.schema["spec"].dataType["masking"].dataType)))
    both = materialize(masks.unionByName(bare), "twice")
    found = resolve.instructions(both, w.scoped_tables(), w.catalog_columns(), w.collections())
    assert found.where("rule.family = 'masking' and `table` = 't7'").count() == 1


def test_rules_of_scenarios_nobody_asks_about_stay(spark):
    w = Workload(spark, FOLDER)
    asked = w.requests().where("scenario in ('access.read', 'ai.training')").unionByName(w.requests().limit(1).withColumn("scenario", F.lit(None).cast("string")))
    kept = compose.asked_rules(asked, w.rules())
    assert {r[0] for r in kept.select("scenario").distinct().collect()} == {"access.read", "ai.training"}
    rows = compose.decide_in_place(asked, w.rules(), limit=1)
    arrays = compose.decide_in_place(asked, w.rules())
    assert rows.exceptAll(arrays).count() == 0 and arrays.exceptAll(rows).count() == 0


def test_conflicts_write_the_uses_and_no_rule(spark, monkeypatch):
    from stewardry.functions import scale
    from stewardry.plans import q_resolve

    seen = labels_of(monkeypatch, resolve, scale, q_resolve)
    catalogue.QUERIES["detect_conflicts"](spark, FOLDER).count()
    assert seen.count("authored-uses") == 1 and "instructions" not in seen


def test_pointers_stop_jumping_at_their_end(spark, monkeypatch):
    """A chain of 4, a cycle, and many ends: rounds follow the longest chain, and ended nodes are not written again."""
    nodes = [("a", "b", None), ("b", "c", None), ("c", "d", None), ("d", None, "end"), ("x", "y", None), ("y", "x", None), ("z", "x", None), ("u", "gone", None)]
    nodes += [(f"n{i}", "d", None) for i in range(500)]
    sizes = []

    def noted(df, label, partition_by=None):
        out = materialize(df, label, partition_by)
        sizes.extend([out.count()] if label == "refs-jumps" else [])
        return out

    monkeypatch.setattr(contract, "materialize", noted)
    found = contract.resolve_references(spark.createDataFrame(nodes, "ref string, target string, value string"))
    got = {r["key"]: (r["resolved"], r["steps"], r["problem"]) for r in found.collect()}
    assert len(got) == len(nodes) and got["a"] == ("end", 3, None) and got["d"] == ("end", 0, None) and got["n499"] == ("end", 1, None)
    assert got["x"] == got["y"] == got["z"] == (None, None, "cycle") and got["u"] == (None, 0, "unknown")
    assert sizes == [506, 5, 3]


def test_requests_share_state_and_stay_apart(spark):
    folder, path, checkpoint = (scratch_dir(spark, f"many-{n}") for n in ("in", "out", "check"))
    at = lambda day: dt.datetime(2024, 1, day)
    far = 2**53 + 1
    put(spark, folder, 0, [(i, i, at(1), "open", None) for i in range(5000)] + [(None, far, at(1), "closed", "active")], LOG)
    put(spark, folder, 1, [(7, far, at(12), "closed", None), (far, 1, at(12), "open", None)], LOG)
    make = lambda log: stateful.status_with_timers(log, 7).writeStream.outputMode("update").foreachBatch(streams.batch_writer(path))
    query = drive(spark, folder, LOG, make, checkpoint)
    rows = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    assert rows <= stateful.STATUS_BUCKETS
    out = spark.read.option("basePath", path).parquet(path)
    got = {r[0]: r["status"] for r in stateful.newest_status(out).collect()}
    assert len(got) == 5002 and got[7] == "closed" and got[far] == "open" and got[None] == "stale"
    assert sum(s == "stale" for s in got.values()) == 5000
    assert out.where("access_request_id = 7 and status = 'closed'").first()["event_id"] == far


def test_a_large_slice_is_one_batch_of_many_files(spark, monkeypatch):
    w = Workload(spark, FOLDER)
    batches = lambda: streams.run_available(
        q_stream.arrivals(w).writeStream.foreachBatch(lambda b, n: found.append((len(b.inputFiles()), b.count()))), "slices", spark
    )
    found = []
    batches()
    small = [n for _, n in found]
    monkeypatch.setattr(q_stream, "FILE_ROWS", 10)
    found = []
    batches()
    assert [n for _, n in found] == small and len(small) == q_stream.SLICES


def test_a_batch_is_counted_once_for_its_late_rows(spark, monkeypatch):
    path = scratch_dir(spark, "late")
    w = Workload(spark, FOLDER)
    log = q_stream.arrivals(w, late=True).select(F.col("ts").alias("at"), "event_type")
    writer = stateful.late_verdicts(log, "at", ["event_type"], "12 hours", "6 hours", "1 day", path)
    streams.run_available(writer, "late", spark)
    marks = spark.read.parquet(f"{path}-marks/batch_id=0")
    assert {"window", "event_type", "n_late", "newest"} == set(marks.columns)
