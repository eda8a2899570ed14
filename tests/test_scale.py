"""Size checks, hot keys and the shapes of the plans."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from stewardry.functions import scale
from stewardry.operators import compose, contract, decide, enforce, prepare, resolve, validate
from stewardry.plans.workload import Workload

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark):
    return Workload(spark, FOLDER)


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def hot(spark, n=60_000):
    """A third of the rows share one key, a few have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 997)
    return spark.range(n).withColumn("k", key)


def test_fits_is_exact(spark):
    df = spark.range(10)
    assert scale.fits(df, 10) and not scale.fits(df, 9)


def test_hot_keys_are_found_and_bounded(spark):
    df = hot(spark)
    hashes = scale.hot_hashes(df, ["k"])
    seven = df.filter("k = 7").select(F.xxhash64("k")).first()[0]
    assert seven in hashes and len(hashes) <= 1 / scale.HOT_SHARE


def test_flat_keys_are_not_salted(spark, monkeypatch):
    monkeypatch.setattr(scale, "SAMPLE", 1.0)
    flat = spark.range(200_000).select((F.col("id") % 1000).alias("k"))
    assert scale.hot_hashes(flat, ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = hot(spark)
    small = spark.range(5, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = scale.salted_join(big, small, ["k"], how, spread_by=["id"])
    plain = big.join(small, "k", how)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert salted.select(*plain.columns).exceptAll(plain).count() == 0
    assert plain.exceptAll(salted.select(*plain.columns)).count() == 0


def test_salting_spreads_the_hot_key(spark):
    big = hot(spark)
    small = spark.range(1000).select(F.col("id").alias("k"))
    joined = scale.salted_join(big, small, ["k"], spread_by=["id"])
    assert "_salt" in plan_of(joined)


def test_outer_sides_that_salting_would_repeat_are_refused(spark):
    with pytest.raises(ValueError):
        scale.salted_join(spark.range(2), spark.range(2), ["id"], "full_outer")


def test_hot_path_shuffles_no_request(w):
    text = plan_of(compose.decide_in_place(w.requests(), w.rules()))
    assert "BroadcastHashJoin" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "SortMergeJoin" not in text


def test_flagship_reads_only_needed_columns(w):
    text = plan_of(compose.decide_in_place(w.requests(), w.rules()).select("request_id", "state"))
    scan = [line for line in text.splitlines() if "ReadSchema" in line and "event_id" in line]
    assert scan and all("props" not in line and "value" not in line for line in scan)


def test_window_bounds_reach_the_scan(w):
    from datetime import datetime

    events = w.table("events").select("event_id", "ts")
    text = plan_of(enforce.apply_access_window(events, "ts", datetime(2024, 1, 12), 7))
    assert "PushedFilters" in text and "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text


def test_session_heads_are_limited_before_the_shuffle(w):
    calls = w.table("events").select("user_id", "ts", "event_id", "event_type")
    text = plan_of(contract.sequence_check(calls, ["user_id"], ["ts", "event_id"], "event_type", ["view", "click"]))
    assert "WindowGroupLimit" in text


def test_rows_take_over_when_rules_do_not_fit(w, monkeypatch):
    salt_everything(monkeypatch)
    fields = ["request_id", "state", "decision", "reason_code"]
    small = compose.decide_in_place(w.requests(), w.rules()).select(*fields)
    large = compose.decide_in_place(w.requests(), w.rules(), limit=3).select(*fields)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0


def salt_everything(monkeypatch):
    """Every key counts as hot, so each salted join really salts."""
    monkeypatch.setattr(scale, "SAMPLE", 1.0)
    monkeypatch.setattr(scale, "MIN_HITS", 1)


def test_salted_answers_equal_broadcast_answers(w, monkeypatch):
    salt_everything(monkeypatch)
    fields = ["request_id", "state", "decision", "next_action"]
    small = compose.authorize(w.requests(), w.rules()).select(*fields)
    large = compose.authorize(w.requests(), w.rules(), limit=3).select(*fields)
    assert small.exceptAll(large).count() == 0


def test_result_does_not_depend_on_order_or_partitions(w):
    fields = ["request_id", "decision", "decision_id"]
    a = compose.authorize(w.requests(), w.rules()).select(*fields)
    b = compose.authorize(w.requests().repartition(5, "actor"), w.rules().orderBy(F.rand(3))).select(*fields)
    assert a.exceptAll(b).count() == 0


def test_resolution_without_broadcast(w, monkeypatch):
    salt_everything(monkeypatch)
    def rows():
        found = w.instructions().select("policy_id", "instruction_key", *resolve.SCOPE, "primary_source")
        return {tuple(r) for r in found.collect()}

    small = rows()
    monkeypatch.setattr(resolve, "reference_join", lambda *a, **k: scale.reference_join(*a, **{**k, "limit": 1}))
    assert rows() == small


def test_global_rank_is_one_to_n(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"))
    ranked = contract.global_rank(df, ["x"]).orderBy("x").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 5001))


def test_queries_validate_without_broadcast(w, monkeypatch):
    salt_everything(monkeypatch)
    refs = validate.expand_star(validate.drop_ctes(validate.qualify(w.query_refs())), w.catalog())
    a = validate.verdicts(validate.findings(refs, w.rules()))
    b = validate.verdicts(validate.findings(refs, w.rules(), limit=3))
    assert a.exceptAll(b).count() == 0


def test_prepared_requests_keep_every_row(w):
    assert prepare.prepared(w.requests()).count() == w.table("events").count()
