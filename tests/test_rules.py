"""Properties the decision layer must keep, and small cases of single operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stewardry import schemas, vocab
from stewardry.functions import masks
from stewardry.operators import compose, contract, enforce, exceptions, gate, resolve, select, validate
from stewardry.plans.workload import Workload
from stewardry.sources import readers, sinks

FOLDER = "/root/testdata/sf0.001"
RANK = {d: i for i, d in enumerate(vocab.DECISIONS)}


@pytest.fixture(scope="module")
def w(spark):
    return Workload(spark, FOLDER)


def decisions(requests, rules):
    return {
        r["request_id"]: (r["state"], r["decision"])
        for r in compose.decide_in_place(requests, rules).select("request_id", "state", "decision").collect()
    }


def test_a_deny_never_makes_an_answer_more_permissive(w):
    rules = w.rules()
    denial = (
        rules.filter("family = 'usage_guidance' AND kind = 'prohibited'")
        .withColumn("scenario", F.explode(F.array(F.lit("purpose.allowed_use"), F.lit("ai.inference"))))
        .withColumn("rule_id", F.col("rule_id") + 1000)
    )
    before = decisions(w.requests(), rules)
    after = decisions(w.requests(), rules.unionByName(denial))
    changed = 0
    for key, (_, old) in before.items():
        new = after[key][1]
        if old is not None:
            assert RANK[new] <= RANK[old]
            changed += new != old
    assert changed > 0


def test_dropping_the_purpose_never_yields_allow_by_permission(w):
    rules = w.rules().filter("family = 'usage_guidance'")
    blind = decisions(w.requests().withColumn("purpose", F.lit(None).cast("string")), rules)
    assert not [d for _, d in blind.values() if d == "allow"]
    with_purpose = decisions(w.requests(), rules)
    denied = {k for k, (_, d) in with_purpose.items() if d == "deny"}
    assert denied and denied <= {k for k, (_, d) in blind.items() if d == "deny"}


def test_every_answer_is_in_the_vocabulary(w):
    seen = decisions(w.requests(), w.rules()).values()
    assert {s for s, _ in seen} <= set(vocab.STATES)
    assert {d for _, d in seen if d} <= set(vocab.DECISIONS)
    assert {"allow", "deny", "conditional", "require_review", "mask_full", "mask_partial", "retain"} <= {d for _, d in seen}


def test_masks(spark):
    df = spark.createDataFrame(
        [("ann.lee@example.com",), ("Bob",), (None,), ("call +1 (555) 123-4567 or mail a.b@c.org 4111 1111 1111 1111",)],
        "v string",
    )
    v = F.col("v")
    rows = df.select(
        masks.partial(v).alias("p"), masks.full(v).alias("f"), masks.hashed(v, "s").alias("h"),
        masks.tokenize(v, "s").alias("t"), masks.redact(v).alias("r"), masks.mask(v, "custom.x", "s").alias("c"),
    ).collect()
    assert rows[0]["p"] == "a***@example.com" and rows[1]["p"] == "B***"
    assert rows[2]["p"] is None and rows[2]["f"] is None and rows[2]["h"] is None and rows[2]["t"] is None
    assert rows[0]["t"].startswith("tok_") and rows[0]["c"] == "****"
    assert rows[3]["r"] == "call [phone] or mail [email] [card]"


def test_redaction_is_idempotent(spark, w):
    once = w.table("documents").select("doc_id", masks.redact(F.col("text")).alias("text"))
    twice = once.select("doc_id", masks.redact(F.col("text")).alias("text"))
    assert once.exceptAll(twice).count() == 0
    assert once.filter(F.col("text").rlike(masks.EMAIL)).count() == 0


def test_approvals_are_satisfied_but_consent_and_denials_are_not(spark):
    at = datetime(2024, 1, 10, 12)
    kinds = [("approval_required",), ("consent_required",)]
    rows = [
        (1, 7, at, "conditional", [(k[0], "", "p", None) for k in kinds[:1]]),
        (2, 7, at, "conditional", [(k[0], "", "p", None) for k in kinds]),
        (3, 7, at, "deny", []),
        (4, 8, at, "conditional", [("approval_required", "", "p", None)]),
        (5, 9, at, "conditional", [("approval_required", "", "p", None)]),
        (6, 9, at - timedelta(days=30), "conditional", [("approval_required", "", "p", None)]),
    ]
    decided = spark.createDataFrame(
        rows,
        schemas.struct(
            request_id=schemas.L, actor=schemas.L, instant=schemas.TS, decision=schemas.S,
            conditions=schemas.array(schemas.CONDITION),
        ),
    )
    grants = spark.createDataFrame(
        [
            (7, "approval_required", "active", at - timedelta(days=2), at + timedelta(hours=1)),
            (8, "approval_required", "active", at - timedelta(days=9), at),
            (9, "approval_required", "active", at - timedelta(days=9), None),
        ],
        "actor long, kind string, state string, valid_from timestamp_ntz, valid_until timestamp_ntz",
    )
    for limit in (1000, 1):
        met = compose.can_proceed(compose.satisfy_conditions(decided, grants, limit))
        out = {r["request_id"]: r["can_proceed_with_exception"] for r in met.collect()}
        assert out == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False}


def test_change_sets_as_objects_arrays_and_pretty_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"change_set_id": "cs", "changes": [\n {"change_id": "1", "kind": "tool_use"}\n]}')
    (tmp_path / "b.json").write_text('[{"change_id": "2", "kind": "sql_model"},\n {"change_id": "3", "kind": "x"}]')
    rows = readers.change_sets(spark, str(tmp_path), one_per_file=True).select("change_set_id", "change_id").collect()
    assert sorted(map(tuple, rows)) == [("ad-hoc", "2"), ("ad-hoc", "3"), ("cs", "1")]


def test_gate_report_splits_a_crowded_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "RESULTS_PER_ROW", 10)
    results = spark.range(100).select(
        F.when(F.col("id") < 70, "big").otherwise("small").alias("change_set_id"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("change_id"),
        F.lit("tool_use").alias("kind"), F.lit("allow").alias("decision"), F.lit("pass").alias("gate"),
        F.array(F.lit("PERMITTED_USE")).alias("reason_codes"), F.array().cast("array<string>").alias("required_controls"),
    )
    path = str(tmp_path / "report")
    sinks.gate_report(results, gate.summary(results), path)
    back = spark.read.schema("change_set_id string, piece int, total long, results array<struct<change_id:string>>").json(path)
    sizes = {(r["change_set_id"], r["piece"]): len(r["results"]) for r in back.collect()}
    assert sum(sizes.values()) == 100 and len([k for k in sizes if k[0] == "big"]) > 1


def test_release_needs_no_failures_reviews_or_unmet_controls(spark):
    def results(*gates):
        return spark.createDataFrame([("s", g) for g in gates], "change_set_id string, gate string")

    assert gate.summary(results("pass", "needs_controls")).first()["release_allowed"]
    assert not gate.summary(results("pass", "needs_controls"), fail_on_controls=True).first()["release_allowed"]
    assert not gate.summary(results("pass", "needs_review")).first()["release_allowed"]
    assert gate.worst(results("pass", "needs_review", "needs_controls")).first()["worst_gate"] == "needs_review"


def test_reviews_move_only_pending_items(spark):
    both = ["approval_recorded", "anonymization_before_transfer"]
    items = spark.createDataFrame(
        [(1, "pending_human_review"), (2, "pending_human_review"), (3, "pending_human_review"), (4, "blocked_by_policy"),
         (5, "pending_human_review")],
        "request_id long, status string",
    ).withColumns(
        {"required_attestations": F.array(*map(F.lit, both)), "evidence_id": F.lit("e"), "destination": F.lit("d")}
    )
    reviews = spark.createDataFrame(
        [(1, "r1", " Approve ", both), (2, "r2", "approve", both[:1]), (3, "r3", "reject", []), (4, "r4", "approve", both)],
        "request_id long, review_id string, review_decision string, attested array<string>",
    )
    out = {r["request_id"]: r for r in exceptions.apply_review(items, reviews).collect()}
    assert out[1]["status"] == "resumed_with_controls" and out[1]["resume_payload"]["review_id"] == "r1"
    assert out[2]["status"] == "requires_changes" and out[2]["missing"] == ["anonymization_before_transfer"]
    assert out[3]["status"] == "rejected_by_reviewer"
    assert out[4]["status"] == "blocked_by_policy" and out[4]["resume_payload"] is None
    assert out[5]["status"] == "pending_human_review"


def test_consent_without_a_basis_sees_nothing(w):
    bases = {"analytics.reporting": "consent_measurement"}
    granted = enforce.apply_consent(w.customers(), bases, "analytics.reporting").count()
    assert 0 < granted < w.customers().count()
    assert enforce.apply_consent(w.customers(), bases, "care.treatment").count() == 0


def test_row_filter_without_entitlement_sees_nothing(spark, w):
    entitled = spark.createDataFrame([("people_ops", "ASIA")], "role string, region string")
    seen = enforce.apply_row_filter(w.customers(), entitled, "people_ops").select("region").distinct().collect()
    assert [r[0] for r in seen] == ["ASIA"]
    assert enforce.apply_row_filter(w.customers(), entitled, "marketing").count() == 0


def test_dispositions_are_written_apart(spark, w, tmp_path):
    from stewardry.plans.q_enforce import dispositions

    path = str(tmp_path / "exports")
    enforce.write_dispositions(dispositions(w), path)
    back = spark.read.parquet(path)
    assert {r[0] for r in back.select("disposition").distinct().collect()} == {"hold", "reject"}
    assert back.count() == w.table("customer").count()


def test_retention_keeps_leap_days_exact(spark):
    days = [datetime(2000, 2, 28), datetime(2000, 2, 29), datetime(2000, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    due = enforce.retention_due(df, "t", 5, datetime(2005, 2, 28), "archive").collect()
    assert {r["t"] for r in due} == set(days[:2])


def test_small_groups_are_suppressed(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", 2)] * 2, "g string, id int")
    kept = enforce.anonymize(df, ["id"], {"g": F.col("g")}, 3).collect()
    assert len(kept) == 5 and {r["g"] for r in kept} == {"a"}


def test_chained_vocabulary_is_applied_at_publish(spark):
    rules = spark.createDataFrame([(["old_reporting", "ai"],), (None,)], "uses array<string>")
    out = [r["uses"] for r in resolve.apply_vocabulary(rules, {"old_reporting": "analytics.reporting"}).collect()]
    assert out == [["analytics.reporting", "ai"], None]


def test_ids_are_numbered_by_first_appearance(spark):
    a, b = "aaaaaaaa-aaaa-4aaa-8aaa-aaaaaaaaaaaa", "bbbbbbbb-bbbb-4bbb-8bbb-bbbbbbbbbbbb"
    df = spark.createDataFrame([(1, f"x {b} y {a} z"), (2, f"{a}"), (3, "none")], "n long, t string")
    out = {r["n"]: r["t"] for r in contract.canonicalise_ids(df, "n", "t").collect()}
    one, two = (f"00000000-0000-4000-8000-{i:012d}" for i in (1, 2))
    assert out == {1: f"x {one} y {two} z", 2: two, 3: "none"}


def test_manifest_meta_config_wins(spark):
    rows = spark.createDataFrame(
        [(({"a": "1", "b": "1"}, ({"b": "2"},)),)],
        "node struct<meta:map<string,string>,config:struct<meta:map<string,string>>>",
    )
    assert rows.select(select.merged_meta(F.col("node")).alias("m")).first()["m"] == {"a": "1", "b": "2"}


def test_fingerprint_ignores_outer_blanks(spark):
    df = spark.createDataFrame([("SELECT 1",), ("  SELECT 1 ",)], "s string")
    assert df.select(validate.fingerprint(F.col("s")).alias("f")).distinct().count() == 1
