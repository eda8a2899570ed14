"""The published demo estate: every case must give its recorded answer."""

import pytest

from stewardry.operators import compose, decide, prepare, resolve, validate
from tests import golden


@pytest.fixture(scope="module")
def rules(spark):
    return resolve.publish(golden.policies(spark), *golden.catalog(spark)).cache()


def test_authorize(spark, rules):
    answers = {r["request_id"]: r for r in compose.authorize(golden.requests(spark), rules).collect()}
    wrong = []
    for i, case in enumerate(golden.AUTHORIZE):
        a = answers[i]
        kinds = {c["kind"] for c in a["conditions"]}
        duties = {o["type"] for o in a["obligations"]}
        decided = case["decision"] or {"review_required": "require_review"}.get(case["state"])
        if (
            a["state"] != case["state"]
            or a["decision"] != decided
            or (case["reason"] and a["reason_code"] != case["reason"])
            or not case["conditions"] <= kinds
            or not case["obligations"] <= duties
            or a["can_proceed_now"] != (a["decision"] == "allow")
        ):
            wrong.append((i, case["asset"], case["scenario"], a["state"], a["decision"], a["reason_code"], kinds, duties))
    assert not wrong


def test_both_forms_agree(spark, rules):
    asked = golden.requests(spark)
    rows = compose.compose_pairs(decide.decided_pairs(prepare.prepared(asked), rules, "left"))
    fields = ["request_id", "state", "decision", "reason_code"]
    inplace = compose.decide_in_place(asked, rules).select(*fields)
    fallback = compose.decide_in_place(asked, rules, limit=5).select(*fields)
    assert rows.select(*fields).exceptAll(inplace).count() == 0
    assert inplace.exceptAll(fallback).count() == 0


def test_conflict_is_flagged_at_publish(rules):
    flagged = {r["table"] for r in rules.filter("conflict_status = 'conflicted'").collect()}
    assert flagged == {"applicants", "marketing_prospects"}


def test_one_masking_rule_per_column(rules):
    paths = rules.filter("family = 'masking' AND kind IS NULL").select("table", "column").distinct().count()
    assert paths == rules.filter("family = 'masking'").count()


def test_validate(spark, rules):
    catalog = golden.catalog(spark)[1]
    refs = validate.drop_ctes(validate.qualify(golden.query_refs(spark)))
    found = validate.findings(validate.expand_star(refs, catalog), rules).cache()
    judged = {r["query_id"]: r for r in validate.verdicts(found).collect()}
    open_refs = {(r["query_id"], r["table"]) for r in found.filter("NOT governed").collect()}
    wrong = []
    for i, case in enumerate(golden.VALIDATE):
        r = judged[i]
        expected_open = {(i, t) for t in case["ungoverned"]}
        if (
            r["verdict"] != case["verdict"]
            or r["state"] != (case["state"] or "answered")
            or {o for o in open_refs if o[0] == i} != expected_open
        ):
            wrong.append((i, case["tables"], r["verdict"], r["state"], case["verdict"]))
    assert not wrong


def test_same_query_flips_with_intent(spark, rules):
    from pyspark.sql import functions as F

    catalog = golden.catalog(spark)[1]
    refs = validate.qualify(golden.query_refs(spark)).filter("query_id IN (12, 13)")
    judged = validate.verdicts(validate.findings(validate.expand_star(refs, catalog), rules))
    flips = validate.intent_flips(judged.withColumn("fingerprint", F.lit("same text"))).collect()
    assert len(flips) == 1 and flips[0]["has_pass"] and flips[0]["has_fail"]


def test_free_text_scenarios(spark):
    rows = spark.createDataFrame(
        [(1, "fine-tune a model on this data"), (2, "compare ai.training and ai.inference guidance"), (3, "hello")],
        "request_id long, use_text string",
    )
    words = {"fine-tune": "ai.training", "ai.training": "ai.training", "ai.inference": "ai.inference"}
    out = {r[0]: (r["resolved_scenario"], r["reason_code"]) for r in prepare.scenario_from_text(rows, words).collect()}
    assert out == {
        1: ("ai.training", None), 2: (None, "scenario_unresolved"), 3: (None, "scenario_unresolved"),
    }
