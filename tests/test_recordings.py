"""Recorded answers as people keep them, and a calendar over small logs."""

import datetime as dt
import json

from stewardry.operators import audit
from stewardry.sources import readers


def test_indented_recordings_are_read_whole(spark, tmp_path):
    answer = {
        "state": "answered", "decision": "conditional", "reason_code": None, "decision_id": "d1",
        "instructions": [{"instruction_key": "k", "decision": "conditional", "scenario_key": "s"}],
        "conditions": [{"kind": "approval_required", "requirement": "ask", "policy": "p", "required_role": None}],
        "obligations": [{"type": "mask", "target": "email", "method": "partial", "policy": "p"}],
        "findings": [{"table": "t", "column": "c", "decision": "deny", "severity": "fail", "rationale": "no"}],
    }
    for n in (1, 2):
        (tmp_path / f"case-{n}.json").write_text(json.dumps({"case_id": f"case-{n}", "tool": "authorize", "answer": answer, "note": "x"}, indent=2))
    (tmp_path / "bare.json").write_text(json.dumps({"case_id": "bare", "tool": "validate"}, indent=2))
    rows = {r["case_id"]: r for r in readers.recorded_answers(spark, str(tmp_path), indented=True).collect()}
    assert set(rows) == {"case-1", "case-2", "bare"} and rows["bare"]["answer"] is None
    assert rows["case-2"]["answer"].asDict(recursive=True) == answer
    assert rows["case-1"]["file"].endswith("case-1.json")


def test_days_without_requests_count_as_zero(spark):
    def at(day):
        return dt.datetime(2024, 1, day, 12)

    log = [("a", "deny", at(1)), ("a", "deny", at(1)), ("a", "allow", at(4)), (None, None, at(9)), ("b", "allow", None)]
    answers = spark.createDataFrame(log, "scenario string, decision string, requested_at timestamp_ntz")
    rows = {(r["scenario"], r["decision"], r["day"].day): r for r in audit.decision_calendar(answers, span=3).collect()}
    assert len(rows) == 3 * 9
    assert [rows["a", "deny", d]["n"] for d in range(1, 10)] == [2, 0, 0, 0, 0, 0, 0, 0, 0]
    assert [rows["a", "deny", d]["moving_n"] for d in (1, 2, 3, 4)] == [2.0, 1.0, 2 / 3, 0.0]
    assert rows["a", "allow", 4]["share"] == 1.0 and rows["a", "allow", 5]["share"] is None
    assert rows[None, "none", 9]["n"] == 1
    assert audit.decision_calendar(answers.limit(0)).count() == 0
