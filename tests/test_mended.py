"""Cases a review found wrong: nulls in keys, offsets, repeated reviews, references with dots."""

import datetime as dt

from pyspark.sql import functions as F

from stewardry.operators import compose, contract, enforce, exceptions, prepare, resolve
from stewardry.plans.workload import Workload
from tests.harness import DATA as FOLDER


def test_validity_reads_offsets_and_dates(spark):
    texts = ["2027-01-01T00:00:00Z", "2027-01-01T00:00:00+05:00", "2027-01-01", "2027-01-01 06:30:00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    day = dt.datetime(2027, 1, 1)
    want = [day, day - dt.timedelta(hours=5), day, day + dt.timedelta(hours=6, minutes=30), None]
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [r[0] for r in df.select(resolve.validity(F.col("t"))).collect()]
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == want


def test_anonymize_keeps_null_groups(spark):
    rows = [("a", None, i) for i in range(10)] + [("b", "x", i) for i in range(10)] + [("c", None, 1)]
    df = spark.createDataFrame(rows, "region string, kind string, id int")
    out = enforce.anonymize(df, ["id"], {"region": F.col("region"), "kind": F.col("kind")}, 3)
    assert out.columns == ["region", "kind"]
    assert out.count() == 20


def test_transfer_meets_null_with_null(spark):
    exports = spark.createDataFrame([(1, "crm", None), (2, "crm", "EU"), (3, None, None)], "id int, system string, place string")
    decided = spark.createDataFrame([("crm", None, "deny"), ("crm", "EU", "allow")], "system string, place string, decision string")
    out = enforce.transfer_dispositions(exports, decided, ["system", "place"])
    assert {r["id"]: r["disposition"] for r in out.collect()} == {1: "reject", 2: "release", 3: "hold"}


def test_last_review_counts(spark):
    pending = spark.createDataFrame(
        [(1, "pending_human_review", ["x"], "e", "d")],
        "request_id long, status string, required_attestations array<string>, evidence_id string, destination string",
    )
    reviews = spark.createDataFrame(
        [(1, 10, "reject", []), (1, 11, "approve", ["x"])], "request_id long, review_id long, review_decision string, attested array<string>"
    )
    (row,) = exceptions.apply_review(pending, reviews).collect()
    assert (row["status"], row["review_id"]) == ("resumed_with_controls", 11)


def test_references_of_any_length_part_at_the_last_dot(spark):
    long = "c" * 12_000
    refs = [(1, f"@{long}.state"), (2, "@case.v2.state"), (3, "@case.v2"), (4, "@none"), (5, None)]
    asked = spark.createDataFrame(refs, "request_id int, ref string")
    recorded = spark.createDataFrame([(long, "s1"), ("case.v2", "s2"), ("case", "s3")], "case_id string, state string")
    got = {r["request_id"]: (r["resolved"], r["problem"]) for r in contract.resolve_chained(asked, recorded, ["state"]).collect()}
    assert got[1] == ("s1", None) and got[2] == ("s2", None) and got[3] == (None, "unresolved_field")
    assert got[4][1] == got[5][1] == "unknown_case"


def test_ids_inside_longer_runs_stay(spark):
    one = "11111111-2222-3333-4444-555555555555"
    df = spark.createDataFrame([(f"a {one} b", f"ff{one}ff")], "plain string, inside string")
    found = df.select(*[F.size(F.regexp_extract_all(c, F.lit(f"({contract.UUID})"))).alias(c) for c in df.columns]).first()
    assert tuple(found) == (1, 0)


def test_no_value_passes_for_another_field(spark):
    fields = ", ".join(f"`{f}` string" for f in prepare.SIGNATURE_FIELDS) + ", role string"
    blank = dict.fromkeys((*prepare.SIGNATURE_FIELDS, "role"))
    rows = [blank | {"purpose": "x|role=y"}, blank | {"purpose": "x", "role": "y"}, blank | {"purpose": "x", "scenario": "y"}, blank]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], fields)
    assert prepare.with_signature(df).select("signature").distinct().count() == len(rows)


def test_issued_ids_are_the_receipts(spark):
    w = Workload(spark, FOLDER)
    issued = compose.authorize(w.requests(), w.rules(), "pub-1").select("request_id", "authorization_id")
    ids = prepare.receipts(F.lit("pub-1"), F.col("signature"), prepare.evaluation_instant())
    minted = prepare.with_signature(w.requests()).select("request_id", ids["authorization_id"].alias("authorization_id"))
    assert issued.exceptAll(minted).count() == 0 == minted.exceptAll(issued).count()


def test_null_and_repeated_ids_decide_alike_beyond_the_limit(spark):
    w = Workload(spark, FOLDER)
    some = F.when(F.col("request_id") % 2 == 0, F.col("request_id") % 7)
    asked = w.requests().withColumn("request_id", some)
    small = compose.decide_in_place(asked, w.rules())
    large = compose.decide_in_place(asked, w.rules(), limit=3)
    assert small.columns == large.columns
    assert small.count() == asked.count()
    assert small.exceptAll(large).count() == 0 == large.exceptAll(small).count()


def test_masks_follow_the_decision(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [
        (1, "p", 3, "email", None, None, ("partial", None)),
        (2, "q", 2, "email", None, None, ("redact", None)),
        (3, "r", 3, "phone", None, day, ("redact", None)),
        (4, "s", 1, None, None, None, ("partial", ["auditor"])),
    ]
    rules = spark.createDataFrame(
        rows, "rule_id long, policy string, band int, column string, effective_from timestamp_ntz, "
        "effective_until timestamp_ntz, masking struct<method:string,exempt_roles:array<string>>",
    ).selectExpr("*", "'masking' AS family", "'d' AS database", "'s' AS schema", "'t' AS table")
    columns = ["email", "phone", "id"]
    later = dt.datetime(2024, 6, 1)
    assert enforce.mask_map(rules, "d.s.t", "x", columns, later) == {"email": "redact", "phone": "partial", "id": "partial"}
    assert enforce.mask_map(rules, "d.s.t", "auditor", columns, later) == {"email": "redact"}
    assert enforce.mask_map(rules, "d.s.t", "auditor", columns, dt.datetime(2023, 6, 1)) == {"email": "redact", "phone": "redact"}
