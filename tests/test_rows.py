"""Row forms of full answers and findings answer crowded scopes with the content of the arrays."""

import pytest
from pyspark.sql import functions as F

from stewardry.functions import scale
from stewardry.operators import compose, validate
from stewardry.plans.workload import Workload


@pytest.fixture(scope="module")
def w(spark):
    return Workload(spark, "/root/testdata/sf0.001")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def crowded(monkeypatch):
    monkeypatch.setattr(scale, "SAMPLE", 1.0)
    monkeypatch.setattr(scale, "MIN_HITS", 1)


def test_answer_rows_of_crowded_scopes(w, monkeypatch):
    whole = compose.authorize(w.requests(), w.rules(), "pub-1")
    crowded(monkeypatch)
    answers, cited = compose.authorize_rows(w.requests(), w.rules(), "pub-1", limit=3)
    plain = [c for c in answers.columns if c != "row_id"]
    assert same(whole.select(*plain), answers.select(*plain))
    listed = whole.select("request_id", F.posexplode("instructions").alias("rank", "c")).withColumn("rank", F.col("rank") + 1)
    listed = listed.select("request_id", "rank", "c.*")
    assert listed.count() > 0 and same(listed, cited.select(*listed.columns))


def test_finding_rows_of_crowded_tables(w, monkeypatch):
    refs = validate.expand_star(validate.drop_ctes(validate.qualify(w.query_refs())), w.catalog())
    whole = validate.findings(refs, w.rules())
    crowded(monkeypatch)
    found, cited = validate.finding_rows(refs, w.rules(), limit=3)
    plain = [c for c in found.columns if c not in ("row_id", "worst")]
    assert same(whole.select(*plain), found.select(*plain))
    listed = whole.select("query_id", "ref_no", F.posexplode("instructions").alias("rank", "c"))
    listed = listed.withColumn("rank", F.col("rank") + 1).select("query_id", "ref_no", "rank", "c.*")
    assert listed.count() > 0 and same(listed, cited.select(*listed.columns))
    assert same(validate.verdicts(whole), validate.verdicts(found))


def many_rules(w, times):
    """The served rules with one scope crowded by copies under other ids, all of which speak."""
    rules = w.rules()
    busy = rules.groupBy("database", "schema", "table", "column", "scenario").count().orderBy(F.col("count").desc()).first()
    same_scope = F.lit(True)
    for c in ("database", "schema", "table", "column", "scenario"):
        same_scope = same_scope & F.col(c).eqNullSafe(F.lit(busy[c]))
    copies = rules.where(same_scope).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times))))
    return rules.unionByName(copies.withColumn("rule_id", F.col("rule_id") + F.col("n") * 1_000).drop("n")), times * busy["count"]


def test_a_scope_of_fifty_thousand_rules(w, monkeypatch):
    """Neither refused nor cut: answers stay, and every rule that speaks is cited, as rows."""
    rules, extra = many_rules(w, 25_000)
    assert extra >= 50_000
    asked = w.requests().limit(40)
    few = compose.authorize(asked, w.rules(), "pub-1")
    crowded(monkeypatch)
    answers, cited = compose.authorize_rows(asked, rules, "pub-1", limit=3)
    fields = ["request_id", "state", "decision", "reason_code", "decision_id"]
    assert same(few.select(*fields), answers.select(*fields))
    before = few.select("request_id", F.size("instructions").alias("n")).where("n > 0")
    after = cited.groupBy("request_id").agg(F.count("*").alias("n"))
    grown = after.join(before.withColumnRenamed("n", "b"), "request_id").where("n > b + 20000")
    assert after.count() == before.count() and grown.count() > 0


def test_cited_rows_equal_the_lists(w):
    whole = compose.authorize(w.requests(), w.rules(), "pub-1").select("request_id", "actor", "instant", F.explode("instructions").alias("c"))
    assert same(whole.select("request_id", "actor", "instant", "c.*"), compose.cited_rows(w.requests(), w.rules()))


def test_an_actor_with_most_calls_is_swept(w):
    """Beyond the limit grants and calls are swept in one order: equal to the broadcast, null ids and overlaps included."""
    answers = compose.authorize(w.requests(), w.rules(), "pub-1")
    third = F.pmod(F.xxhash64("request_id"), F.lit(3))
    busy = answers.withColumn("actor", F.when(third == 0, F.lit(None)).when(third == 1, F.lit(1)).otherwise(F.col("actor")))
    busy = busy.withColumn("request_id", F.when(F.col("request_id") % 7 != 0, F.col("request_id")))
    days = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(int(id * 37 % 30), int(id % 24))"
    grants = w.spark.range(400).selectExpr(
        "if(id % 2 = 0, 1, id % 60) AS actor", "'approval_required' AS kind", "if(id % 5 = 0, 'revoked', 'active') AS state", f"{days} AS valid_from",
        f"if(id % 41 = 0, NULL, {days} + make_dt_interval(int(id % 3), 7)) AS valid_until",
    )
    small, large = (compose.satisfy_conditions(busy, grants, limit=n).select("request_id", "actor", "instant", "conditions", "has_approval", "all_satisfied") for n in (100_000, 0))
    assert same(small, large) and large.where("has_approval").count() > 0
