"""Publication flips, as-of joins, references of references, sketches: against plain Python over small data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stewardry.operators import asof, audit, compose, contract, publications
from stewardry.plans.workload import Workload

FOLDER = "/root/testdata/sf0.001"


def halves(w):
    rules = w.rules()
    return rules.filter("policy <> 'audience use'"), rules.filter("policy NOT IN ('use guardrails', 'email masking')")


def test_fingerprints_ignore_order_but_not_content(spark):
    rules = Workload(spark, FOLDER).rules()
    again = rules.orderBy(F.col("rule_id").desc()).repartition(3)
    assert publications.changed_scopes(rules, again).count() == 0
    twice = rules.unionByName(rules.limit(1))
    one = rules.limit(1).first()
    assert [r["change"] for r in publications.changed_scopes(rules, twice).collect()] == ["changed"]
    less = rules.where(F.col("rule_id") != one["rule_id"])
    changes = {r["change"] for r in publications.changed_scopes(rules, less).collect()}
    assert changes <= {"changed", "removed"} and len(changes) == 1
    assert {r["change"] for r in publications.changed_scopes(rules.limit(0), rules).collect()} == {"added"}
    moved = rules.withColumn("band", F.when(F.col("rule_id") == one["rule_id"], F.col("band") + 1).otherwise(F.col("band")))
    assert publications.changed_scopes(rules, moved).count() == 1


def test_flips_equal_deciding_everything(spark):
    w = Workload(spark, FOLDER)
    before, after = halves(w)
    names = ["request_id", "state", "decision", "reason_code"]
    old = {r[0]: tuple(r)[1:] for r in compose.decide_in_place(w.requests(), before).select(*names).collect()}
    new = {r[0]: tuple(r)[1:] for r in compose.decide_in_place(w.requests(), after).select(*names).collect()}
    flips = publications.publication_flips(w.requests(), before, after)
    got = {r["request_id"]: (tuple(r[f"before_{c}"] for c in names[1:]), tuple(r[f"after_{c}"] for c in names[1:])) for r in flips.collect()}
    assert got == {i: (old[i], new[i]) for i in old if old[i] != new[i]} and got
    assert publications.publication_flips(w.requests(), before, before).count() == 0


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)


def test_as_of_against_brute_force(spark):
    rnd = random.Random(2)
    versions = [(rnd.choice("abc"), f"v{i}", at(rnd.randint(0, 300)), None) for i in range(60)]
    versions = [(k, v, s, s + dt.timedelta(minutes=rnd.randint(1, 90)) if rnd.random() < 0.5 else None) for k, v, s, _ in versions]
    versions += [("d", "always", None, None), ("d", "later", at(50), None), (None, "nobody", at(0), None), ("e", "over", None, at(3))]
    records = [(i, rnd.choice(["a", "b", "c", "d", "e", "zz", None]), at(rnd.randint(-10, 320)) if i % 50 else None) for i in range(900)]
    records += [(1, "a", at(7)), (1, "a", at(7))]

    def expect(key, when):
        began = [(s is not None, s, v, u) for k, v, s, u in versions if k == key and key is not None and when is not None and (s is None or s <= when)]
        if not began:
            return None
        _, _, v, until = max(began, key=lambda x: (x[0], x[1] or at(0), x[2]))
        return v if until is None or when < until else None

    right = spark.createDataFrame(versions, "law string, name string, effective_from timestamp_ntz, effective_until timestamp_ntz")
    left = spark.createDataFrame(records, "id long, law string, day timestamp_ntz")
    got = asof.in_force_at(left, right, ["law"], "day")
    assert sorted(((r["id"], r["law"], r["day"], r["in_force"] and r["in_force"]["name"]) for r in got.collect()), key=str) == sorted(
        ((i, k, d, expect(k, d)) for i, k, d in records), key=str
    )
    assert asof.in_force_at(left.where("false"), right, ["law"], "day").count() == 0
    assert asof.in_force_at(left, right.where("false"), ["law"], "day").where("in_force is null").count() == len(records)


def test_as_of_with_many_versions_of_one_key(spark):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    minutes = lambda c: start + F.expr(f"make_dt_interval(0, 0, {c})")
    versions = spark.range(100_000).select(F.lit("k").alias("law"), F.col("id").alias("version"), minutes("int(id) * 10").alias("effective_from"))
    versions = versions.withColumn("effective_until", F.lit(None).cast("timestamp_ntz"))
    records = spark.range(50_000).select("id", F.lit("k").alias("law"), minutes("int(id) * 20 + 5").alias("day"))
    got = asof.in_force_at(records, versions, ["law"], "day")
    assert got.where("in_force.version = 2 * id").count() == 50_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_references_of_references(spark):
    nodes = [(f"c{n}.{i}", f"c{n}.{i + 1}" if i < n else None, None if i < n else f"end {n}") for n in (1, 2, 3, 7, 31, 32, 33, 50) for i in range(n + 1)]
    nodes += [("x", "y", None), ("y", "z", None), ("z", "x", None), ("into", "x", None), ("self", "self", None), ("lost", "nowhere", None), ("far", "lost", None)]
    nodes += [("empty", None, None), (None, "x", None), ("c1.0", "c1.1", None)] + [(f"many{i}", "c7.0", None) for i in range(300)]
    found = contract.resolve_references(spark.createDataFrame(nodes, "ref string, target string, value string"))
    got = {r["key"]: (r["resolved"], r["steps"], r["problem"]) for r in found.collect()}
    assert len(got) == len({n[0] for n in nodes if n[0]}) == found.count()
    for n in (1, 2, 3, 7, 31, 32, 33, 50):
        assert [got[f"c{n}.{i}"] for i in range(n + 1)] == [(f"end {n}", n - i, None) for i in range(n + 1)]
    assert {got[k] for k in ("x", "y", "z", "into", "self")} == {(None, None, "cycle")}
    assert got["lost"] == (None, 0, "unknown") and got["far"] == (None, 1, "unknown") and got["empty"] == (None, 0, None)
    assert got["many5"] == ("end 7", 8, None)
    assert contract.resolve_references(spark.createDataFrame([], "ref string, target string, value string")).count() == 0


def test_sketches_unite_to_the_distinct_count(spark):
    day = F.expr("date_add(DATE '2024-01-01', int(id % 9))").alias("requested_at")
    rows = spark.range(200_000).select(*[F.lit("x").alias(c) for c in audit.TABLE], day, (F.col("id") % 30_000).alias("actor"))
    rows = rows.unionByName(rows.limit(5).withColumn("actor", F.lit(None).cast("long")))
    sketches = audit.actor_sketches(rows)
    assert sketches.count() == 9
    got = audit.united_actors(sketches).first()
    assert abs(got["actors"] - 30_000) <= 3 * audit.SKETCH_ERROR * 30_000 and got["n_days"] == 9
