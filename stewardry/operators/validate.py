"""Query references against served rules; no SQL text is parsed.

Input is one row per query and table reference: the columns it names, whether it
is a star, the declared intent and the time bounds the query states.
"""

from pyspark.sql import Window, functions as F

from stewardry.functions.expr import purpose_category, severity
from stewardry.functions.scale import BROADCAST_ROWS, fits, reference_join, salted_join
from stewardry.operators import decide
from stewardry.session import materialize

TABLE = ["database", "schema", "table"]
# Recorded guard routes per verdict.
ROUTES = {"pass": "approved", "warn": "revised", "fail": "blocked"}


def qualify(refs):
    """Complete 1-, 2- and 3-part names from the query's defaults."""
    parts = F.split("ref_name", r"\.")
    n = F.size(parts)
    return refs.withColumns(
        {
            "database": F.when(n >= 3, F.element_at(parts, -3)).otherwise(F.col("default_db")),
            "schema": F.when(n >= 2, F.element_at(parts, -2)).otherwise(F.col("default_sch")),
            "table": F.element_at(parts, -1),
        }
    )


def drop_ctes(qualified):
    """A bare name the query's own WITH declares is not a table."""
    declared = ~F.col("ref_name").contains(".") & F.array_contains("ctes", F.col("table"))
    return qualified.filter(~F.coalesce(declared, F.lit(False)))


def expand_star(refs, catalog):
    """A star makes every column of the table participate, in place."""
    known = catalog.groupBy(*TABLE).agg(F.sort_array(F.collect_set("column")).alias("all_columns"))
    joined = reference_join(refs, known, TABLE, "left", spread_by=["query_id", "ref_no"])
    return joined.withColumn(
        "columns",
        F.when(F.col("star"), F.array_distinct(F.concat(F.col("columns"), F.coalesce("all_columns", F.array().cast("array<string>"))))).otherwise(F.col("columns")),
    ).drop("all_columns")



def window_proved(rule, q):
    lower, upper = decide.window_bounds(rule, q)
    return F.coalesce((q["window_lower"] >= lower) & (q["window_upper"] <= upper), F.lit(False))


def proved(rule, decided, q):
    """As for requests, but an access window must be proved by the query's own bounds."""
    window = (rule["family"] == "access_window") & (decided == "conditional")
    return F.when(window, F.when(window_proved(rule, q), "allow").otherwise("deny")).otherwise(decided)


def reason(rule, decided):
    return F.concat(rule["policy"], F.lit(": "), rule["instruction_key"], F.lit(" → "), decided)


def context():
    """Reference fields a rule may look at; a query has no transfer destination."""
    none = F.lit(None).cast("string")
    absent = ("operation", "dest_system", "dest_jurisdiction", "consumer_jurisdiction")
    present = ("role", "purpose", "purpose_category", "as_of", "requested_at", "instant", "scenario", "columns",
               "window_lower", "window_upper")
    return {**{n: none for n in absent}, **{n: F.col(n) for n in present}}


def _packed(rules):
    return rules.select(
        *TABLE, F.struct(*[c for c in rules.columns if c not in TABLE]).alias("rule")
    )


NO_INTENT = ""


def _by_intent(packed):
    """Table rules, once per intent that meets them."""
    intents = F.array_compact(
        F.array(F.col("rule.scenario"), F.when(F.col("rule.family") == "role_grant", F.lit(NO_INTENT)))
    )
    return packed.filter("rule.column IS NULL").withColumn("intent", F.explode(intents))


def _prepared(refs):
    return refs.withColumn("instant", F.coalesce("as_of", "requested_at")).withColumn(
        "purpose_category", purpose_category(F.col("purpose"))
    )


def _meet_rules(refs, rules, limit):
    """References with the column rules of their table and the table rules of their intent.

    Two short arrays instead of every rule of the table: table rules are keyed by
    scenario, role grants also by the absence of one.
    """
    packed = _packed(rules)
    column = F.when(F.col("rule.column").isNotNull(), F.col("rule"))
    per_table = packed.groupBy(*TABLE).agg(F.collect_list(column).alias("column_rules"), F.lit(True).alias("governed"))
    per_intent = (
        _by_intent(packed)
        .groupBy(*TABLE, "intent")
        .agg(F.collect_list("rule").alias("intent_rules"))
    )
    asked = refs.withColumn("intent", F.coalesce("scenario", F.lit(NO_INTENT)))
    if fits(packed, limit):
        met = asked.join(F.broadcast(per_table), TABLE, "left").join(F.broadcast(per_intent), [*TABLE, "intent"], "left")
    else:
        spread = ["query_id", "ref_no"]
        met = salted_join(asked, per_table, TABLE, "left", spread_by=spread)
        met = salted_join(met, per_intent, [*TABLE, "intent"], "left", spread_by=spread)
    none = F.array().cast(met.schema["intent_rules"].dataType)
    return met.withColumns(
        {
            "governed": F.coalesce("governed", F.lit(False)),
            "column_rules": F.coalesce("column_rules", none),
            "intent_rules": F.coalesce("intent_rules", none),
        }
    ).drop("intent")


def findings(refs, rules, limit=BROADCAST_ROWS):
    """One finding per reference: participating rules in cited order, evaluated in place."""
    joined = _meet_rules(_prepared(refs), rules, limit)
    q = context()
    named = F.filter(
        "column_rules", lambda r: decide.effective(r, q["instant"]) & F.array_contains(q["columns"], r["column"])
    )
    meant = F.filter("intent_rules", lambda r: decide.effective(r, q["instant"]))
    live = F.concat(named, meant)

    return (
        joined.withColumn("judged", decide.judged(live, q))
        .withColumn(
            "judged",
            F.transform(
                "judged",
                lambda x: F.struct(x["rule"].alias("rule"), proved(x["rule"], x["decision"], q).alias("decision")),
            ),
        )
        .withColumn(
            "instructions",
            F.coalesce(F.sort_array(F.transform("judged", lambda x: _cited(x["rule"], x["decision"]))), F.array().cast(_cited_type())),
        )
        .withColumn("status", F.when(F.col("governed"), "evaluated").otherwise("not_enough_published_state"))
        .withColumn("finding_decision", F.get("instructions", F.lit(0))["decision"])
        .drop("column_rules", "intent_rules", "judged")
    )


def finding_rows(refs, rules, limit=BROADCAST_ROWS):
    """Findings as two tables, whatever the size of the rules or of a table's share: (findings, cited).

    ``findings`` has one row per reference with ``worst`` (severity) and ``finding_decision``, which
    :func:`verdicts` takes too. ``cited`` has one row per participating rule in the cited order (``rank``).
    ``row_id`` ties them. Equal in content to :func:`findings`.
    """
    asked = _prepared(refs).withColumn("row_id", F.monotonically_increasing_id())
    asked, packed = materialize(asked, "asked-refs"), _packed(rules)
    meets = {"spread_by": ["row_id"], "limit": limit}
    of_column = packed.filter("rule.column IS NOT NULL").withColumn("meets", F.col("rule.column"))
    named = reference_join(
        asked.withColumn("meets", F.explode(F.array_distinct("columns"))), of_column, [*TABLE, "meets"], **meets
    )
    meant = reference_join(
        asked.withColumn("meets", F.coalesce("scenario", F.lit(NO_INTENT))),
        _by_intent(packed).withColumnRenamed("intent", "meets"), [*TABLE, "meets"], **meets,
    )
    rule, q = F.col("rule"), context()
    said = (
        named.unionByName(meant)
        .filter(decide.effective(rule, q["instant"]))
        .withColumn("said", decide.decision(rule, q))
        .filter("said IS NOT NULL")
        .withColumn("said", proved(rule, F.col("said"), q))
        .select("row_id", "query_id", "ref_no", _cited(rule, F.col("said")).alias("c"))
    )
    first = said.groupBy("row_id").agg(
        F.min("c.severity").alias("worst"), F.min("c")["decision"].alias("finding_decision")
    )
    known = packed.select(*TABLE).distinct().withColumn("governed", F.lit(True))
    found = (
        reference_join(asked, known, TABLE, "left", derived="governed", **meets)
        .withColumn("governed", F.coalesce("governed", F.lit(False)))
        .withColumn("status", F.when(F.col("governed"), "evaluated").otherwise("not_enough_published_state"))
        .join(first, "row_id", "left")
    )
    rank = F.row_number().over(Window.partitionBy("row_id").orderBy("c"))
    return found, said.withColumn("rank", rank).select("row_id", "query_id", "ref_no", "rank", "c.*")


def _cited(r, decided):
    return F.struct(
        r["column"].isNull().cast("int").alias("table_grain"),
        (-r["band"]).alias("band_rank"),
        (-r["weight"]).alias("weight_rank"),
        severity(decided).alias("severity"),
        r["policy"].alias("policy"),
        r["rule_id"].alias("rule_id"),
        r["version"].alias("version"),
        r["instruction_key"].alias("instruction_key"),
        r["scenario"].alias("scenario"),
        r["column"].alias("column"),
        decided.alias("decision"),
        reason(r, decided).alias("reason"),
    )


def _cited_type():
    return (
        "array<struct<table_grain:int,band_rank:int,weight_rank:double,severity:int,policy:string,rule_id:bigint,"
        "version:int,instruction_key:string,scenario:string,column:string,decision:string,reason:string>>"
    )


def verdicts(found, keep=()):
    """Worst over all participating rules and ungoverned references of a query.

    ``keep`` names columns that are the same on every reference of a query.
    """
    if "worst" not in found.columns:
        found = found.withColumn("worst", F.array_min(F.transform("instructions", lambda c: c["severity"])))
    return (
        found.groupBy("query_id")
        .agg(
            F.count("*").alias("n_refs"),
            F.count_if(~F.col("governed")).alias("n_ungoverned"),
            F.min("worst").alias("worst"),
            F.bool_or(F.coalesce(F.col("finding_decision") == "require_review", F.lit(False))).alias("needs_review"),
            *[F.any_value(c).alias(c) for c in keep],
        )
        .select(
            "query_id",
            *keep,
            "n_refs",
            "n_ungoverned",
            F.when(F.col("worst") == 1, "fail")
            .when((F.col("worst") <= 5) | (F.col("n_ungoverned") > 0), "warn")
            .otherwise("pass")
            .alias("verdict"),
            F.when(F.col("n_ungoverned") == F.col("n_refs"), "not_enough_published_state")
            .when(F.col("needs_review"), "review_required")
            .otherwise("answered")
            .alias("state"),
        )
    )


def judge(findings):
    """Verdict and state of a query whose findings stand on one row."""
    worst = F.array_min(
        F.transform(F.flatten(F.transform(findings, lambda f: f["instructions"])), lambda i: i["severity"])
    )
    open_refs = F.exists(findings, lambda f: ~f["governed"])
    review = F.exists(
        findings, lambda f: F.coalesce(F.get(f["instructions"], F.lit(0))["decision"] == "require_review", F.lit(False))
    )
    return {
        "verdict": F.when(worst == 1, "fail").when((worst <= 5) | open_refs, "warn").otherwise("pass"),
        "state": F.when(F.forall(findings, lambda f: ~f["governed"]), "not_enough_published_state")
        .when(review, "review_required")
        .otherwise("answered"),
    }


def fingerprint(sql):
    return F.concat(F.lit("sha256:"), F.sha2(F.trim(sql), 256))


def intent_flips(judged):
    """Fingerprints whose verdict changes with intent, purpose, role or instant."""
    flags = [F.bool_or(F.col("verdict") == v).alias(f"has_{v}") for v in ROUTES]
    counted = judged.groupBy("fingerprint").agg(F.count("*").alias("n_queries"), *flags)
    kinds = sum((F.col(f"has_{v}").cast("int") for v in ROUTES), F.lit(0))
    return counted.filter(kinds > 1)


def route(verdict):
    """approved; revised to a safe aggregate; blocked without any SQL."""
    out = F.lit("blocked")
    for name, label in ROUTES.items():
        out = F.when(verdict == name, F.lit(label)).otherwise(out)
    return out


def flagged_reasons(found):
    """Distinct deny and mask reasons of a query in order of first appearance.

    Reasons fold to their first position before they are gathered, so a group is
    no longer than the distinct rules of the query's tables.
    """
    flagged = found.select(
        "query_id", "ref_no", F.posexplode("instructions").alias("pos", "c")
    ).filter(F.col("c.decision").isin("deny", "mask_full", "mask_partial"))
    first = flagged.groupBy("query_id", F.col("c.reason").alias("reason")).agg(
        F.min(F.struct("ref_no", "pos")).alias("at")
    )
    return first.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "reason"))), lambda x: x["reason"]).alias("reasons")
    )
