"""From rule decisions to one typed answer per request."""

from pyspark.sql import Window, functions as F
from pyspark.sql.types import ArrayType

from stewardry import vocab
from stewardry.functions.expr import decision_of, lookup, severity
from stewardry.functions.scale import fits, reference_join
from stewardry.operators import decide
from stewardry.operators.asof import asof_join
from stewardry.operators.prepare import prepared, publication_at, receipts, signature
from stewardry.schemas import CONDITION, OBLIGATION
from stewardry.session import materialize

# Scenarios are a closed vocabulary; a log that names more than this is joined with all rules.
ASKED_SCENARIOS = 1_000
# What the caller may do next, by decision.
NEXT_ACTIONS = {
    "allow": "Go ahead; keep the decision id as proof.",
    "log_only": "Go ahead; keep the decision id as proof.",
    "retain": "Go ahead, and hold the data as long as the rule says.",
    "conditional": "Meet every listed condition and ask once more.",
    "mask_full": "Mask the named columns first.",
    "mask_partial": "Mask the named columns first.",
    "deny": "Stop: a rule in force forbids it.",
    "require_review": "Wait for someone responsible for the rules.",
}
NEXT_BY_REASON = {
    vocab.REASON_NO_STATE: "No rule speaks of this asset yet; one has to be served first.",
    vocab.REASON_NOT_EFFECTIVE: "Rules exist, but none at this instant; ask for another date.",
    vocab.REASON_CONFLICT: "Two rules contradict each other; their owners have to settle it.",
    vocab.REASON_WINDOW: "Name the purpose, and the instant it is meant for.",
    vocab.REASON_CONSENT: "State a purpose that has a consent rule.",
    vocab.REASON_SCENARIO: "Name a scenario key.",
}


def answer(n_rules, n_live, conflicted, worst, rule_reason):
    """State, decision and reason code from the per-request summary."""
    uncovered = n_live == 0
    decided = F.when(
        ~uncovered,
        F.when(conflicted, F.lit("require_review")).otherwise(
            F.coalesce(decision_of(worst), F.lit("require_review"))
        ),
    )
    state = (
        F.when(uncovered, "not_enough_published_state")
        .when(decided == "require_review", "review_required")
        .otherwise("answered")
    )
    reason = (
        F.when(n_rules == 0, vocab.REASON_NO_STATE)
        .when(uncovered, vocab.REASON_NOT_EFFECTIVE)
        .when(conflicted, vocab.REASON_CONFLICT)
        .when(decided == "require_review", F.coalesce(rule_reason, F.lit(vocab.REASON_REVIEW)))
    )
    return {"state": state, "decision": decided, "reason_code": reason}


def coverage(pairs):
    """Rules found and rules in force per request (exploded form, left join)."""
    return pairs.groupBy("request_id").agg(
        F.count("rule.rule_id").alias("n_rules"),
        F.count_if("in_force").alias("n_live"),
    )


def compose_pairs(pairs, key="request_id"):
    """Exploded form: one aggregate per request, partial before the shuffle."""
    live = F.col("in_force")
    summary = pairs.groupBy(key).agg(
        F.count("rule.rule_id").alias("n_rules"),
        F.count_if(live).alias("n_live"),
        F.coalesce(F.bool_or(live & (F.col("rule.conflict_status") != "none")), F.lit(False)).alias("conflicted"),
        F.min("severity").alias("worst"),
        F.min("rule_reason").alias("rule_reason"),
    )
    columns = answer(*[F.col(c) for c in ("n_rules", "n_live", "conflicted", "worst", "rule_reason")])
    return summary.select(
        key, "n_rules", "n_live", *[c.alias(name) for name, c in columns.items()]
    )


def ranked_pairs(pairs):
    """Cited order of the rules of each request; groups are as long as one scope's rules."""
    order = Window.partitionBy("request_id").orderBy(
        F.col("rule.column").isNull().cast("int"),
        F.col("rule.band").desc(),
        F.col("rule.weight").desc(),
        "severity",
        "rule.policy",
        "rule.rule_id",
    )
    return pairs.filter("decision IS NOT NULL").withColumn("rank", F.row_number().over(order))


def _cited(said, q):
    rule, decided = said["rule"], said["decision"]
    return F.struct(
        rule["column"].isNull().cast("int").alias("table_grain"),
        (-rule["band"]).alias("band_rank"),
        (-rule["weight"]).alias("weight_rank"),
        severity(decided).alias("severity"),
        rule["policy"].alias("policy"),
        rule["rule_id"].alias("rule_id"),
        rule["version"].alias("version"),
        rule["family"].alias("family"),
        rule["instruction_key"].alias("instruction_key"),
        decided.alias("decision"),
        decide.reason_code(rule, q, decided).alias("reason"),
        (rule["conflict_status"] != "none").alias("conflicted"),
        decide.conditions(rule, q, decided).alias("conditions"),
        decide.obligations(rule, decided).alias("obligations"),
    )


def authorize(requests, rules, publication_id="current", limit=decide.BROADCAST_ROWS):
    """One typed answer per request (array form).

    With a rule table within the broadcast limit no request row is shuffled:
    rules of a scope arrive as one array and are evaluated in place.
    """
    q = decide.context()
    matched = decide.with_rule_arrays(prepared(requests), rules, limit)
    live = F.filter("rules", lambda r: decide.effective(r, q["instant"]))
    cited = (
        matched.withColumn("n_rules", F.greatest(F.coalesce(F.size("rules"), F.lit(0)), F.lit(0)))
        .withColumn("live", live)
        .withColumn("n_live", F.greatest(F.coalesce(F.size("live"), F.lit(0)), F.lit(0)))
        .withColumn("conflicted", F.coalesce(F.exists("live", lambda r: r["conflict_status"] != "none"), F.lit(False)))
        .withColumn("judged", decide.judged(F.col("live"), q))
        .withColumn("instructions", F.sort_array(F.transform("judged", lambda x: _cited(x, q))))
        .drop("rules", "live", "judged")
    )
    summary = answer(
        F.col("n_rules"),
        F.col("n_live"),
        F.col("conflicted"),
        F.array_min(F.transform("instructions", lambda c: c["severity"])),
        F.array_min(F.transform("instructions", lambda c: c["reason"])),
    )
    conditions = F.sort_array(F.flatten(F.transform("instructions", lambda c: c["conditions"])))
    duties = F.sort_array(F.flatten(F.transform("instructions", lambda c: c["obligations"])))
    prohibitions = F.transform(
        F.filter("instructions", lambda c: c["decision"] == "deny"),
        lambda c: F.struct(c["policy"].alias("policy"), c["instruction_key"].alias("instruction_key")),
    )
    ids = receipts(F.lit(publication_id), F.col("signature"), F.col("instant"))
    return (
        cited.withColumns(summary)
        .withColumn("can_proceed_now", F.coalesce(F.col("decision") == "allow", F.lit(False)))
        .withColumn("conditions", F.coalesce(conditions, F.array().cast(ArrayType(CONDITION))))
        .withColumn("obligations", F.coalesce(duties, F.array().cast(ArrayType(OBLIGATION))))
        .withColumn("prohibitions", prohibitions)
        .withColumn("next_action", next_action())
        .withColumn("publication_id", F.lit(publication_id))
        .withColumn("signature", signature("authorize"))
        .withColumn("decision_id", F.when(F.col("n_live") > 0, ids["decision_id"]))
        .withColumn("authorization_id", ids["authorization_id"])
        .drop("conflicted")
    )


def authorize_rows(requests, rules, publication_id="current", limit=decide.BROADCAST_ROWS):
    """Full answers as two tables, whatever the size of the rules or of a scope: (answers, cited).

    ``answers`` has one row per request with the columns of :func:`authorize` that hold no list.
    ``cited`` has one row per rule in force that speaks, in the cited order (``rank``), with the
    conditions and obligations of that rule; prohibitions are its rows with decision ``deny``.
    ``row_id`` ties them, so null and repeated request ids stay apart. Equal in content to the arrays.
    """
    asked = prepared(requests).withColumn("row_id", F.monotonically_increasing_id())
    asked = materialize(asked, "asked")
    pairs = decide.decided_pairs(asked, rules, "left", limit, spread_by="row_id")
    ids = receipts(F.lit(publication_id), F.col("signature"), F.col("instant"))
    answers = (
        asked.join(compose_pairs(pairs, "row_id"), "row_id")
        .withColumn("can_proceed_now", F.coalesce(F.col("decision") == "allow", F.lit(False)))
        .withColumn("next_action", next_action())
        .withColumn("publication_id", F.lit(publication_id))
        .withColumn("signature", signature("authorize"))
        .withColumn("decision_id", F.when(F.col("n_live") > 0, ids["decision_id"]))
        .withColumn("authorization_id", ids["authorization_id"])
    )
    said = {"rule": F.col("rule"), "decision": F.col("decision")}
    cited = pairs.filter("decision IS NOT NULL").select("row_id", "request_id", _cited(said, decide.context()).alias("c"))
    rank = F.row_number().over(Window.partitionBy("row_id").orderBy("c"))
    return answers, cited.withColumn("rank", rank).select("row_id", "request_id", "rank", "c.*")


def cited_rows(requests, rules, limit=decide.BROADCAST_ROWS):
    """One row per request and rule in force that speaks, with the rule's conditions and obligations.

    The rows of :func:`authorize_rows` without their rank; a scope may hold any number of rules. No request is
    shuffled while the rule table fits the broadcast limit.
    """
    pairs = decide.decided_pairs(prepared(requests), rules, "inner", limit).filter("decision IS NOT NULL")
    said = {"rule": F.col("rule"), "decision": F.col("decision")}
    return pairs.select("request_id", "actor", "instant", _cited(said, decide.context()).alias("c")).select(
        "request_id", "actor", "instant", "c.*"
    )


def next_action():
    return F.coalesce(
        lookup(F.col("reason_code"), NEXT_BY_REASON), lookup(F.col("decision"), NEXT_ACTIONS)
    )


def asked_rules(requests, rules):
    """Rules of the scenarios that ``requests`` ask about: no other can match, so none of them is moved."""
    asked = requests.select("scenario").distinct()
    return rules.join(F.broadcast(asked), "scenario", "left_semi") if fits(asked, ASKED_SCENARIOS) else rules


def decide_in_place(requests, rules, limit=decide.BROADCAST_ROWS, by=()):
    """State and decision only: the narrow hot path. One row out per row in, whatever its ``request_id``.

    Array form while the rule table fits the broadcast limit. Beyond it, rules join
    as rows and one aggregate per request composes them, whatever a scope's size. The
    rows are numbered and written first, so null and repeated ids stay apart and a
    task run again reads the same numbers.
    """
    asked = prepared(requests)
    columns_out = [*asked.columns, "n_rules", "n_live", "state", "decision", "reason_code"]
    if not fits(rules, limit):
        numbered = materialize(asked.withColumn("_row", F.monotonically_increasing_id()), "asked")
        pairs = decide.decided_pairs(numbered, asked_rules(numbered, rules), "left", limit, by, spread_by="_row")
        return numbered.join(compose_pairs(pairs, "_row"), "_row").select(*columns_out)
    q = decide.context()
    matched = decide.with_rule_arrays(asked, rules, limit, small=True, by=by)
    live = F.filter("rules", lambda r: decide.effective(r, q["instant"]))
    outcome = F.transform(
        "judged",
        lambda x: F.struct(
            severity(x["decision"]).alias("severity"),
            decide.reason_code(x["rule"], q, x["decision"]).alias("reason"),
        ),
    )
    cited = (
        matched.withColumn("n_rules", F.greatest(F.coalesce(F.size("rules"), F.lit(0)), F.lit(0)))
        .withColumn("live", live)
        .withColumn("n_live", F.greatest(F.coalesce(F.size("live"), F.lit(0)), F.lit(0)))
        .withColumn("conflicted", F.coalesce(F.exists("live", lambda r: r["conflict_status"] != "none"), F.lit(False)))
        .withColumn("judged", decide.judged(F.col("live"), q))
        .withColumn("outcomes", outcome)
    )
    columns = answer(
        F.col("n_rules"),
        F.col("n_live"),
        F.col("conflicted"),
        F.array_min(F.transform("outcomes", lambda o: o["severity"])),
        F.array_min(F.transform("outcomes", lambda o: o["reason"])),
    )
    return cited.withColumns(columns).select(*columns_out)


def decide_as_published(requests, rules, publications, limit=decide.BROADCAST_ROWS):
    """Decide a log that spans publications: each request meets the rules served when it
    was asked. ``rules`` carry ``publication_id``."""
    asked = requests.withColumn("publication_id", publication_at(F.col("requested_at"), publications))
    return decide_in_place(asked, rules, limit, by=("publication_id",))


# An exception without an end.
FOR_EVER = "9999-12-31 00:00:00"


# --- exceptions -------------------------------------------------------------------


def satisfy_conditions(decisions, exceptions, limit=decide.BROADCAST_ROWS):
    """Mark approvals an active exception of the same subject satisfies.

    ``exceptions``: actor, kind, state, valid_from, valid_until. Few of them are cut into days and
    sent to the log. Beyond the limit grants and the calls that ask are swept in one order of
    actor and time: a call is approved when the latest end of all grants begun before
    it lies after it. An actor with a large share of the log is spread over tasks, and no pair is
    written. Consent is never satisfied by an exception and a denial is never lifted.
    """
    active = exceptions.filter((F.col("state") == "active") & (F.col("kind") == "approval_required"))
    asks = F.coalesce(F.exists("conditions", lambda c: c["kind"] == "approval_required"), F.lit(False))
    standing = active.filter("valid_until IS NULL").groupBy("actor").agg(F.min("valid_from").alias("standing_from"))
    days = (
        active.filter("valid_from < valid_until")
        .withColumn("day", F.explode(F.sequence(F.to_date("valid_from"), F.to_date("valid_until"))))
        .select("actor", "day", "valid_from", "valid_until")
    )
    if fits(days, limit):
        asked = reference_join(
            decisions.withColumn("_day", F.to_date("instant")), standing, ["actor"], "left",
            spread_by=["request_id"], derived="standing",
        )
        # the flag speaks of rows that ask for an approval, in either form
        marked = _has_approval(asked, F.broadcast(days)).withColumn("has_approval", F.col("has_approval") & asks)
        marked = marked.drop("_day", "standing_from")
    else:
        # only rows that ask for an approval are moved to meet the exceptions
        until = F.coalesce(F.col("valid_until").cast("timestamp_ntz"), F.lit(FOR_EVER).cast("timestamp_ntz"))
        grants = active.select("actor", "valid_from", until.alias("until"))
        swept = asof_join(decisions.filter(asks), grants, ["actor"], "instant", "valid_from", ["until"], largest=True)
        approved = F.coalesce(F.col("instant").cast("timestamp_ntz") < F.col("found.until"), F.lit(False))
        marked = swept.withColumn("has_approval", approved).drop("found")
        marked = marked.unionByName(decisions.filter(~asks).withColumn("has_approval", F.lit(False)))
    met = F.transform(
        "conditions",
        lambda c: c.withField("satisfied", (c["kind"] == "approval_required") & F.col("has_approval")),
    )
    return (
        marked.withColumn("conditions", met)
        .withColumn(
            "all_satisfied",
            (F.col("decision") == "conditional")
            & (F.size("conditions") > 0)
            & F.forall("conditions", lambda c: c["satisfied"]),
        )
    )


def _has_approval(asked, days):
    return asked.sparkSession.sql(
        """
        SELECT d.*, coalesce(d.standing_from <= d.instant, FALSE) OR EXISTS (
            SELECT 1 FROM {days} e
            WHERE e.actor = d.actor AND e.day = d._day
              AND e.valid_from <= d.instant AND d.instant < e.valid_until
        ) AS has_approval
        FROM {asked} d
        """,
        days=days,
        asked=asked,
    )


def can_proceed(satisfied):
    """Allow proceeds; a conditional with every condition met is flagged apart."""
    return satisfied.withColumn(
        "can_proceed_with_exception", F.coalesce(F.col("all_satisfied"), F.lit(False))
    )


def context_facts(decisions, tables):
    """Sensitivity, category and PII of the asset; ``tables`` has one row per table."""
    return reference_join(
        decisions, tables, ["database", "schema", "table"], "left", spread_by=["request_id"]
    )
