"""Queries over the request log: preparation, rule decisions, composition."""

from pyspark.sql import functions as F

from stewardry.functions.expr import purpose_category
from stewardry.operators import compose, decide, prepare, publications
from stewardry.plans import estate
from stewardry.plans.registry import clone, cte, framed_sql, query, receipt_sql
from stewardry.session import materialize


def stamp(name, alias=None):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(alias or name)


def dstamp(expr, alias):
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {alias}"


# --- request preparation -----------------------------------------------------------

SIGNATURE = framed_sql(
    "'authorize'", "strftime(as_of, '%Y-%m-%d %H:%M:%S')", "col", "consumer_jurisdiction", "db", "dest_jurisdiction",
    "dest_system", "operation", "purpose", "scenario", "sch", "tbl", "role",
)
cte("signed", f"SELECT *, {SIGNATURE} AS signature FROM requests", "requests")
# The cases on record: every signature first seen in the first half of the month.
cte(
    "cases",
    "SELECT signature, min(request_id) AS case_id FROM signed WHERE requested_at < @TS('2024-01-16 00:00:00') GROUP BY 1",
    "signed",
)


def signed(w):
    return prepare.with_signature(w.requests())


def cases(w):
    early = F.col("requested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    known = signed(w).filter(early).groupBy("signature").agg(F.min("request_id").alias("case_id"))
    return materialize(known, "cases")


@query("request_signature", "SELECT request_id, signature FROM signed", ["signed"])
def request_signature(w):
    return signed(w).select("request_id", "signature")


@query(
    "request_exact_match",
    "SELECT request_id, case_id FROM signed JOIN cases USING (signature)",
    ["signed", "cases"],
)
def request_exact_match(w):
    return prepare.match_cases(signed(w), cases(w)).select("request_id", "case_id")


@query(
    "request_unmatched",
    "SELECT request_id, signature FROM signed WHERE signature NOT IN (SELECT signature FROM cases)",
    ["signed", "cases"],
)
def request_unmatched(w):
    return prepare.unmatched(signed(w), cases(w)).select("request_id", "signature")


_HITS = " + ".join(
    "CASE WHEN " + " OR ".join(f"contains(lower(use_text), '{k}')" for k, v in estate.KEYWORDS.items() if v == s)
    + " THEN 1 ELSE 0 END"
    for s in sorted(set(estate.KEYWORDS.values()))
)
_FOUND = "CASE " + " ".join(
    f"WHEN contains(lower(use_text), '{k}') THEN '{v}'" for k, v in estate.KEYWORDS.items()
) + " END"


@query(
    "scenario_from_text",
    f"""SELECT request_id, CASE WHEN hits = 1 THEN {_FOUND} END AS resolved_scenario,
    CASE WHEN hits <> 1 THEN 'scenario_unresolved' END AS reason_code
    FROM (SELECT *, {_HITS} AS hits FROM requests)""",
    ["requests"],
)
def scenario_from_text(w):
    return prepare.scenario_from_text(w.requests(), estate.KEYWORDS).select(
        "request_id", "resolved_scenario", "reason_code"
    )


@query(
    "evaluation_instant",
    f"SELECT request_id, {dstamp('coalesce(as_of, requested_at)', 'instant')} FROM requests",
    ["requests"],
)
def evaluation_instant(w):
    return w.requests().select("request_id", stamp(prepare.evaluation_instant(), "instant"))


@query(
    "purpose_category",
    "SELECT request_id, purpose, split_part(purpose, '.', 1) AS purpose_category FROM requests",
    ["requests"],
)
def purpose_category_query(w):
    return w.requests().select(
        "request_id", "purpose", purpose_category(F.col("purpose")).alias("purpose_category")
    )


@query(
    "purpose_declared_state",
    """SELECT request_id, CASE WHEN request_id % 4 = 0 THEN 'undeclared'
    WHEN purpose IS NULL THEN 'declared_blind' ELSE 'declared' END AS purpose_state FROM requests""",
    ["requests"],
)
def purpose_declared_state(w):
    meta = F.when(F.col("request_id") % 4 == 0, F.create_map(F.lit("owner"), F.lit("x"))).otherwise(
        F.create_map(F.lit("purpose_key"), F.col("purpose"))
    )
    return w.requests().select("request_id", prepare.declared_state(meta).alias("purpose_state"))


# --- matching and rule decisions -----------------------------------------------------


def pairs(w, how="inner"):
    return decide.decided_pairs(prepare.prepared(w.requests()), w.rules(), how)


@query("candidate_rules", "SELECT request_id, rule_id FROM candidates", ["candidates"])
def candidate_rules(w):
    return decide.candidate_rules(w.requests(), w.rules()).select("request_id", "rule.rule_id")


@query("effective_rules", "SELECT request_id, rule_id FROM live", ["live"])
def effective_rules(w):
    return pairs(w).filter("in_force").select("request_id", "rule.rule_id")


@query(
    "coverage_state",
    "SELECT request_id, n_rules, n_live, CASE WHEN n_live = 0 THEN reason_code END AS reason_code FROM answers",
    ["answers"],
)
def coverage_state(w):
    found = compose.coverage(pairs(w, "left"))
    return found.select(
        "request_id", "n_rules", "n_live",
        F.when(F.col("n_rules") == 0, "no_published_instruction_state")
        .when(F.col("n_live") == 0, "not_currently_effective")
        .alias("reason_code"),
    )


def family_query(name, where, extra_sql="", extra=lambda rule, q: []):
    @query(
        name,
        f"SELECT request_id, rule_id, decision{extra_sql} FROM pairs WHERE decision IS NOT NULL AND {where}",
        ["pairs"],
    )
    def run(w):
        live = decide.decided_pairs(prepare.prepared(w.requests()), w.rules().filter(where))
        return live.filter("decision IS NOT NULL").select(
            "request_id", "rule.rule_id", "decision", *extra(F.col("rule"), decide.context())
        )

    return run


family_query("decide_permitted_use", "kind = 'permitted'")
family_query("decide_prohibited_use", "kind = 'prohibited'")
family_query("decide_role_grant", "family = 'role_grant'")
family_query(
    "decide_masking",
    "family = 'masking'",
    ", method",
    lambda r, q: [r["masking"]["method"].alias("method")],
)
family_query(
    "decide_transfer",
    "family = 'transfer_governance'",
    ", t_effect IS NOT NULL AS rule_matched",
    lambda r, q: [decide.matched_transfer(r, q)["effect"].isNotNull().alias("rule_matched")],
)
family_query(
    "decide_access_window",
    "family = 'access_window'",
    ", CASE WHEN decision = 'conditional' THEN strftime(w_lower, '%Y-%m-%d %H:%M:%S') END AS lower_bound, "
    "CASE WHEN decision = 'conditional' THEN strftime(w_upper, '%Y-%m-%d %H:%M:%S') END AS upper_bound, "
    "CASE WHEN decision = 'require_review' THEN review_reason END AS reason_code",
    lambda r, q: [
        F.when(F.col("decision") == "conditional", decide.stamp(decide.window_bounds(r, q)[0])).alias("lower_bound"),
        F.when(F.col("decision") == "conditional", decide.stamp(decide.window_bounds(r, q)[1])).alias("upper_bound"),
        F.col("rule_reason").alias("reason_code"),
    ],
)
family_query(
    "decide_consent",
    "family = 'consent_requirement'",
    ", c_basis AS basis_column, CASE WHEN decision = 'require_review' THEN review_reason END AS reason_code",
    lambda r, q: [
        decide.consent_rule(r, q)["basis_column"].alias("basis_column"),
        F.col("rule_reason").alias("reason_code"),
    ],
)
family_query(
    "decide_row_access",
    "family = 'row_access'",
    ", expression",
    lambda r, q: [r["row_filter"]["expression"].alias("expression")],
)
family_query("decide_ai_lifecycle", "family = 'ai_governance'", ", kind", lambda r, q: [r["kind"].alias("kind")])


@query(
    "decide_retention",
    "SELECT request_id, rule_id, decision, 5 AS period_n, 'years' AS period_unit, 'archive' AS action "
    "FROM pairs WHERE family = 'retention'",
    ["pairs"],
)
def decide_retention(w):
    return (
        pairs(w)
        .filter("in_force AND rule.family = 'retention'")
        .select("request_id", "rule.rule_id", "decision", "rule.retention.period_n", "rule.retention.period_unit",
                "rule.retention.action")
    )


family_query("decide_log_only", "family IN ('compliance', 'classification', 'business_context')")


@query(
    "decide_monitor_mode",
    "SELECT request_id, rule_id, decision, mode = 'monitor' AND method LIKE 'custom.%' AS monitored_custom "
    "FROM pairs WHERE family = 'masking'",
    ["pairs"],
)
def decide_monitor_mode(w):
    return (
        pairs(w)
        .filter("in_force AND rule.family = 'masking'")
        .select("request_id", "rule.rule_id", "decision",
                decide.monitored_custom(F.col("rule")).alias("monitored_custom"))
    )


# --- composition ----------------------------------------------------------------------


def authorized(w):
    return compose.authorize(w.requests(), w.rules(), "pub-1")


@query("compose_decision", "SELECT request_id, state, decision, reason_code FROM answers", ["answers"])
def compose_decision(w):
    return compose.decide_in_place(w.requests(), w.rules()).select(
        "request_id", "state", "decision", "reason_code"
    )


@query(
    "compose_decision_exploded",
    "SELECT request_id, state, decision, reason_code FROM answers",
    ["answers"],
)
def compose_decision_exploded(w):
    return compose.compose_pairs(pairs(w, "left")).select("request_id", "state", "decision", "reason_code")


ORDERED = (
    "row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN rule_col IS NULL THEN 1 ELSE 0 END, "
    "band DESC, weight DESC, sev, policy, rule_id)"
)


# Three publications: one policy joins at the second, two leave at the third.
clone(
    "p",
    ("live", "enriched", "pairs", "ranked", "composed", "answers"),
    "candidates",
    """SELECT * FROM candidates WHERE CASE WHEN requested_at >= TIMESTAMP '2024-01-20' THEN policy NOT IN ('use guardrails', 'email masking')
    WHEN requested_at >= TIMESTAMP '2024-01-10' THEN TRUE ELSE policy <> 'audience use' END""",
    "candidates",
)


@query(
    "decide_as_published",
    """SELECT request_id, CASE WHEN requested_at >= TIMESTAMP '2024-01-20' THEN 'pub-2' WHEN requested_at >= TIMESTAMP '2024-01-10' THEN 'pub-1'
    ELSE 'pub-0' END AS publication_id, state, decision, reason_code FROM panswers""",
    ["panswers"],
)
def decide_as_published(w):
    rules = w.rules()
    served = (
        rules.filter("policy <> 'audience use'").withColumn("publication_id", F.lit("pub-0"))
        .unionByName(rules.withColumn("publication_id", F.lit("pub-1")))
        .unionByName(
            rules.filter("policy NOT IN ('use guardrails', 'email masking')").withColumn("publication_id", F.lit("pub-2"))
        )
    )
    return compose.decide_as_published(w.requests(), served, estate.PUBLICATIONS).select(
        "request_id", "publication_id", "state", "decision", "reason_code"
    )


_PUBLISHED = ("live", "enriched", "pairs", "ranked", "composed", "answers")
clone("b", _PUBLISHED, "candidates", "SELECT * FROM candidates WHERE policy <> 'audience use'", "candidates")
clone("a", _PUBLISHED, "candidates", "SELECT * FROM candidates WHERE policy NOT IN ('use guardrails', 'email masking')", "candidates")


@query(
    "publication_flips",
    """SELECT b.request_id, b.state AS before_state, b.decision AS before_decision, b.reason_code AS before_reason,
    a.state AS after_state, a.decision AS after_decision, a.reason_code AS after_reason FROM banswers b JOIN aanswers a USING (request_id)
    WHERE b.state IS DISTINCT FROM a.state OR b.decision IS DISTINCT FROM a.decision OR b.reason_code IS DISTINCT FROM a.reason_code""",
    ["banswers", "aanswers"],
)
def publication_flips(w):
    """Answers that differ between the first and the last publication; only requests of changed scopes are decided."""
    rules = w.rules()
    flips = publications.publication_flips(
        w.requests(), rules.filter("policy <> 'audience use'"), rules.filter("policy NOT IN ('use guardrails', 'email masking')")
    )
    return flips.select(
        "request_id", "before_state", "before_decision", F.col("before_reason_code").alias("before_reason"),
        "after_state", "after_decision", F.col("after_reason_code").alias("after_reason"),
    )


@query(
    "rank_instructions",
    f"SELECT request_id, rule_id, decision, {ORDERED} AS cited_rank FROM ranked",
    ["ranked"],
)
def rank_instructions(w):
    return compose.ranked_pairs(pairs(w)).select(
        "request_id", "rule.rule_id", "decision", F.col("rank").cast("long").alias("cited_rank")
    )


cte(
    "conditions",
    """
SELECT request_id, policy, 'anonymize_first' AS kind, 'This data must be anonymized before the transfer.' AS requirement,
  CAST(NULL AS VARCHAR) AS required_role, instant, actor FROM pairs
  WHERE family = 'transfer_governance' AND decision = 'conditional' AND t_anon
UNION ALL SELECT request_id, policy, 'approval_required',
  CASE WHEN t_effect IS NULL THEN 'No transfer rule matched ' || dest_system || ' (' || dest_jurisdiction || '); the default effect applies.'
    ELSE 'Transfer to ' || dest_system || ' (' || dest_jurisdiction || ') needs approval.' END, t_role, instant, actor FROM pairs
  WHERE family = 'transfer_governance' AND decision = 'conditional' AND (t_effect IS NULL OR t_approval OR NOT t_anon)
UNION ALL SELECT request_id, policy, 'data_window_required', 'Constrain ' || time_column || ' to '
  || strftime(w_lower, '%Y-%m-%d %H:%M:%S') || ' through ' || strftime(w_upper, '%Y-%m-%d %H:%M:%S') || ' for ' || purpose || '.',
  NULL, instant, actor FROM pairs WHERE family = 'access_window' AND decision = 'conditional'
UNION ALL SELECT request_id, policy, 'consent_required', c_requirement, NULL, instant, actor FROM pairs
  WHERE family = 'consent_requirement' AND decision = 'conditional'
UNION ALL SELECT request_id, policy, 'role_restricted', 'Row-level access is restricted to role(s): ' || replace(roles, ',', ', ') || '.',
  NULL, instant, actor FROM pairs WHERE family = 'row_access'
UNION ALL SELECT request_id, policy, 'anonymize_first', 'This data must be anonymized before the proposed AI use.', NULL, instant, actor
  FROM pairs WHERE family = 'ai_governance' AND kind = 'anonymization' AND decision = 'conditional'
UNION ALL SELECT request_id, policy, 'ai_restriction', restriction, NULL, instant, actor FROM pairs
  WHERE family = 'ai_governance' AND kind = 'restrictions' AND decision = 'conditional'
""",
    "pairs",
)


@query(
    "collect_conditions",
    "SELECT request_id, kind, requirement, policy, required_role, FALSE AS satisfied FROM conditions",
    ["conditions"],
)
def collect_conditions(w):
    return compose.cited_rows(w.requests(), w.rules()).select("request_id", F.explode("conditions").alias("c")).select(
        "request_id", "c.kind", "c.requirement", "c.policy", "c.required_role", F.lit(False).alias("satisfied")
    )


cte(
    "obligations",
    """SELECT request_id, 'mask' AS type, method, policy, db || '.' || sch || '.' || tbl || '.' || col AS target
FROM pairs WHERE decision IN ('mask_full', 'mask_partial')
UNION ALL SELECT request_id, 'retain', NULL, policy, db || '.' || sch || '.' || tbl FROM pairs WHERE decision = 'retain'""",
    "pairs",
)


@query("collect_obligations", "SELECT request_id, type, target, method, policy FROM obligations", ["obligations"])
def collect_obligations(w):
    return compose.cited_rows(w.requests(), w.rules()).select("request_id", F.explode("obligations").alias("o")).select(
        "request_id", "o.type", "o.target", "o.method", "o.policy"
    )


@query(
    "collect_prohibitions",
    "SELECT request_id, policy, ikey AS instruction_key FROM pairs WHERE decision = 'deny'",
    ["pairs"],
)
def collect_prohibitions(w):
    return compose.cited_rows(w.requests(), w.rules()).filter("decision = 'deny'").select("request_id", "policy", "instruction_key")


@query(
    "authorize_rows",
    """SELECT a.request_id, a.state, a.decision, a.reason_code, a.n_rules, a.n_live, coalesce(n_cited, 0) AS n_cited, first_rule
    FROM answers a LEFT JOIN (SELECT request_id, count(*) AS n_cited, arg_min(rule_id, cited_rank) AS first_rule FROM (
      SELECT request_id, rule_id, """ + ORDERED + """ AS cited_rank FROM ranked) GROUP BY 1) USING (request_id)""",
    ["answers", "ranked"],
)
def authorize_rows(w):
    """Full answers as two tables, for scopes of any size: the answers, and the rules they cite in order."""
    answers, cited = compose.authorize_rows(w.requests(), w.rules(), "pub-1")
    of_row = cited.groupBy("row_id").agg(F.count("*").alias("n_cited"), F.min_by("rule_id", "rank").alias("first_rule"))
    return answers.join(of_row, "row_id", "left").select(
        "request_id", "state", "decision", "reason_code", F.col("n_rules").cast("long"), F.col("n_live").cast("long"),
        F.coalesce("n_cited", F.lit(0)).cast("long").alias("n_cited"), "first_rule",
    )


@query(
    "context_facts",
    "SELECT request_id, decision, sensitivity, category, pii FROM answers LEFT JOIN facts USING (db, sch, tbl)",
    ["answers", "facts"],
)
def context_facts(w):
    decisions = compose.decide_in_place(w.requests(), w.rules())
    return compose.context_facts(decisions, w.table_facts()).select(
        "request_id", "decision", "sensitivity", "category", "pii"
    )


# Exceptions on record: each purchase grants its user an approval for one to five days.
EXCEPTIONS = """
SELECT user_id AS actor, 'approval_required' AS kind,
  CASE WHEN event_id % 3 = 0 THEN 'revoked' ELSE 'active' END AS state, ts AS valid_from,
  date_trunc('day', ts) AS from_day, CAST(1 + event_id % 5 AS INT) AS days
FROM {events} WHERE event_type = 'purchase'
"""
cte("grants", f"SELECT *, valid_from + to_days(days) AS valid_until FROM ({EXCEPTIONS}) g")


def exceptions(w):
    return w.sql(EXCEPTIONS).withColumn("valid_until", F.col("valid_from") + F.make_dt_interval(F.col("days")))


cte(
    "satisfied",
    """
SELECT a.request_id, a.decision, count(c.kind) AS n_conditions,
  CAST(coalesce(sum(CASE WHEN c.kind = 'approval_required' AND g.ok THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_satisfied
FROM answers a LEFT JOIN conditions c USING (request_id)
LEFT JOIN (SELECT DISTINCT q.request_id, TRUE AS ok FROM answers q JOIN grants e ON e.actor = q.actor AND e.state = 'active'
  AND e.valid_from <= q.instant AND q.instant < e.valid_until) g USING (request_id)
GROUP BY 1, 2
""",
    "answers", "conditions", "grants",
)


@query("satisfy_conditions", "SELECT request_id, n_conditions, n_satisfied FROM satisfied", ["satisfied"])
def satisfy_conditions(w):
    met = compose.satisfy_conditions(authorized(w), exceptions(w))
    return met.select(
        "request_id",
        F.size("conditions").cast("long").alias("n_conditions"),
        F.size(F.filter("conditions", lambda c: c["satisfied"])).cast("long").alias("n_satisfied"),
    )


@query(
    "can_proceed",
    """SELECT request_id, coalesce(decision = 'allow', FALSE) AS can_proceed_now,
    coalesce(decision = 'conditional' AND n_conditions > 0 AND n_conditions = n_satisfied, FALSE) AS can_proceed_with_exception
    FROM satisfied""",
    ["satisfied"],
)
def can_proceed(w):
    met = compose.can_proceed(compose.satisfy_conditions(authorized(w), exceptions(w)))
    return met.select("request_id", "can_proceed_now", "can_proceed_with_exception")


def _case(column, mapping):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


@query(
    "next_action",
    f"SELECT request_id, coalesce({_case('reason_code', compose.NEXT_BY_REASON)}, "
    f"{_case('decision', compose.NEXT_ACTIONS)}) AS next_action FROM answers",
    ["answers"],
)
def next_action(w):
    return compose.decide_in_place(w.requests(), w.rules()).select(
        "request_id", compose.next_action().alias("next_action")
    )


@query(
    "mint_receipts",
    "SELECT request_id, " + ", ".join(f"{receipt_sql(k)} AS {k}_id" for k in ("decision", "authorization", "validation"))
    + " FROM signed",
    ["signed"],
)
def mint_receipts(w):
    ids = prepare.receipts(F.lit("pub-1"), F.col("signature"), prepare.evaluation_instant())
    return signed(w).select("request_id", *[c.alias(n) for n, c in ids.items()])
