"""Queries over the query-reference log."""

from pyspark.sql import functions as F

from stewardry.operators import validate
from stewardry.plans.registry import DECIDE, ENRICH, SEVERITY, cte, query

cte(
    "vrefs_all",
    """SELECT query_id * 10 + ref_no AS ref_id, *, split_part(ref_name, '.', -1) AS tbl,
  CASE WHEN len(split(ref_name, '.')) >= 2 THEN split_part(ref_name, '.', -2) ELSE default_sch END AS sch,
  CASE WHEN len(split(ref_name, '.')) >= 3 THEN split_part(ref_name, '.', -3) ELSE default_db END AS db
FROM query_refs""",
    "query_refs",
)
cte(
    "vrefs",
    "SELECT * FROM vrefs_all WHERE contains(ref_name, '.') OR NOT list_contains(split(ctes, ','), tbl)",
    "vrefs_all",
)
cte(
    "vcols",
    """SELECT ref_id, unnest(split(columns, ',')) AS col FROM vrefs WHERE columns <> ''
UNION SELECT ref_id, c.col FROM vrefs r JOIN catalog c ON c.db = r.db AND c.sch = r.sch AND c.tbl = r.tbl WHERE star""",
    "vrefs", "catalog",
)
cte(
    "vlive",
    """SELECT q.*, coalesce(q.as_of, q.requested_at) AS instant, CAST(NULL AS VARCHAR) AS operation, CAST(NULL AS VARCHAR) AS dest_system,
  CAST(NULL AS VARCHAR) AS dest_jurisdiction, CAST(NULL AS VARCHAR) AS consumer_jurisdiction,
  CASE WHEN window_days IS NOT NULL THEN coalesce(q.as_of, q.requested_at) END AS q_upper,
  coalesce(q.as_of, q.requested_at) - to_days(window_days) AS q_lower,
  r.* EXCLUDE (scenario, db, sch, tbl, col), r.col AS rule_col, r.scenario AS rule_scenario
FROM vrefs q JOIN rules r ON r.db = q.db AND r.sch = q.sch AND r.tbl = q.tbl
WHERE (since IS NULL OR since <= coalesce(q.as_of, q.requested_at)) AND (until IS NULL OR coalesce(q.as_of, q.requested_at) < until)
  AND ((r.col IS NOT NULL AND EXISTS (SELECT 1 FROM vcols c WHERE c.ref_id = q.ref_id AND c.col = r.col))
    OR (r.col IS NULL AND (r.scenario = q.scenario OR (q.scenario IS NULL AND r.family = 'role_grant'))))""",
    "vrefs", "rules", "vcols",
)
cte(
    "venriched",
    ENRICH.replace("{source}", "vlive").replace("{id}", "ref_id"),
    "vlive", "transfer_rules", "window_rules", "consent_rules",
)
cte("vdecided", DECIDE.replace("{source}", "venriched"), "venriched")
cte(
    "vpairs",
    f"""SELECT *, {SEVERITY} AS sev FROM (SELECT * REPLACE (CASE WHEN family = 'access_window' AND decision = 'conditional'
    THEN CASE WHEN coalesce(q_lower >= w_lower AND q_upper <= w_upper, FALSE) THEN 'allow' ELSE 'deny' END
    ELSE decision END AS decision) FROM vdecided) WHERE decision IS NOT NULL""",
    "vdecided",
)
cte(
    "vranked",
    "SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY CASE WHEN rule_col IS NULL THEN 1 ELSE 0 END, band DESC, "
    "weight DESC, sev, policy, rule_id) AS rk FROM vpairs",
    "vpairs",
)
cte(
    "vfindings",
    """SELECT q.query_id, q.ref_no, q.ref_id, q.db || '.' || q.sch || '.' || q.tbl AS asset,
  EXISTS (SELECT 1 FROM rules r WHERE r.db = q.db AND r.sch = q.sch AND r.tbl = q.tbl) AS governed,
  f.decision AS finding_decision, w.sev AS worst
FROM vrefs q LEFT JOIN vranked f ON f.ref_id = q.ref_id AND f.rk = 1
LEFT JOIN (SELECT ref_id, min(sev) AS sev FROM vpairs GROUP BY 1) w ON w.ref_id = q.ref_id""",
    "vrefs", "vranked", "rules",
)
cte(
    "vverdicts",
    """SELECT query_id, n_refs, n_ungoverned, CASE WHEN worst = 1 THEN 'fail' WHEN worst <= 5 OR n_ungoverned > 0 THEN 'warn' ELSE 'pass' END AS verdict,
  CASE WHEN n_ungoverned = n_refs THEN 'not_enough_published_state' WHEN review THEN 'review_required' ELSE 'answered' END AS state
FROM (SELECT query_id, count(*) AS n_refs, CAST(count(*) FILTER (WHERE NOT governed) AS BIGINT) AS n_ungoverned, min(worst) AS worst,
  bool_or(coalesce(finding_decision = 'require_review', FALSE)) AS review FROM vfindings GROUP BY 1)""",
    "vfindings",
)


def refs(w):
    return validate.drop_ctes(validate.qualify(w.query_refs()))


def found(w, only=None):
    rows = refs(w)
    if only is not None:
        rows = rows.filter(only)
    return validate.findings(validate.expand_star(rows, w.catalog()), w.rules())


@query("qualify_refs", 'SELECT query_id, ref_no, db AS "database", sch AS "schema", tbl AS "table" FROM vrefs_all', ["vrefs_all"])
def qualify_refs(w):
    return validate.qualify(w.query_refs()).select("query_id", "ref_no", "database", "schema", "table")


@query("drop_cte_refs", "SELECT query_id, ref_no, tbl AS table_name FROM vrefs", ["vrefs"])
def drop_cte_refs(w):
    return refs(w).select("query_id", "ref_no", F.col("table").alias("table_name"))


@query(
    "expand_star",
    "SELECT r.query_id, r.ref_no, c.col AS column_name FROM vrefs r JOIN vcols c USING (ref_id)",
    ["vrefs", "vcols"],
)
def expand_star(w):
    return validate.expand_star(refs(w), w.catalog()).select(
        "query_id", "ref_no", F.explode("columns").alias("column_name")
    )


def cited(w, extra=()):
    return found(w).select("query_id", "ref_no", *extra, F.explode("instructions").alias("c"))


@query(
    "column_participation",
    "SELECT query_id, ref_no, rule_id, rule_col AS column_name, decision FROM vpairs WHERE rule_col IS NOT NULL",
    ["vpairs"],
)
def column_participation(w):
    return cited(w).filter("c.column IS NOT NULL").select(
        "query_id", "ref_no", "c.rule_id", F.col("c.column").alias("column_name"), "c.decision"
    )


@query(
    "intent_participation",
    "SELECT query_id, ref_no, rule_id, rule_scenario, decision FROM vpairs WHERE rule_col IS NULL",
    ["vpairs"],
)
def intent_participation(w):
    return cited(w).filter("c.column IS NULL").select(
        "query_id", "ref_no", "c.rule_id", F.col("c.scenario").alias("rule_scenario"), "c.decision"
    )


@query(
    "prove_access_window",
    "SELECT query_id, ref_no, rule_id, decision FROM vpairs WHERE family = 'access_window'",
    ["vpairs"],
)
def prove_access_window(w):
    return cited(w).filter("c.instruction_key = 'access_window:spec.accessWindows'").select(
        "query_id", "ref_no", "c.rule_id", "c.decision"
    )


@query(
    "as_of_query_validation",
    "SELECT query_id, ref_no, rule_id, decision FROM vpairs WHERE as_of IS NOT NULL",
    ["vpairs"],
)
def as_of_query_validation(w):
    return (
        found(w, F.col("as_of").isNotNull())
        .select("query_id", "ref_no", F.explode("instructions").alias("c"))
        .select("query_id", "ref_no", "c.rule_id", "c.decision")
    )


@query(
    "role_query_validation",
    "SELECT query_id, ref_no, role, rule_id, decision FROM vpairs WHERE family IN ('role_grant', 'masking')",
    ["vpairs"],
)
def role_query_validation(w):
    return (
        cited(w, ["role"])
        .filter(F.col("c.instruction_key").startswith("role_grant") | F.col("c.instruction_key").startswith("masking"))
        .select("query_id", "ref_no", "role", "c.rule_id", "c.decision")
    )


@query(
    "ungoverned_ref_finding",
    "SELECT query_id, ref_no, asset, CASE WHEN governed THEN 'evaluated' ELSE 'not_enough_published_state' END AS status FROM vfindings",
    ["vfindings"],
)
def ungoverned_ref_finding(w):
    return found(w).select("query_id", "ref_no", F.concat_ws(".", "database", "schema", "table").alias("asset"), "status")


@query("finding_decision", "SELECT query_id, ref_no, finding_decision FROM vfindings", ["vfindings"])
def finding_decision(w):
    return found(w).select("query_id", "ref_no", "finding_decision")


@query(
    "finding_rows",
    """SELECT query_id, ref_no, CASE WHEN governed THEN 'evaluated' ELSE 'not_enough_published_state' END AS status, finding_decision,
    coalesce(n_cited, 0) AS n_cited FROM vfindings LEFT JOIN (SELECT query_id, ref_no, count(*) AS n_cited FROM vpairs GROUP BY 1, 2) USING (query_id, ref_no)""",
    ["vfindings", "vpairs"],
)
def finding_rows(w):
    """Findings as two tables, for tables with any number of rules: one row per reference, and the rules it meets."""
    refs_found, cited_rules = validate.finding_rows(validate.expand_star(refs(w), w.catalog()), w.rules())
    of_row = cited_rules.groupBy("row_id").agg(F.count("*").alias("n_cited"))
    return refs_found.join(of_row, "row_id", "left").select(
        "query_id", "ref_no", "status", "finding_decision", F.coalesce("n_cited", F.lit(0)).cast("long").alias("n_cited")
    )


def judged(w):
    return validate.verdicts(found(w))


@query("query_verdict", "SELECT query_id, n_refs, n_ungoverned, verdict, state FROM vverdicts", ["vverdicts"])
def query_verdict(w):
    return judged(w)


@query(
    "query_fingerprint",
    "SELECT query_id, 'sha256:' || sha256(trim(sql_text)) AS fingerprint FROM query_refs WHERE ref_no = 1",
    ["query_refs"],
)
def query_fingerprint(w):
    return w.query_refs().filter("ref_no = 1").select(
        "query_id", validate.fingerprint(F.col("sql_text")).alias("fingerprint")
    )


@query(
    "intent_flip_pairs",
    """SELECT fingerprint, count(*) AS n_queries, bool_or(verdict = 'pass') AS has_pass, bool_or(verdict = 'warn') AS has_warn,
    bool_or(verdict = 'fail') AS has_fail
    FROM vverdicts JOIN (SELECT query_id, 'sha256:' || sha256(trim(sql_text)) AS fingerprint FROM query_refs WHERE ref_no = 1) USING (query_id)
    GROUP BY 1 HAVING count(DISTINCT verdict) > 1""",
    ["vverdicts", "query_refs"],
)
def intent_flip_pairs(w):
    printed = found(w).withColumn("fingerprint", validate.fingerprint(F.col("sql_text")))
    return validate.intent_flips(validate.verdicts(printed, keep=["fingerprint"]))


@query(
    "guard_routing",
    "SELECT query_id, CASE verdict WHEN 'pass' THEN 'approved' WHEN 'warn' THEN 'revised' ELSE 'blocked' END AS route FROM vverdicts",
    ["vverdicts"],
)
def guard_routing(w):
    return judged(w).select("query_id", validate.route(F.col("verdict")).alias("route"))


@query(
    "flagged_reasons",
    """SELECT query_id, string_agg(reason, ' | ' ORDER BY ref_no, rk) AS reasons FROM (
      SELECT query_id, reason, min(ref_no) AS ref_no, arg_min(rk, ref_no * 1000 + rk) AS rk FROM (
        SELECT *, policy || ': ' || ikey || ' → ' || decision AS reason FROM vranked WHERE decision IN ('deny', 'mask_full', 'mask_partial'))
      GROUP BY 1, 2) GROUP BY 1""",
    ["vranked"],
)
def flagged_reasons(w):
    return validate.flagged_reasons(found(w)).select("query_id", F.concat_ws(" | ", "reasons").alias("reasons"))
