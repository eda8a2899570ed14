"""Registered queries: a Spark callable and, where SQL can say it, a checking SQL."""

import re

from stewardry.plans import estate
from stewardry.plans.workload import Workload

QUERIES = {}
_CHECKS = {}
CTES = estate.Oracle()


def duck(text):
    """The shared estate SQL as the checking engine reads it."""
    text = re.sub(r"@TS\(('[^']*')\)", r"TIMESTAMP \1", text)
    return re.sub(r"\{([a-z]\w*)\}", r"\1", text)


def cte(name, text, *needs):
    CTES.add(name, needs, duck(text))


def query(name, sql=None, needs=()):
    """Register ``fn(workload) -> DataFrame`` under an operator key."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Workload(spark, folder))
        if sql:
            _CHECKS[name] = (tuple(needs), duck(sql))
        return fn

    return register


def oracles():
    """Checking SQL per key; resolved late, so registration order does not matter."""
    return {
        name: (CTES.with_(*needs) if needs else "") + sql for name, (needs, sql) in _CHECKS.items()
    }


def clone(prefix, renamed, start, text, *needs):
    """A chain of checking tables over another first table, names prefixed."""
    cte(prefix + start, text, *needs)
    names = (start, *renamed)
    for name in renamed:
        needed, body = CTES.parts[name]
        for old in names:
            body = re.sub(rf"\b{old}\b", prefix + old, body)
        CTES.add(prefix + name, tuple(prefix + n if n in names else n for n in needed), body)


def framed_sql(*parts):
    """Checking SQL of ``expr.stable_id`` over text expressions."""
    return "sha256(" + " || ".join(f"coalesce(length({p}) || ':' || {p}, '-')" for p in parts) + ")"


def receipt_sql(kind, signature="signature"):
    at = "strftime(coalesce(as_of, requested_at), '%Y-%m-%d %H:%M:%S.%f')"
    return framed_sql(f"'{kind}'", "'pub-1'", signature, at)


def values(rows, columns):
    body = ",\n".join("(" + ", ".join(estate.literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(columns)})"


def _joined(items):
    return ",".join(items) if items else None


# --- shared checking tables -------------------------------------------------------

cte("requests", estate.REQUESTS)
cte("query_refs", estate.QUERY_REFS)
cte("customers", estate.CUSTOMER_TABLE)
cte("payments", estate.PAYMENT_TABLE)
cte("processor", estate.PROCESSOR_TABLE)
cte("network", estate.NETWORK_TABLE)
cte("cat_tables", estate.CATALOG_TABLES)
cte("pol", estate.POLICIES)
cte(
    "rules",
    "SELECT * REPLACE (CAST(rule_id AS BIGINT) AS rule_id, CAST(since AS TIMESTAMP) AS since, CAST(until AS TIMESTAMP) AS until) FROM ("
    + values(
        [
            (
                i, r.policy, r.version, r.family, r.kind, r.key, r.scenario, *r.asset.split("."), r.column,
                r.base, r.band, r.weight, r.mode, r.conflict, r.since, r.until, _joined(r.uses), r.grant_role,
                _joined(r.roles), r.method, _joined(r.exempt), r.transfer_default, _joined(r.actors),
                r.time_column, r.expression, r.restriction,
            )
            for i, r in enumerate(estate.RULES, start=1)
        ],
        (
            "rule_id", "policy", "version", "family", "kind", "ikey", "scenario", "db", "sch", "tbl", "col",
            "base", "band", "weight", "mode", "conflict", "since", "until", "uses", "grant_role", "roles",
            "method", "exempt", "transfer_default", "actors", "time_column", "expression", "restriction",
        ),
    )
    + ")",
)
cte(
    "transfer_rules",
    values(
        [
            (i, pos, *t)
            for i, r in enumerate(estate.RULES, start=1)
            for pos, t in enumerate(r.transfer)
        ],
        ("rule_id", "pos", "effect", "op", "sys", "djur", "cjur", "needs_approval", "needs_anon", "need_role"),
    ),
)
cte(
    "window_rules",
    values(
        [(i, *t) for i, r in enumerate(estate.RULES, start=1) for t in r.window],
        ("rule_id", "purpose", "wtype", "days"),
    ),
)
cte(
    "consent_rules",
    values(
        [(i, *t) for i, r in enumerate(estate.RULES, start=1) for t in r.consent],
        ("rule_id", "purpose", "basis", "requirement"),
    ),
)
cte(
    "facts",
    values(
        [(*a.split("."), *rest) for a, *rest in estate.TABLE_FACTS],
        ("db", "sch", "tbl", "sensitivity", "category", "pii"),
    ),
)
cte(
    "catalog",
    values(
        [(*a.split("."), *c) for a, cols in estate.CATALOG.items() for c in cols],
        ("db", "sch", "tbl", "col", "data_type", "data_type_id", "sensitivity", "is_pii"),
    ),
)

# One rule against one request: shared by requests and query references.
DECIDE = """
SELECT x.*,
  CASE
    WHEN kind = 'permitted' THEN CASE WHEN list_contains(split(uses, ','), purpose)
        OR list_contains(split(uses, ','), split_part(purpose, '.', 1)) THEN 'allow' ELSE 'require_review' END
    WHEN kind = 'prohibited' THEN 'deny'
    WHEN family = 'role_grant' AND kind = 'allow' THEN
        CASE WHEN list_contains(split(roles, ','), role) THEN 'allow' ELSE 'require_review' END
    WHEN family = 'role_grant' THEN CASE WHEN coalesce(role, 'PUBLIC') = grant_role THEN 'deny' END
    WHEN family = 'masking' THEN CASE WHEN list_contains(split(exempt, ','), role) THEN 'allow'
        WHEN method = 'partial' THEN 'mask_partial'
        WHEN method LIKE 'custom.%' THEN 'require_review' ELSE 'mask_full' END
    WHEN family = 'transfer_governance' THEN coalesce(t_effect, transfer_default)
    WHEN family = 'access_window' THEN CASE WHEN coalesce(list_contains(split(actors, ','), role), FALSE)
        AND w_days IS NOT NULL AND NOT (w_type = 'as_of' AND as_of IS NULL) THEN 'conditional' ELSE 'require_review' END
    WHEN family = 'consent_requirement' THEN CASE WHEN c_basis IS NOT NULL THEN 'conditional' ELSE 'require_review' END
    WHEN family = 'row_access' THEN 'conditional'
    WHEN family = 'ai_governance' THEN base
    WHEN family = 'retention' THEN 'retain'
    ELSE 'log_only' END AS decision,
  CASE WHEN family = 'access_window' AND coalesce(list_contains(split(actors, ','), role), FALSE)
      AND (w_days IS NULL OR (w_type = 'as_of' AND as_of IS NULL)) THEN 'access_window_context_required'
    WHEN family = 'consent_requirement' THEN 'consent_context_required'
    ELSE 'decision_requires_review' END AS review_reason
FROM {source} x
"""

# Matched transfer, window and consent parameters of a (request, rule) pair.
ENRICH = """
SELECT m.*, t.effect AS t_effect, t.needs_approval AS t_approval, t.needs_anon AS t_anon, t.need_role AS t_role,
  w.wtype AS w_type, w.days AS w_days, c.basis AS c_basis, c.requirement AS c_requirement,
  CASE WHEN w.wtype = 'as_of' THEN m.as_of ELSE m.requested_at END AS w_upper,
  CASE WHEN w.wtype = 'as_of' THEN m.as_of ELSE m.requested_at END - to_days(CAST(w.days AS INTEGER)) AS w_lower
FROM {source} m
LEFT JOIN (
  SELECT p.{id}, p.rule_id, min(t.pos) AS pos FROM {source} p JOIN transfer_rules t ON t.rule_id = p.rule_id
    AND (t.op IS NULL OR t.op = p.operation) AND (t.sys IS NULL OR t.sys = p.dest_system)
    AND (t.djur IS NULL OR t.djur = p.dest_jurisdiction) AND (t.cjur IS NULL OR t.cjur = p.consumer_jurisdiction)
  GROUP BY 1, 2) f ON f.{id} = m.{id} AND f.rule_id = m.rule_id
LEFT JOIN transfer_rules t ON t.rule_id = f.rule_id AND t.pos = f.pos
LEFT JOIN window_rules w ON w.rule_id = m.rule_id AND w.purpose = m.purpose
LEFT JOIN consent_rules c ON c.rule_id = m.rule_id AND c.purpose = m.purpose
"""

SEVERITY = (
    "CASE decision WHEN 'deny' THEN 1 WHEN 'require_review' THEN 2 WHEN 'conditional' THEN 3 "
    "WHEN 'mask_full' THEN 4 WHEN 'mask_partial' THEN 5 WHEN 'retain' THEN 6 WHEN 'log_only' THEN 7 "
    "WHEN 'allow' THEN 8 END"
)

cte(
    "candidates",
    "SELECT q.*, coalesce(q.as_of, q.requested_at) AS instant, r.* EXCLUDE (scenario, db, sch, tbl, col), r.col AS rule_col "
    "FROM requests q JOIN rules r ON r.db = q.db AND r.sch = q.sch AND r.tbl = q.tbl "
    "AND r.col IS NOT DISTINCT FROM q.col AND r.scenario = q.scenario",
    "requests",
    "rules",
)
cte(
    "live",
    "SELECT * FROM candidates WHERE (since IS NULL OR since <= instant) AND (until IS NULL OR instant < until)",
    "candidates",
)
cte(
    "enriched",
    ENRICH.replace("{source}", "live").replace("{id}", "request_id"),
    "live", "transfer_rules", "window_rules", "consent_rules",
)
cte("pairs", DECIDE.replace("{source}", "enriched"), "enriched")
cte("ranked", f"SELECT *, {SEVERITY} AS sev FROM pairs WHERE decision IS NOT NULL", "pairs")
cte(
    "composed",
    """
SELECT q.*, coalesce(q.as_of, q.requested_at) AS instant, coalesce(n.n_rules, 0) AS n_rules,
  coalesce(l.n_live, 0) AS n_live, coalesce(l.conflicted, FALSE) AS conflicted,
  CASE WHEN l.n_live IS NULL THEN NULL WHEN l.conflicted THEN 'require_review'
    WHEN s.sev IS NULL THEN 'require_review'
    ELSE ['deny','require_review','conditional','mask_full','mask_partial','retain','log_only','allow'][s.sev] END AS decision,
  s.review_reason
FROM requests q
LEFT JOIN (SELECT request_id, count(*) AS n_rules FROM candidates GROUP BY 1) n USING (request_id)
LEFT JOIN (SELECT request_id, count(*) AS n_live, bool_or(conflict <> 'none') AS conflicted FROM live GROUP BY 1) l USING (request_id)
LEFT JOIN (SELECT request_id, min(sev) AS sev, min(CASE WHEN decision = 'require_review' THEN review_reason END) AS review_reason
  FROM ranked GROUP BY 1) s USING (request_id)
""",
    "candidates", "live", "ranked",
)
cte(
    "answers",
    """
SELECT *, CASE WHEN n_live = 0 THEN 'not_enough_published_state' WHEN decision = 'require_review' THEN 'review_required'
    ELSE 'answered' END AS state,
  CASE WHEN n_rules = 0 THEN 'no_published_instruction_state' WHEN n_live = 0 THEN 'not_currently_effective'
    WHEN conflicted THEN 'conflicted_published_state'
    WHEN decision = 'require_review' THEN coalesce(review_reason, 'decision_requires_review') END AS reason_code,
  db || '.' || sch || '.' || tbl || coalesce('.' || col, '') AS asset
FROM composed
""",
    "composed",
)
