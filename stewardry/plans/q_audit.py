"""Queries for evidence, coverage, inventory, parity, identity and sessions."""

from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.expr import asset_path
from stewardry.operators import audit, classify, compose, contract, decide, prepare, publications, resolve
from stewardry.plans import estate, q_resolve  # noqa: F401 - its checking tables are cloned below
from stewardry.plans.estate import div, pick
from stewardry.plans.q_authorize import authorized, pairs, signed
from stewardry.plans.registry import clone, cte, query, receipt_sql
from stewardry.session import materialize

TBL = "db || '.' || sch || '.' || tbl"
TABLE_PATH = ("database", "schema", "table")


def served(w, part=None):
    """Rules at scale as an evaluation reads them: resolved once, written, read back; of the policies in ``part``, where given."""
    return materialize(resolve.flatten(w.instructions(part, paths=False)), "instructions")


def before(day):
    return F.col("requested_at") < F.lit(day).cast("timestamp_ntz")


# --- evidence ----------------------------------------------------------------------------

cte(
    "cond_kinds",
    "SELECT request_id, string_agg(kind, ',' ORDER BY kind, requirement) AS kinds FROM conditions GROUP BY 1",
    "conditions",
)
cte(
    "duty_texts",
    "SELECT request_id, string_agg(type || ': ' || target, ',' ORDER BY type, target) AS duties FROM obligations GROUP BY 1",
    "obligations",
)
cte("denials", "SELECT request_id, count(*) AS n FROM pairs WHERE decision = 'deny' GROUP BY 1", "pairs")
cte(
    "cited_first",
    """SELECT request_id, arg_min(rule_id, rk) AS rule_id FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN rule_col IS NULL THEN 1 ELSE 0 END,
    band DESC, weight DESC, sev, policy, rule_id) AS rk FROM ranked) GROUP BY 1""",
    "ranked",
)
cte(
    "evidence",
    """
SELECT a.request_id, a.asset, a.scenario, a.state, a.decision, a.reason_code, p.policy, p.version AS policy_version,
  p.ikey AS instruction_key, c.rule_id, coalesce(k.kinds, '') AS conditions, coalesce(d.duties, '') AS obligations,
  coalesce(n.n, 0) AS prohibitions,
  CASE WHEN a.state = 'answered' AND c.rule_id IS NOT NULL THEN p.policy NOT IN ('use guardrails', 'email masking') END AS explanation_current
FROM answers a LEFT JOIN first_policy p USING (request_id) LEFT JOIN cited_first c USING (request_id)
LEFT JOIN cond_kinds k USING (request_id) LEFT JOIN duty_texts d USING (request_id) LEFT JOIN denials n USING (request_id)
""",
    "answers", "first_policy", "cited_first", "cond_kinds", "duty_texts", "denials",
)


def entries(w):
    return audit.evidence_entries(authorized(w))


def explained(w):
    """Current rules: two policies were dropped by a later publication."""
    return audit.explain_current(entries(w), w.rules().filter("policy NOT IN ('use guardrails', 'email masking')"))


cte(
    "receipts",
    "SELECT *, " + ", ".join(f"{receipt_sql(k)} AS {k}_id" for k in audit.RECEIPT_KINDS) + " FROM signed",
    "signed",
)


@query(
    "evidence_entries",
    """SELECT request_id, asset, scenario, state, decision, reason_code, policy, policy_version, instruction_key, conditions, obligations, prohibitions,
    CASE WHEN state <> 'not_enough_published_state' THEN r.decision_id END AS decision_id
    FROM evidence JOIN (SELECT request_id, decision_id FROM receipts) r USING (request_id)""",
    ["evidence", "receipts"],
)
def evidence_entries(w):
    return entries(w).select(
        "request_id", "asset", "scenario", "state", "decision", "reason_code", "policy", "policy_version", "instruction_key",
        "decision_id",
        F.concat_ws(",", "conditions").alias("conditions"), F.concat_ws(",", "obligations").alias("obligations"),
        F.col("prohibitions").cast("long").alias("prohibitions"),
    )


@query("explain_current", "SELECT request_id, state, explanation_current FROM evidence", ["evidence"])
def explain_current(w):
    return explained(w).select("request_id", "state", "explanation_current")


def receipt_rows(w):
    return signed(w).withColumns(prepare.receipts(F.lit("pub-1"), F.col("signature"), prepare.evaluation_instant()))


@query(
    "explain_receipt",
    """SELECT request_id AS question_id, CASE WHEN request_id % 10 = 9 THEN NULL WHEN request_id % 3 = 0 THEN 'decision' WHEN request_id % 3 = 1 THEN 'authorization' ELSE 'validation' END AS kind,
    CASE WHEN request_id % 10 = 9 THEN 'invalid_question' WHEN request_id % 10 = 8 THEN 'unknown_id' ELSE 'explained' END AS outcome FROM requests""",
    ["requests"],
)
def explain_receipt(w):
    """Each request asks for its own receipt; some name none, some an id nobody minted."""
    rows = materialize(receipt_rows(w).select("request_id", *[f"{k}_id" for k in audit.RECEIPT_KINDS]), "receipts")
    n = F.col("request_id")
    asked = rows.select(
        n.alias("question_id"),
        *[
            F.when((n % 3 == i) & (n % 10 != 9), F.when(n % 10 == 8, F.lit("no-such-id")).otherwise(F.col(f"{k}_id"))).alias(f"{k}_id")
            for i, k in enumerate(audit.RECEIPT_KINDS)
        ],
    )
    return audit.explain_receipts(asked, rows).select("question_id", "kind", "outcome")


@query(
    "evidence_packet",
    """SELECT count(*) AS total, count(explanation_current) AS explained, CAST(count(*) FILTER (WHERE explanation_current) AS BIGINT) AS current,
    CAST(count(*) FILTER (WHERE state <> 'answered') AS BIGINT) AS honest_corners, 'pub-1' AS publication_id FROM evidence""",
    ["evidence"],
)
def evidence_packet(w):
    return audit.packet(explained(w))


@query("honest_corners", "SELECT request_id, state, reason_code FROM evidence WHERE state <> 'answered'", ["evidence"])
def honest_corners(w):
    return audit.honest_corners(entries(w)).select("request_id", "state", "reason_code")


@query(
    "cited_policy_usage",
    """SELECT coalesce(policy, 'ALL') AS policy, coalesce(CAST(version AS VARCHAR), 'ALL') AS version, count(*) AS citations,
    CAST(count(*) FILTER (WHERE decision = 'deny') AS BIGINT) AS denials FROM ranked GROUP BY ROLLUP (policy, version)""",
    ["ranked"],
)
def cited_policy_usage(w):
    return audit.cited_policy_usage(authorized(w)).select(
        F.coalesce("policy", F.lit("ALL")).alias("policy"),
        F.coalesce(F.col("version").cast("string"), F.lit("ALL")).alias("version"), "citations", "denials",
    )


# --- discovery over rules at scale ------------------------------------------------------------


@query(
    "discover_assets",
    """SELECT asset, count(*) AS instruction_count, string_agg(DISTINCT scenario, ',' ORDER BY scenario) AS scenario_keys
    FROM instr WHERE db = 'master' GROUP BY 1""",
    ["instr"],
)
def discover_assets(w):
    found = audit.discover(resolve.flatten(w.instructions(paths=False)), database="master")
    return found.select(
        asset_path(*resolve.SCOPE).alias("asset"), "instruction_count", F.concat_ws(",", "scenario_keys").alias("scenario_keys")
    )


@query(
    "asset_rulebook",
    """SELECT asset, policy_id, ikey AS instruction_key, base AS decision FROM instr
    WHERE db = 'product' AND sch = 'public' AND scenario = 'purpose.allowed_use'""",
    ["instr"],
)
def asset_rulebook(w):
    rules = audit.rulebook(
        resolve.flatten(w.instructions(paths=False)), "product", "public", scenario="purpose.allowed_use"
    )
    return rules.select(
        asset_path(*resolve.SCOPE).alias("asset"),
        F.substring_index("policy", "-", -1).cast("long").alias("policy_id"), "instruction_key",
        F.col("base_decision").alias("decision"),
    )


cte(
    "mask_rules",
    """SELECT asset, arg_min(method, band_key) AS mask_method FROM (
  SELECT i.asset, CASE WHEN k % 40 < 8 THEN 'partial' WHEN k % 40 < 16 THEN 'hash' WHEN k % 40 < 24 THEN 'custom.vault'
    WHEN k % 40 < 32 THEN 'tokenize' ELSE 'redact' END AS method, (3 - i.band) || '|' || p.name AS band_key
  FROM instr i JOIN pol p USING (policy_id) WHERE i.family = 'masking' AND i.col IS NOT NULL) GROUP BY 1""",
    "instr", "pol",
)


@query(
    "asset_meaning",
    """SELECT db || '.' || sch || '.' || tbl || '.' || col AS asset, data_type, data_type_id, sensitivity, is_pii, mask_method
    FROM cat_columns LEFT JOIN mask_rules ON mask_rules.asset = db || '.' || sch || '.' || tbl || '.' || col""",
    ["cat_columns", "mask_rules"],
)
def asset_meaning(w):
    return audit.meaning(w.catalog_columns(), resolve.flatten(w.instructions(paths=False))).select(
        asset_path(*resolve.SCOPE).alias("asset"), "data_type", "data_type_id", "sensitivity", "is_pii", "mask_method"
    )


@query(
    "decision_context",
    f"""SELECT {TBL} AS asset, sensitivity, coalesce(n_rules, 0) AS n_rules, coalesce(families, '') AS families FROM (
      SELECT db, sch, tbl, ['public', 'internal', 'confidential', 'restricted'][max(list_position(['public', 'internal', 'confidential', 'restricted'], sensitivity))] AS sensitivity
      FROM cat_columns GROUP BY ALL)
    LEFT JOIN (SELECT db, sch, tbl, CAST(sum(n) AS BIGINT) AS n_rules, string_agg(family || '=' || n, ',' ORDER BY family) AS families FROM (
      SELECT db, sch, tbl, family, count(*) AS n FROM instr GROUP BY ALL) GROUP BY 1, 2, 3) USING (db, sch, tbl)""",
    ["cat_columns", "instr"],
)
def decision_context(w):
    facts = classify.rollup(w.catalog_columns(), list(TABLE_PATH))
    rows = audit.decision_context(facts, resolve.flatten(w.instructions(paths=False)))
    text = F.transform("families", lambda f: F.concat(f["family"], F.lit("="), f["n"].cast("string")))
    return rows.select(
        asset_path(*TABLE_PATH).alias("asset"), "sensitivity", "n_rules",
        F.coalesce(F.concat_ws(",", text), F.lit("")).alias("families"),
    )


# The baseline question at two instants, over conflict-marked rules.
_BASE = """
SELECT t.db, t.sch, t.name AS tbl, count(i.policy_id) AS n_rules,
  count(*) FILTER (WHERE i.policy_id IS NOT NULL AND live) AS n_live, bool_or(live AND marked) AS conflicted,
  bool_or(live AND i.kind = 'prohibited') AS denied, bool_or(live AND i.kind = 'permitted') AS permitted
FROM cat_tables t LEFT JOIN (
  SELECT i.*, NOT (i.policy_id % 4 = 1 AND TIMESTAMP '{at}' < TIMESTAMP '2024-01-10')
      AND NOT (i.policy_id % 4 = 2 AND TIMESTAMP '{at}' >= TIMESTAMP '2024-01-20') AS live,
    EXISTS (SELECT 1 FROM contested c WHERE c.asset = i.asset AND c.scenario = i.scenario AND c.band = i.band
      AND list_contains(split(i.uses, ','), c.use)) AS marked
  FROM instr i WHERE scenario = 'purpose.allowed_use') i ON i.db = t.db AND i.sch = t.sch AND i.tbl = t.name
GROUP BY ALL
"""
_STATE = """
SELECT db, sch, tbl, CASE WHEN n_live = 0 THEN 'not_enough_published_state' WHEN conflicted THEN 'review_required'
  WHEN denied THEN 'answered' ELSE 'review_required' END AS state FROM {t}
"""
EARLY, LATE = "2024-01-05 00:00:00", "2024-01-15 00:00:00"
for _name, _at in (("early", EARLY), ("late", LATE)):
    cte(f"base_{_name}", _BASE.replace("{at}", _at), "cat_tables", "instr", "contested")
    cte(_name, _STATE.replace("{t}", f"base_{_name}"), f"base_{_name}")


def marked(w):
    """The written rules with their conflicts marked as they are read, so that only what a question needs is."""
    return resolve.mark_conflicts(served(w)).drop("conflict_group_id")


@query("coverage_baseline", "SELECT state, count(*) AS n_tables FROM late GROUP BY 1", ["late"])
def coverage_baseline(w):
    return audit.baseline(w.scoped_tables(), marked(w), LATE).groupBy("state").agg(F.count("*").alias("n_tables"))


@query(
    "coverage_delta",
    f"""SELECT {TBL} AS asset, e.state AS before_state, l.state AS after_state FROM early e FULL JOIN late l USING (db, sch, tbl)
    WHERE e.state IS DISTINCT FROM l.state""",
    ["early", "late"],
)
def coverage_delta(w):
    rules, tables = marked(w), w.scoped_tables()
    delta = audit.coverage_delta(audit.baseline(tables, rules, EARLY), audit.baseline(tables, rules, LATE))
    return delta.select(asset_path(*TABLE_PATH).alias("asset"), "before_state", "after_state")


# Two publications: one policy in six is not in the first yet, one in thirteen is gone from the second.
_RESOLVED = ("prules", "targets_all", "targets", "reached", "instr", "contested", "base_late", "late")
clone("was_", _RESOLVED, "pol", estate.POLICIES + " WHERE c_custkey % 6 <> 1")
clone("now_", _RESOLVED, "pol", estate.POLICIES + " WHERE c_custkey % 13 <> 5")


@query(
    "coverage_delta_publications",
    f"""SELECT {TBL} AS asset, b.state AS before_state, a.state AS after_state FROM was_late b JOIN now_late a USING (db, sch, tbl)
    WHERE b.state IS DISTINCT FROM a.state""",
    ["was_late", "now_late"],
)
def coverage_delta_publications(w):
    """Tables whose baseline answer differs between two publications; only tables of changed scopes are asked."""
    # a rule follows from its own policy and the catalog, so what both publications serve is resolved once
    parts = ("policy_id % 6 <> 1", "policy_id % 13 <> 5")
    resolved = w.instructions(" OR ".join(parts), paths=False)
    # rules of other scenarios cannot match the baseline's question: none is written, marked or hashed
    resolved = materialize(resolved.where(F.col("scenario") == "purpose.allowed_use"), "instructions")
    first, second = (
        resolve.mark_conflicts(resolve.flatten(resolved.where(part))).drop("conflict_group_id") for part in parts
    )
    flips = publications.publication_flips(audit.baseline_requests(w.scoped_tables(), LATE), first, second)
    flips = flips.where(~F.col("before_state").eqNullSafe(F.col("after_state")))
    return flips.select(asset_path(*TABLE_PATH).alias("asset"), "before_state", "after_state")


@query(
    "ungoverned_tables",
    f"""SELECT t.db || '.' || t.sch || '.' || t.name AS asset, CASE WHEN count(i.policy_id) = 0 THEN 'ungoverned' ELSE 'thin' END AS status
    FROM cat_tables t LEFT JOIN instr i ON i.db = t.db AND i.sch = t.sch AND i.tbl = t.name GROUP BY 1
    HAVING count(i.policy_id) = 0 OR bool_and(i.family IN {vocab.CONTEXT_FAMILIES})""",
    ["cat_tables", "instr"],
)
def ungoverned_tables(w):
    rows = audit.ungoverned(w.scoped_tables(), resolve.flatten(w.instructions(paths=False)))
    return rows.select(asset_path(*TABLE_PATH).alias("asset"), "status")


# --- purpose inventory -----------------------------------------------------------------------


@query("use_occurrences", "SELECT policy_id, list_kind, entry FROM entries", ["entries"])
def use_occurrences(w):
    return resolve.use_entries(w.policies()).select("policy_id", "list_kind", "entry")


cte(
    "served_uses",
    """SELECT DISTINCT entry, 'case-' || request_id AS case_id FROM (
  SELECT request_id, unnest(split(uses, ',')) AS entry FROM ranked WHERE family = 'usage_guidance')""",
    "ranked",
)


def case_rows(w):
    return authorized(w).withColumn("case_id", F.concat(F.lit("case-"), F.col("request_id").cast("string")))


def served_uses(w):
    return contract.served_uses(case_rows(w), w.rules())


@query("use_served_in_cases", "SELECT entry, case_id FROM served_uses", ["served_uses"])
def use_served_in_cases(w):
    return served_uses(w).select("entry", "case_id")


cte(
    "all_entries",
    """SELECT entry, n_occurrences, list_kinds, n_cases FROM (
  SELECT entry, count(*) AS n_occurrences, string_agg(DISTINCT list_kind, ',' ORDER BY list_kind) AS list_kinds FROM entries GROUP BY 1)
FULL JOIN (SELECT entry, count(*) AS n_cases FROM served_uses GROUP BY 1) USING (entry)""",
    "entries", "served_uses",
)
cte(
    "inventory",
    """
SELECT entry, CASE WHEN ruled_kind IS NOT NULL THEN ruled_kind WHEN contains(entry, '.') THEN 'registry_key'
    WHEN fam THEN 'registry_category' WHEN do_not_map THEN 'do_not_map' ELSE 'legacy_unmapped' END AS classification,
  coalesce(n_occurrences, 0) AS n_occurrences, coalesce(list_kinds, '') AS list_kinds, coalesce(n_cases, 0) AS n_cases,
  CASE WHEN fam THEN entry || '.*' END AS matches, resolved_key, n_occurrences IS NOT NULL AS in_pack
FROM (SELECT *, entry IN (SELECT split_part(entry, '.', 1) FROM all_entries WHERE contains(entry, '.')) AS fam FROM all_entries) e
LEFT JOIN dispositions d ON d.authored_entry = e.entry
""",
    "all_entries", "dispositions",
)


@query(
    "use_inventory",
    "SELECT entry, classification, n_occurrences, list_kinds, n_cases, matches, resolved_key, in_pack FROM inventory",
    ["inventory"],
)
def use_inventory(w):
    rows = contract.use_inventory(resolve.use_entries(w.policies()), served_uses(w), w.dispositions())
    return rows.select(
        "entry", "classification", "n_occurrences", F.concat_ws(",", "list_kinds").alias("list_kinds"), "n_cases", "matches",
        "resolved_key", "in_pack",
    )


@query(
    "use_inventory_totals",
    """SELECT classification, count(*) AS n_entries, count(*) FILTER (WHERE in_pack) AS n_authored,
    CAST(sum(n_occurrences) AS BIGINT) AS n_occurrences, CAST(sum(n_cases) AS BIGINT) AS n_pairs,
    count(*) FILTER (WHERE n_cases = 0) AS n_never_served FROM inventory GROUP BY ROLLUP (classification)""",
    ["inventory"],
)
def use_inventory_totals(w):
    return contract.inventory_totals(contract.use_inventory(resolve.use_entries(w.policies()), served_uses(w), w.dispositions()))


_CASE = (
    "'case-' || request_id || CASE WHEN request_id % 3 = 0 THEN '-purpose-missing' WHEN request_id % 3 = 1 THEN '-purpose-inexpressible' ELSE '' END"
)


@query(
    "purpose_manifest",
    f"""SELECT {_CASE} AS case_id, CASE WHEN purpose IS NOT NULL THEN 'purposeful' WHEN request_id % 3 = 1 THEN 'inexpressible'
    WHEN request_id % 3 = 0 THEN 'purpose_missing_control' ELSE 'purpose_blind' END AS kind, state, decision, coalesce(families, '') AS families,
    coalesce(n_usage_cited, 0) AS n_usage_cited
    FROM answers LEFT JOIN (SELECT request_id, string_agg(DISTINCT family, ',' ORDER BY family) AS families,
      CAST(count(*) FILTER (WHERE family = 'usage_guidance') AS BIGINT) AS n_usage_cited FROM ranked GROUP BY 1) USING (request_id)""",
    ["answers", "ranked"],
)
def purpose_manifest(w):
    n = F.col("request_id")
    suffix = F.when(n % 3 == 0, "-purpose-missing").when(n % 3 == 1, "-purpose-inexpressible").otherwise("")
    cases = authorized(w).withColumn("case_id", F.concat(F.lit("case-"), n.cast("string"), suffix))
    return contract.purpose_manifest(cases).select(
        "case_id", "kind", "state", "decision", F.coalesce(F.concat_ws(",", "families"), F.lit("")).alias("families"),
        F.greatest(F.coalesce("n_usage_cited", F.lit(0)), F.lit(0)).cast("long").alias("n_usage_cited"),
    )


@query(
    "disposition_split",
    """SELECT DISTINCT entry, CASE WHEN do_not_map THEN 'must_remain_unmapped'
    WHEN resolved_key IS NOT NULL OR ruled_kind IN ('registry_category', 'normalized_key', 'deliberate_conflict') THEN 'mapped'
    ELSE 'may_become_mapped' END AS bucket FROM entries JOIN dispositions ON authored_entry = entry""",
    ["entries", "dispositions"],
)
def disposition_split(w):
    return contract.disposition_split(resolve.use_entries(w.policies()), w.dispositions()).select("entry", "bucket")


@query(
    "unaccounted_uses",
    "SELECT DISTINCT entry FROM entries WHERE entry NOT IN (SELECT authored_entry FROM dispositions)",
    ["entries", "dispositions"],
)
def unaccounted_uses(w):
    return contract.unaccounted_uses(resolve.use_entries(w.policies()), w.dispositions())


# --- parity -----------------------------------------------------------------------------------

cte(
    "parity",
    """
SELECT request_id, CASE WHEN scenario = 'retention.lifecycle' THEN 'unexpected_case'
  WHEN request_id % 50 = 0 AND decision IS DISTINCT FROM 'deny' THEN 'decision' ELSE '' END AS deltas FROM answers
""",
    "answers",
)


def parity(w):
    """Expectations from the exploded form, one decision in fifty tampered with and one
    scenario left out, against the array form."""
    asked = prepare.prepared(w.requests().filter("scenario <> 'retention.lifecycle'"))
    expected = compose.compose_pairs(decide.decided_pairs(asked, w.rules(), "left")).withColumn(
        "decision", F.when(F.col("request_id") % 50 == 0, "deny").otherwise(F.col("decision"))
    )
    actual = compose.decide_in_place(w.requests(), w.rules())
    return contract.expected_vs_actual(expected, actual, "request_id", ["state", "decision", "reason_code"])


@query("expected_vs_actual", "SELECT request_id, deltas FROM parity WHERE deltas <> ''", ["parity"])
def expected_vs_actual(w):
    return parity(w).select("request_id", F.concat_ws(",", "deltas").alias("deltas")).filter("deltas <> ''")


@query(
    "prohibition_bite_check",
    """SELECT request_id, NOT (state = 'answered' AND coalesce(decision, '') NOT IN ('deny', 'require_review')) AS bites
    FROM answers WHERE scenario = 'purpose.prohibited_use'""",
    ["answers"],
)
def prohibition_bite_check(w):
    asked = w.requests().filter("scenario = 'purpose.prohibited_use'")
    return compose.decide_in_place(asked, w.rules()).select(
        "request_id", contract.bites(F.col("state"), F.col("decision")).alias("bites")
    )


@query(
    "parity_counters",
    """SELECT CAST(count(*) FILTER (WHERE d) AS BIGINT) AS delegated, CAST(count(*) FILTER (WHERE NOT d AND q) AS BIGINT) AS skipped,
    CAST(count(*) FILTER (WHERE NOT d AND NOT q AND deltas = '') AS BIGINT) AS passed, CAST(count(*) FILTER (WHERE NOT d AND NOT q AND deltas <> '') AS BIGINT) AS failed
    FROM (SELECT *, request_id % 13 = 0 AS d, request_id % 31 = 0 AS q FROM parity)""",
    ["parity"],
)
def parity_counters(w):
    n = F.col("request_id")
    return contract.parity_counters(parity(w).withColumns({"delegated": n % 13 == 0, "quarantined": n % 31 == 0}))


_ATTACK = """CASE WHEN scenario = 'purpose.prohibited_use' THEN 'marketing exfiltration' WHEN scenario = 'ai.training' THEN 'ticket fine-tune'
    WHEN scenario = 'residency.cross_border_transfer' AND dest_system = 'EXTERNAL_LLM_VENDOR' THEN 'model vendor export'
    WHEN scenario = 'purpose.allowed_use' AND purpose = 'analytics.reporting' THEN 'safe control' END"""
cte(
    "attacks",
    f"""SELECT *, CASE WHEN attack = 'safe control' THEN 'allow' ELSE 'deny' END AS expect,
  CASE WHEN state = 'answered' THEN decision ELSE state END AS got FROM (SELECT *, {_ATTACK} AS attack FROM answers) WHERE attack IS NOT NULL""",
    "answers",
)


def attacks(w):
    s, d, p = F.col("scenario"), F.col("dest_system"), F.col("purpose")
    attack = (
        F.when(s == "purpose.prohibited_use", "marketing exfiltration")
        .when(s == "ai.training", "ticket fine-tune")
        .when((s == "residency.cross_border_transfer") & (d == "EXTERNAL_LLM_VENDOR"), "model vendor export")
        .when((s == "purpose.allowed_use") & (p == "analytics.reporting"), "safe control")
    )
    cases = w.requests().withColumn("attack", attack).filter("attack IS NOT NULL")
    return compose.decide_in_place(cases, w.rules()).withColumns(
        {
            "expect": F.when(F.col("attack") == "safe control", "allow").otherwise("deny"),
            "got": F.when(F.col("state") == "answered", F.col("decision")).otherwise(F.col("state")),
        }
    )


@query(
    "red_team_eval",
    """SELECT attack, count(*) AS n_cases, CAST(count(*) FILTER (WHERE got = expect) AS BIGINT) AS n_held, count(*) FILTER (WHERE got = expect) / count(*) AS held_rate
    FROM attacks GROUP BY 1""",
    ["attacks"],
)
def red_team_eval(w):
    return contract.red_team(attacks(w))


@query("red_team_failures", "SELECT request_id, attack, expect, got FROM attacks WHERE got <> expect", ["attacks"])
def red_team_failures(w):
    return contract.failures(attacks(w)).select("request_id", "attack", "expect", "got")


# --- sets and drift ------------------------------------------------------------------------------


@query(
    "set_tripwire",
    """SELECT name, CASE WHEN p_size > 40 THEN 'added' ELSE 'removed' END AS change FROM cat_tables
    WHERE (p_size > 40) <> (p_type = 'ECONOMY')""",
    ["cat_tables"],
)
def set_tripwire(w):
    tables = w.catalog_tables()
    return contract.tripwire(
        tables.filter("p_size <= 40").select("name"), tables.filter("p_type <> 'ECONOMY'").select("name")
    )


@query(
    "classification_drift",
    """SELECT db || '.' || sch || '.' || tbl || '.' || col AS asset, 'custom.legacy' AS pinned_type, data_type_id AS current_type
    FROM cat_columns WHERE table_no % 12 = 0 AND col IN ('notes', 'amount')""",
    ["cat_columns"],
)
def classification_drift(w):
    current = w.catalog_columns()
    number = F.substring("table", 2, 20).cast("long")
    pinned = current.withColumn(
        "data_type_id",
        F.when((number % 12 == 0) & F.col("column").isin("notes", "amount"), "custom.legacy").otherwise(F.col("data_type_id")),
    )
    return contract.classification_drift(pinned, current, resolve.SCOPE).select(
        asset_path(*resolve.SCOPE).alias("asset"), "pinned_type", "current_type"
    )


cte(
    "estate_sets",
    """SELECT 't' || p_partkey AS name, p_type = 'SMALL' AS intended,
    p_partkey IN (SELECT l_partkey FROM lineitem) AS required FROM part""",
)


@query(
    "estate_preflight",
    """SELECT name, 'missing' AS issue FROM estate_sets WHERE required AND NOT intended AND name NOT IN (SELECT tbl FROM instr)
    UNION ALL SELECT name, 'unexpectedly_governed' FROM estate_sets WHERE intended AND name IN (SELECT tbl FROM instr)""",
    ["estate_sets", "instr"],
)
def estate_preflight(w):
    def named(column):
        return F.concat(F.lit("t"), F.col(column).cast("string")).alias("name")

    required = w.table("lineitem").select("l_partkey").distinct().select(named("l_partkey"))
    intended = w.table("part").filter("p_type = 'SMALL'").select(named("p_partkey"))
    served_names = materialize(
        w.instructions().select(F.col("table").alias("name")).distinct(), "served-tables"
    )
    return contract.preflight(required, served_names, intended)


@query(
    "recording_completeness",
    """SELECT 'case-' || request_id AS case_id, CASE WHEN late THEN 'missing_recording' WHEN role IS NULL THEN 'orphan_recording'
      ELSE 'empty:' || concat_ws(',', CASE WHEN decision IS NULL THEN 'decision' END, CASE WHEN reason_code IS NULL AND state <> 'answered' THEN 'reason' END) END AS issue
    FROM (SELECT *, requested_at >= TIMESTAMP '2024-01-25' AS late FROM answers)
    WHERE (late AND role IS NOT NULL) OR (NOT late AND role IS NULL) OR (NOT late AND role IS NOT NULL AND decision IS NULL)""",
    ["answers"],
)
def recording_completeness(w):
    answers = compose.decide_in_place(w.requests(), w.rules())
    case_id = F.concat(F.lit("case-"), F.col("request_id").cast("string")).alias("case_id")
    cases = w.requests().filter("role IS NOT NULL").select(case_id)
    recordings = answers.filter(before("2024-01-25")).select(case_id, "state", "decision")
    return contract.recording_completeness(cases, recordings, ["state", "decision"])


# --- identity ------------------------------------------------------------------------------------

_UUID = (
    "substr(md5(CAST({k} AS VARCHAR(20))), 1, 8) || '-' || substr(md5(CAST({k} AS VARCHAR(20))), 9, 4) || '-' || "
    "substr(md5(CAST({k} AS VARCHAR(20))), 13, 4) || '-' || substr(md5(CAST({k} AS VARCHAR(20))), 17, 4) || '-' || "
    "substr(md5(CAST({k} AS VARCHAR(20))), 21, 12)"
)
NOTES = f"""
SELECT event_id, user_id, 'actor ' || {_UUID.format(k='user_id')} || ' did ' || event_type ||
  CASE WHEN event_id % 4 = 0 THEN ' for ' || {_UUID.format(k='event_id - event_id % 8 + 100000')} ELSE '' END AS note
FROM {{events}}
"""
cte("notes", NOTES)
cte(
    "first_ids",
    """
SELECT k, printf('00000000-0000-4000-8000-%012d', row_number() OVER (ORDER BY e, pos)) AS canonical FROM (
  SELECT k, min(struct_pack(e := event_id, pos := pos)).e AS e, min(struct_pack(e := event_id, pos := pos)).pos AS pos FROM (
    SELECT event_id, 0 AS pos, user_id AS k FROM notes UNION ALL
    SELECT event_id, 1, event_id - event_id % 8 + 100000 FROM notes WHERE event_id % 4 = 0) GROUP BY 1)
""",
    "notes",
)


@query(
    "canonicalise_ids",
    f"""SELECT event_id, replace(replace(note, {_UUID.format(k='user_id')}, a.canonical),
      CASE WHEN event_id % 4 = 0 THEN {_UUID.format(k='event_id - event_id % 8 + 100000')} ELSE 'none' END, coalesce(b.canonical, '')) AS note
    FROM notes n JOIN first_ids a ON a.k = n.user_id LEFT JOIN first_ids b ON b.k = n.event_id - event_id % 8 + 100000 AND n.event_id % 4 = 0""",
    ["notes", "first_ids"],
)
def canonicalise_ids(w):
    return contract.canonicalise_ids(w.sql(NOTES), "event_id", "note").select("event_id", "note")


@query(
    "pin_time_windows",
    """SELECT request_id, w_type AS window_type, strftime(CASE WHEN w_type = 'rolling' THEN TIMESTAMP '2024-02-01' ELSE w_upper END, '%Y-%m-%d %H:%M:%S') AS anchor_at,
    strftime(CASE WHEN w_type = 'rolling' THEN TIMESTAMP '2024-02-01' - to_days(CAST(w_days AS INTEGER)) ELSE w_lower END, '%Y-%m-%d %H:%M:%S') AS lower_bound_at
    FROM pairs WHERE family = 'access_window' AND decision = 'conditional'""",
    ["pairs"],
)
def pin_time_windows(w):
    rule, q = F.col("rule"), decide.context()
    found = pairs(w).filter("in_force AND rule.family = 'access_window' AND decision = 'conditional'")
    lower, upper = decide.window_bounds(rule, q)
    windows = found.select(
        "request_id", decide.window_rule(rule, q)["type"].alias("window_type"),
        decide.window_rule(rule, q)["lookback_days"].alias("lookback_days"),
        upper.alias("anchor_at"), lower.alias("lower_bound_at"),
    )
    pinned = contract.pin_windows(windows, "2024-02-01 00:00:00")
    return pinned.select(
        "request_id", "window_type", decide.stamp(F.col("anchor_at")).alias("anchor_at"),
        decide.stamp(F.col("lower_bound_at")).alias("lower_bound_at"),
    )


_FIELD = pick("request_id % 4", ("decision", "state", "scenario", "colour"))


@query(
    "resolve_chained_refs",
    f"""SELECT q.request_id, {_FIELD.replace('request_id', 'q.request_id')} AS field,
    CASE q.request_id % 4 WHEN 0 THEN a.decision WHEN 1 THEN a.state WHEN 2 THEN a.scenario END AS resolved,
    CASE WHEN a.request_id IS NULL THEN 'unknown_case'
      WHEN CASE q.request_id % 4 WHEN 0 THEN a.decision WHEN 1 THEN a.state WHEN 2 THEN a.scenario END IS NULL THEN 'unresolved_field' END AS problem
    FROM requests q LEFT JOIN (SELECT * FROM answers WHERE requested_at < TIMESTAMP '2024-01-25') a ON a.request_id = (q.request_id // 10) * 10""",
    ["requests", "answers"],
)
def resolve_chained_refs(w):
    n = F.col("request_id")
    target = F.concat(F.lit("@case-"), (F.floor(n / 10) * 10).cast("string"), F.lit("."))
    names = F.array(*[F.lit(f) for f in ("decision", "state", "scenario", "colour")])
    asked = w.requests().select("request_id", F.concat(target, names[(n % 4).cast("int")]).alias("ref"))
    recorded = compose.decide_in_place(w.requests().filter(before("2024-01-25")), w.rules()).withColumn(
        "case_id", F.concat(F.lit("case-"), n.cast("string"))
    )
    return contract.resolve_chained(asked, recorded, ["decision", "state", "scenario"]).select(
        "request_id", "field", "resolved", "problem"
    )


@query(
    "signature_collisions",
    """SELECT signature, count(*) AS n_cases, min(request_id) AS first_case, max(request_id) AS last_case FROM signed
    GROUP BY 1 HAVING count(*) > 1""",
    ["signed"],
)
def signature_collisions(w):
    return contract.signature_collisions(signed(w).withColumn("case_id", F.col("request_id")))


# --- sessions ------------------------------------------------------------------------------------

CALLS = f"""
SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type,
  CASE WHEN event_id % 3 < 2 THEN 'validate' ELSE 'authorize' END AS tool,
  CASE WHEN event_id % 3 < 2 THEN {pick(f"({div('event_id', 3)} % 5)", ('warn', 'pass', 'pass', 'fail', 'warn'))}
    ELSE {pick(f"({div('event_id', 3)} % 4)", ('deny', 'allow', 'conditional', 'allow'))} END AS label
FROM {{events}}
"""
cte("calls", CALLS)


@query(
    "session_sequence_check",
    """SELECT user_id, strftime(day, '%Y-%m-%d') AS day, count(*) AS n_calls,
    string_agg(tool, ',' ORDER BY ts, event_id) = 'validate,validate' AS holds FROM calls GROUP BY ALL""",
    ["calls"],
)
def session_sequence_check(w):
    checked = contract.sequence_check(
        w.sql(CALLS), ["user_id", "day"], ["ts", "event_id"], "tool", ["validate", "validate"]
    )
    return checked.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_calls", "holds")


@query(
    "session_outcomes",
    """SELECT user_id, strftime(day, '%Y-%m-%d') AS day, n_calls, CAST(least(n_warned, 1) AS BIGINT) AS revisions,
    CASE WHEN n_warned > 1 OR last_verdict = 'fail' THEN 'aborted' WHEN last_verdict = 'pass' THEN 'validated' WHEN last_verdict IS NOT NULL THEN 'open' END AS dashboard,
    coalesce(denied < allowed, FALSE) AS rerouted FROM (
      SELECT user_id, day, count(*) AS n_calls, count(*) FILTER (WHERE tool = 'validate' AND label = 'warn') AS n_warned,
        arg_max(label, struct_pack(t := ts, e := event_id)) FILTER (tool = 'validate') AS last_verdict,
        min(ts) FILTER (tool = 'authorize' AND label = 'deny') AS denied, max(ts) FILTER (tool = 'authorize' AND label = 'allow') AS allowed
      FROM calls GROUP BY 1, 2)""",
    ["calls"],
)
def session_outcomes(w):
    rows = contract.session_outcomes(w.sql(CALLS), ["user_id", "day"], ["ts", "event_id"])
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd")).withColumn("revisions", F.col("revisions").cast("long"))


# --- ledger analytics -------------------------------------------------------------------------------


@query(
    "decision_trend",
    """SELECT strftime(day, '%Y-%m-%d') AS day, scenario, n, denied, denied / n AS deny_share,
    avg(denied) OVER (PARTITION BY scenario ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_denied FROM (
      SELECT CAST(requested_at AS DATE) AS day, scenario, count(*) AS n, CAST(count(*) FILTER (WHERE decision = 'deny') AS BIGINT) AS denied FROM answers GROUP BY 1, 2)""",
    ["answers"],
)
def decision_trend(w):
    answers = compose.decide_in_place(w.requests(), w.rules())
    return audit.decision_trend(answers).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "decision_calendar",
    """SELECT strftime(day, '%Y-%m-%d') AS day, scenario, decision, n, CASE WHEN sum(n) OVER (PARTITION BY scenario, day) > 0
      THEN n / sum(n) OVER (PARTITION BY scenario, day) END AS share,
    avg(n) OVER (PARTITION BY scenario, decision ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_n FROM (
      SELECT c.day, p.scenario, p.decision, coalesce(n, 0) AS n
      FROM (SELECT DISTINCT scenario, coalesce(decision, 'none') AS decision FROM answers) p
      CROSS JOIN (SELECT CAST(unnest(generate_series(min(CAST(requested_at AS DATE)), max(CAST(requested_at AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM answers) c
      LEFT JOIN (SELECT scenario, coalesce(decision, 'none') AS decision, CAST(requested_at AS DATE) AS day, count(*) AS n FROM answers GROUP BY ALL) d
        ON d.scenario IS NOT DISTINCT FROM p.scenario AND d.decision = p.decision AND d.day = c.day)""",
    ["answers"],
)
def decision_calendar(w):
    answers = compose.decide_in_place(w.requests(), w.rules())
    return audit.decision_calendar(answers).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "approx_actor_counts",
    f"""SELECT {TBL} AS asset, CAST(count(DISTINCT CAST(requested_at AS DATE)) AS BIGINT) AS n_days, count(DISTINCT actor) AS n_exact, TRUE AS within
    FROM requests GROUP BY 1""",
    ["requests"],
)
def approx_actor_counts(w):
    """Sketches per asset and day, united per asset, held against the exact count: within three standard errors or not."""
    asked = w.requests()
    estimated = audit.united_actors(materialize(audit.actor_sketches(asked), "actor-sketches"))
    exact = asked.groupBy(*TABLE_PATH).agg(F.count_distinct("actor").alias("n_exact"))
    off = F.abs(F.col("actors") - F.col("n_exact"))
    both = estimated.join(exact, list(TABLE_PATH))
    within = off <= F.greatest(F.lit(1.0), 3 * audit.SKETCH_ERROR * F.col("n_exact"))
    return both.select(asset_path(*TABLE_PATH).alias("asset"), "n_days", "n_exact", within.alias("within"))


_NEXT = "CASE WHEN event_id % 97 = 0 THEN event_id + 1 WHEN event_id % 50 <> 0 THEN event_id - 1 END"
REFERENCES = f"""
SELECT event_id AS ref, CASE WHEN event_id % 1009 = 5 THEN -event_id ELSE {_NEXT} END AS target,
  CASE WHEN event_id % 1009 <> 5 AND event_id % 97 <> 0 AND event_id % 50 = 0 THEN event_type END AS value
FROM {{events}}
"""
cte("references_", REFERENCES)
cte(
    "walked",
    """WITH RECURSIVE walk(ref, here, n) AS (
    SELECT ref, ref, 0 FROM references_ UNION ALL
    SELECT k.ref, r.target, n + 1 FROM walk k JOIN references_ r ON r.ref = k.here WHERE r.target IS NOT NULL AND n <= 120)
  SELECT ref, arg_max(here, n) AS here, max(n) AS n FROM walk GROUP BY ref""",
    "references_",
)


@query(
    "resolve_reference_chains",
    """SELECT k.ref, r.value AS resolved, CASE WHEN n <= 120 THEN CAST(n - CASE WHEN r.ref IS NULL THEN 1 ELSE 0 END AS BIGINT) END AS steps,
    CASE WHEN n > 120 THEN 'cycle' WHEN r.ref IS NULL THEN 'unknown' END AS problem
    FROM walked k LEFT JOIN references_ r ON r.ref = k.here""",
    ["walked"],
)
def resolve_reference_chains(w):
    """References that name references: chains of up to 50, some into a cycle, some to a name that is not there."""
    found = contract.resolve_references(w.sql(REFERENCES))
    return found.withColumnRenamed("key", "ref")
