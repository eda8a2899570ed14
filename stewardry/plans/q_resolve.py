"""Queries that resolve policies at scale against a catalog at scale."""

from pyspark.sql import functions as F

from stewardry.functions.expr import asset_path
from stewardry.operators import classify, resolve
from stewardry.plans import estate
from stewardry.plans.registry import cte, query, values
from stewardry.session import materialize

OK, NO = estate.USAGE_OK, estate.USAGE_NO


def joined(column):
    return F.concat_ws(",", column)


# --- checking tables ---------------------------------------------------------------

_MASK = (
    "CASE WHEN k % 40 < 8 THEN 'partial' WHEN k % 40 < 16 THEN 'hash' WHEN k % 40 < 24 THEN 'custom.vault' "
    "WHEN k % 40 < 32 THEN 'tokenize' ELSE 'redact' END"
)
_AI = "ai_governance:spec.aiGovernance:"
cte(
    "prules",
    f"""
SELECT policy_id, 'usage_guidance' AS family, 'permitted' AS kind, '{OK}' AS ikey, 'purpose.allowed_use' AS scenario,
  'allow' AS base, CASE WHEN family_no = 0 THEN 'analytics,ai.inference,legacy_reporting'
  ELSE 'outreach_' || CAST(k // 50 AS VARCHAR) END AS uses FROM pol WHERE family_no IN (0, 1)
UNION ALL SELECT policy_id, 'usage_guidance', 'prohibited', '{NO}',
  CASE WHEN family_no = 0 THEN 'purpose.prohibited_use' ELSE 'purpose.allowed_use' END, 'deny',
  CASE WHEN family_no = 0 THEN 'marketing,sharing.external' ELSE 'outreach_' || CAST(k // 50 AS VARCHAR) END
  FROM pol WHERE family_no IN (0, 2)
UNION ALL SELECT policy_id, 'ai_governance', 'training', '{_AI}training', 'ai.training',
  CASE WHEN k % 20 < 10 THEN 'allow' ELSE 'deny' END, NULL FROM pol WHERE family_no = 3
UNION ALL SELECT policy_id, 'ai_governance', 'inference', '{_AI}inference', 'ai.inference', 'allow', NULL
  FROM pol WHERE family_no = 3 AND k % 40 < 20
UNION ALL SELECT policy_id, 'ai_governance', 'anonymization', '{_AI}anonymization', 'protection.anonymization', 'conditional', NULL
  FROM pol WHERE family_no = 3
UNION ALL SELECT policy_id, 'ai_governance', 'restrictions', '{_AI}restrictions', 'ai.inference', 'conditional', NULL
  FROM pol WHERE family_no = 3
UNION ALL SELECT policy_id, 'role_grant', 'allow', 'role_grant:spec.accessControl.allowedRoles:' || r || ':allow', 'access.read', 'allow', NULL
  FROM pol, (VALUES ('hr_admin'), ('people_ops')) g(r) WHERE family_no = 4
UNION ALL SELECT policy_id, 'role_grant', 'deny', 'role_grant:spec.accessControl.deniedRoles:public:deny', 'access.read', 'deny', NULL
  FROM pol WHERE family_no = 4
UNION ALL SELECT policy_id, 'masking', NULL, 'masking:spec.accessControl.masking', 'masking.display',
  CASE {_MASK} WHEN 'partial' THEN 'mask_partial' WHEN 'custom.vault' THEN 'require_review' ELSE 'mask_full' END, NULL
  FROM pol WHERE family_no IN (5, 6)
UNION ALL SELECT policy_id, 'retention', NULL, 'retention:spec.retention', 'retention.lifecycle', 'retain', NULL FROM pol WHERE family_no = 7
UNION ALL SELECT policy_id, 'row_access', NULL, 'row_access:spec.rowFilter.rules', 'access.row_filter', 'conditional', NULL
  FROM pol WHERE k % 20 = 8
UNION ALL SELECT policy_id, 'transfer_governance', NULL, 'transfer_governance:spec.transferGovernance', 'residency.cross_border_transfer',
  CASE WHEN k % 40 = 18 THEN 'deny' ELSE 'conditional' END, NULL FROM pol WHERE k % 20 = 18
UNION ALL SELECT policy_id, 'access_window', NULL, 'access_window:spec.accessWindows', 'access.read', 'conditional', NULL
  FROM pol WHERE k % 20 = 9
UNION ALL SELECT policy_id, 'consent_requirement', NULL, 'consent_requirement:spec.consentRequirements', 'consent.required', 'conditional', NULL
  FROM pol WHERE k % 20 = 19
UNION ALL SELECT policy_id, 'compliance', NULL, 'compliance:spec.compliance.regulations:' || r, 'compliance.regulatory', 'log_only', NULL
  FROM pol, (VALUES ('gdpr'), ('hipaa')) g(r) WHERE family_no = 8
UNION ALL SELECT policy_id, 'business_context', NULL, 'business_context:metadata.businessContext', 'metadata.domain', 'log_only', NULL
  FROM pol WHERE family_no = 9
UNION ALL SELECT policy_id, 'classification', NULL, 'classification:spec.classification', 'classification.sensitivity', 'log_only', NULL FROM pol
""",
    "pol",
)
cte(
    "template",
    values(estate.COLUMN_TEMPLATE, ("column_name", "data_type", "type_id", "sensitivity", "is_pii")),
)
cte(
    "cat_columns",
    "SELECT db, sch, name AS tbl, table_no, column_name AS col, data_type, "
    "CASE WHEN type_id = '*' THEN custom_type ELSE type_id END AS data_type_id, sensitivity, is_pii, tag, p_type "
    "FROM cat_tables, template",
    "cat_tables", "template",
)
cte(
    "targets_all",
    """
SELECT policy_id, only_db, only_sch, db, sch, t.name AS tbl, CAST(NULL AS VARCHAR) AS col, 'selector' AS source, CAST(NULL AS VARCHAR) AS ref
  FROM pol JOIN cat_tables t ON (selector_no = 0 AND t.table_no IN (k, k + 1)) OR (selector_no = 4 AND k % 2 = 0 AND t.table_no = k)
UNION ALL SELECT policy_id, only_db, only_sch, db, sch, c.tbl, c.col, 'selector', NULL
  FROM pol JOIN cat_columns c ON selector_no = 1 AND c.table_no = k AND c.col = 'contact_email'
UNION ALL SELECT policy_id, only_db, only_sch, db, sch, c.tbl, c.col, 'taxonomy', c.data_type_id
  FROM pol JOIN cat_columns c ON selector_no = 2 AND c.data_type_id = 'custom.type' || CAST(k // 8 AS VARCHAR)
UNION ALL SELECT policy_id, only_db, only_sch, db, sch, t.name, NULL, 'collection', t.collection
  FROM pol JOIN cat_tables t ON selector_no = 3 AND t.collection = 'c' || CAST(k // 5 AS VARCHAR)
UNION ALL SELECT policy_id, only_db, only_sch, db, sch, t.name, NULL, 'tag', t.tag
  FROM pol JOIN cat_tables t ON selector_no = 4 AND t.tag = 'tag' || CAST(k // 4 AS VARCHAR)
""",
    "pol", "cat_tables", "cat_columns",
)
_IN_SCOPE = "(only_db IS NULL OR only_db = db) AND (only_sch IS NULL OR only_sch = sch)"
cte("targets", f"SELECT * FROM targets_all WHERE {_IN_SCOPE}", "targets_all")
cte(
    "reached",
    """
SELECT p.policy_id, r.family, r.kind, r.ikey, r.scenario, r.base, r.uses, p.priority, t.db, t.sch, t.tbl,
  CASE WHEN r.family = 'masking' THEN t.col END AS col, t.source, t.ref
FROM prules r JOIN targets t USING (policy_id) JOIN pol p USING (policy_id)
""",
    "prules", "targets", "pol",
)
cte(
    "instr",
    """
SELECT policy_id, family, kind, ikey, scenario, base, uses, priority, db, sch, tbl, col,
  db || '.' || sch || '.' || tbl || coalesce('.' || col, '') AS asset,
  CASE WHEN priority >= 800 THEN 3 WHEN priority >= 500 THEN 2 ELSE 1 END AS band,
  string_agg(DISTINCT source || coalesce(':' || ref, ''), ',' ORDER BY source || coalesce(':' || ref, '')) AS paths,
  ['selector', 'collection', 'taxonomy', 'tag'][min(list_position(['selector', 'collection', 'taxonomy', 'tag'], source))] AS primary_source
FROM reached GROUP BY ALL
""",
    "reached",
)

# --- rule expansion ------------------------------------------------------------------


def expansion(name, part, where, uses=False):
    @query(
        name,
        f"SELECT policy_id, ikey AS instruction_key, base AS decision{', uses' if uses else ''} FROM prules WHERE {where}",
        ["prules"],
    )
    def run(w):
        rows = resolve.expand(w.policies(), part)
        extra = [joined("rule.uses").alias("uses")] if uses else []
        return rows.select("policy_id", "rule.instruction_key", F.col("rule.base_decision").alias("decision"), *extra)

    return run


expansion("expand_usage", "usage", "family = 'usage_guidance'", uses=True)
expansion("expand_ai_lifecycle", "ai", "family = 'ai_governance'")
expansion("expand_role_grants", "role", "family = 'role_grant'")
expansion("expand_masking", "masking", "family = 'masking'")
expansion(
    "expand_context_families", "context",
    "family NOT IN ('usage_guidance', 'ai_governance', 'role_grant', 'masking')",
)

# --- selectors -----------------------------------------------------------------------


def selector(name, source, where, build):
    @query(
        name,
        "SELECT policy_id, db || '.' || sch || '.' || tbl || coalesce('.' || col, '') AS asset FROM targets "
        f"WHERE source = '{source}' AND {where}",
        ["targets"],
    )
    def run(w):
        return build(w).filter("in_scope").select(
            "policy_id", asset_path("database", "schema", "table", "column").alias("asset")
        )

    return run


selector(
    "resolve_table_selector", "selector", "col IS NULL",
    lambda w: resolve.table_targets(w.policies(), w.scoped_tables()),
)
selector(
    "resolve_column_selector", "selector", "col IS NOT NULL",
    lambda w: resolve.column_targets(w.policies(), w.catalog_columns()),
)
selector(
    "resolve_taxonomy_selector", "taxonomy", "TRUE",
    lambda w: resolve.taxonomy_targets(w.policies(), w.catalog_columns()),
)
selector(
    "resolve_collection_selector", "collection", "TRUE",
    lambda w: resolve.collection_targets(w.policies(), w.collections(), w.scoped_tables()),
)
selector(
    "resolve_tag_selector", "tag", "TRUE",
    lambda w: resolve.tag_targets(w.policies(), w.scoped_tables()),
)


@query(
    "scope_filter_db_schema",
    f"SELECT policy_id, db || '.' || sch || '.' || tbl AS asset, {_IN_SCOPE} AS in_scope "
    "FROM targets_all WHERE source = 'tag'",
    ["targets_all"],
)
def scope_filter(w):
    return resolve.tag_targets(w.policies(), w.scoped_tables()).select(
        "policy_id", asset_path("database", "schema", "table").alias("asset"), "in_scope"
    )


@query(
    "resolution_paths",
    "SELECT policy_id, ikey AS instruction_key, asset, paths, primary_source FROM instr",
    ["instr"],
)
def resolution_paths(w):
    text = F.transform(
        "resolution_paths", lambda p: F.concat(p["source"], F.coalesce(F.concat(F.lit(":"), p["ref"]), F.lit("")))
    )
    return w.instructions().select(
        "policy_id", "instruction_key", asset_path(*resolve.SCOPE).alias("asset"),
        F.concat_ws(",", F.sort_array(text)).alias("paths"), "primary_source",
    )


@query(
    "assign_scenario",
    "SELECT policy_id, ikey AS instruction_key, scenario FROM prules",
    ["prules"],
)
def assign_scenario(w):
    rows = resolve.expand(w.policies())
    return rows.select(
        "policy_id", "rule.instruction_key",
        resolve.assigned_scenario(F.col("rule"), F.col("scenario_map")).alias("scenario"),
    )


@query(
    "assign_band_weight",
    """SELECT policy_id, CASE WHEN policy_id % 9 = 0 THEN 2 WHEN priority >= 800 THEN 3 WHEN priority >= 500 THEN 2 ELSE 1 END AS band,
    CAST(CASE WHEN priority < 100 THEN 0.55 ELSE 1.0 END AS DOUBLE) AS weight FROM pol""",
    ["pol"],
)
def assign_band_weight(w):
    explicit = F.when(F.col("policy_id") % 9 == 0, F.lit(2))
    return w.policies().select(
        "policy_id",
        resolve.band(F.col("spec.priority"), explicit).alias("band"),
        resolve.weight(F.col("spec.priority")).cast("double").alias("weight"),
    )


@query(
    "attach_validity",
    """SELECT policy_id, CASE WHEN k % 4 = 1 THEN '2024-01-10 00:00:00' END AS effective_from,
    CASE WHEN k % 4 = 2 THEN '2024-01-20 00:00:00' END AS effective_until FROM pol""",
    ["pol"],
)
def attach_validity(w):
    def text(field):
        return F.date_format(resolve.validity(F.col(f"spec.{field}")), "yyyy-MM-dd HH:mm:ss").alias(field)

    return w.policies().select("policy_id", text("effective_from"), text("effective_until"))


# --- vocabulary ------------------------------------------------------------------------

cte(
    "dispositions",
    values(estate.DISPOSITIONS, ("authored_entry", "resolved_key", "resolved_category", "do_not_map", "ruled_kind")),
)
cte(
    "entries",
    "SELECT policy_id, kind AS list_kind, unnest(split(uses, ',')) AS entry FROM prules WHERE uses IS NOT NULL",
    "prules",
)
cte(
    "normalised",
    """
SELECT e.policy_id, e.list_kind, e.entry,
  CASE WHEN coalesce(do_not_map, FALSE) THEN NULL WHEN contains(e.entry, '.') THEN e.entry
    WHEN e.entry IN (SELECT split_part(entry, '.', 1) FROM entries WHERE contains(entry, '.')) THEN e.entry
    ELSE coalesce(resolved_key, resolved_category) END AS resolved
FROM entries e LEFT JOIN dispositions d ON d.authored_entry = e.entry
""",
    "entries", "dispositions",
)


@query(
    "normalise_purpose_vocab",
    """SELECT policy_id, list_kind, entry, resolved, CASE WHEN resolved IS NULL THEN 'unmapped'
    WHEN contains(resolved, '.') THEN 'key' ELSE 'category' END AS resolved_as FROM normalised""",
    ["normalised"],
)
def normalise_purpose_vocab(w):
    return resolve.normalise_entries(resolve.use_entries(w.policies()), w.dispositions()).select(
        "policy_id", "list_kind", "entry", "resolved", "resolved_as"
    )


# --- conflicts and publications -----------------------------------------------------------

cte(
    "contested",
    """
SELECT asset, scenario, band, use, count(*) FILTER (WHERE kind = 'permitted') AS n_ok, count(*) FILTER (WHERE kind = 'prohibited') AS n_no FROM (
  SELECT *, unnest(split(uses, ',')) AS use FROM instr WHERE family = 'usage_guidance')
WHERE NOT contains(use, '.') GROUP BY ALL HAVING n_ok > 0 AND n_no > 0
""",
    "instr",
)


@query(
    "detect_conflicts",
    """SELECT i.asset, i.kind, i.use, CAST(CASE WHEN kind = 'permitted' THEN n_no ELSE n_ok END AS BIGINT) AS n_opponents
    FROM (SELECT *, unnest(split(uses, ',')) AS use FROM instr WHERE family = 'usage_guidance') i
    JOIN contested c ON c.asset = i.asset AND c.scenario = i.scenario AND c.band = i.band AND c.use = i.use""",
    ["contested"],
)
def detect_conflicts(w):
    return resolve.detect_conflicts(resolve.flatten(w.instructions(paths=False))).select(
        asset_path(*resolve.SCOPE).alias("asset"), "kind", "use", "n_opponents"
    )


# Versions at scale: up to three per policy by priority; later drafts of every fifth are unapproved.
_VERSION = """SELECT policy_id, name, CAST(%d AS INT) AS version, priority, NOT (policy_id %% 5 = 0 AND %d > 1) AS approved,
  @TS('%s') AS published_at FROM {pol} WHERE priority >= %d"""
VERSIONS = " UNION ALL ".join(
    _VERSION % (n, n, at, least)
    for n, at, least in ((1, "2023-12-01 00:00:00", 0), (2, "2024-01-05 00:00:00", 550), (3, "2024-01-15 00:00:00", 700))
)
cte("versions", VERSIONS, "pol")
cte("pubs", values(estate.PUBLICATIONS, ("publication_id", "served_at")))
cte(
    "snapshots",
    """
SELECT publication_id, policy_id, version, publication_id = 'pub-2' AS is_current FROM (
  SELECT publication_id, policy_id, version, row_number() OVER (PARTITION BY publication_id, policy_id ORDER BY version DESC) AS rn
  FROM versions JOIN pubs ON published_at <= CAST(served_at AS TIMESTAMP) WHERE approved) WHERE rn = 1
""",
    "versions", "pubs",
)


def versions(w):
    return w.sql(VERSIONS, pol=w.sql(estate.POLICIES))


def snapshots(w):
    return resolve.snapshot(versions(w), estate.PUBLICATIONS)


@query("publish_snapshot", "SELECT publication_id, policy_id, version, is_current FROM snapshots", ["snapshots"])
def publish_snapshot(w):
    return snapshots(w).select("publication_id", "policy_id", "version", "is_current")


@query(
    "publication_diff",
    """SELECT policy_id, CASE WHEN a.version IS NULL THEN 'added' WHEN b.version IS NULL THEN 'removed' ELSE 'changed' END AS change,
    a.version AS before_version, b.version AS after_version
    FROM (SELECT * FROM snapshots WHERE publication_id = 'pub-0') a
    FULL JOIN (SELECT * FROM snapshots WHERE publication_id = 'pub-2') b USING (policy_id)
    WHERE a.version IS DISTINCT FROM b.version""",
    ["snapshots"],
)
def publication_diff(w):
    rows = snapshots(w)
    diff = resolve.publication_diff(
        rows.filter("publication_id = 'pub-0'"), rows.filter("publication_id = 'pub-2'"), ["policy_id"], ["version"]
    )
    return diff.select(
        "policy_id", "change", F.col("before.version").alias("before_version"),
        F.col("after.version").alias("after_version"),
    )


# --- classification -----------------------------------------------------------------------

_NAMES = " ".join(
    f"WHEN regexp_matches(lower(col), '{p}') THEN '{t}'" for p, t, _, _ in classify.NAME_PATTERNS
)


@query(
    "classify_columns_by_name",
    f"""SELECT db || '.' || sch || '.' || tbl || '.' || col AS asset, type_id AS data_type_id,
    CASE WHEN type_id IS NOT NULL THEN 'pattern' END AS source
    FROM (SELECT *, CASE {_NAMES} END AS type_id FROM cat_columns)""",
    ["cat_columns"],
)
def classify_columns_by_name(w):
    columns = w.catalog_columns().select(*resolve.SCOPE)
    return classify.by_name(columns).select(asset_path(*resolve.SCOPE).alias("asset"), "data_type_id", "source")


VALUE_PATTERNS = {
    "pii.contact.email": r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+[.][A-Za-z]+",
    "numeric.text": r"^[0-9]+$",
}


def _value_sql():
    parts = [
        f"SELECT '{c}' AS column_name, '{t}' AS data_type_id, count({c}) AS n_values, "
        f"CAST(count(*) FILTER (WHERE regexp_matches({c}, '{p}')) AS BIGINT) AS n_hits FROM customers"
        for c in ("email", "customer_name", "region", "segment")
        for t, p in VALUE_PATTERNS.items()
    ] + [
        f"SELECT 'text', '{t}', count(text), CAST(count(*) FILTER (WHERE regexp_matches(text, '{p}')) AS BIGINT) FROM documents"
        for t, p in VALUE_PATTERNS.items()
    ]
    return " UNION ALL ".join(parts)


@query(
    "classify_columns_by_value",
    f"SELECT column_name, data_type_id, n_values, n_hits, n_hits >= 0.8 * n_values AS classified FROM ({_value_sql()})",
    ["customers"],
)
def classify_columns_by_value(w):
    first = classify.by_value(w.customers(), ["email", "customer_name", "region", "segment"], VALUE_PATTERNS, 0.8)
    second = classify.by_value(w.table("documents"), ["text"], VALUE_PATTERNS, 0.8)
    return first.unionByName(second).select(
        F.col("column").alias("column_name"), "data_type_id", "n_values", "n_hits", "classified"
    )


@query(
    "classification_manual_override",
    """SELECT db || '.' || sch || '.' || tbl || '.' || col AS asset,
    CASE WHEN p_type = 'SMALL' AND col = 'notes' THEN 'custom.ruled' ELSE data_type_id END AS data_type_id,
    CASE WHEN p_type = 'SMALL' AND col = 'notes' THEN 'manual' ELSE 'pattern' END AS source FROM cat_columns""",
    ["cat_columns"],
)
def classification_manual_override(w):
    columns = w.catalog_columns().select(*resolve.SCOPE, "data_type_id", "source")
    manual = w.sql(
        "SELECT db AS database, sch AS schema, name AS table, 'notes' AS column, 'custom.ruled' AS data_type_id, "
        "'manual' AS source FROM {t} WHERE p_type = 'SMALL'",
        t=w.catalog_tables(),
    )
    best = classify.override(columns.unionByName(manual), resolve.SCOPE)
    return best.select(asset_path(*resolve.SCOPE).alias("asset"), "data_type_id", "source")


@query(
    "taxonomy_sensitivity_rollup",
    """SELECT db || '.' || sch || '.' || tbl AS asset,
    ['public', 'internal', 'confidential', 'restricted'][max(list_position(['public', 'internal', 'confidential', 'restricted'], sensitivity))] AS sensitivity,
    bool_or(is_pii) AS pii, count(*) AS n_columns FROM cat_columns GROUP BY ALL""",
    ["cat_columns"],
)
def taxonomy_sensitivity_rollup(w):
    rolled = classify.rollup(w.catalog_columns(), ["database", "schema", "table"])
    return rolled.select(
        asset_path("database", "schema", "table").alias("asset"), "sensitivity", "pii", "n_columns"
    )
