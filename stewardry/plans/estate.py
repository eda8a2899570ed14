"""The governed estate the registered queries run over.

Facts (requests, query references, data tables, policies and catalog at scale)
are derived from the given tables by the SQL below; one text serves Spark and
the checking engine. The served rules of the six demo assets are a short fixed
list, stated once here.
"""

from dataclasses import dataclass, field
from datetime import datetime

CUSTOMERS = "master.public.customers"
PAYMENTS = "master.finance.payment_transactions"
USAGE = "product.public.product_usage_events"
TICKETS = "product.public.support_tickets"
FEATURES = "product.public.ml_feature_store"
BACKUP = "master.public.legacy_customer_backup"
ASSETS = (CUSTOMERS, PAYMENTS, USAGE, TICKETS, FEATURES, BACKUP)
COLUMN_OF = {
    CUSTOMERS: "email",
    PAYMENTS: "amount",
    USAGE: "device_id",
    TICKETS: "ticket_text",
    FEATURES: "embedding",
    BACKUP: "html",
}
SCENARIOS = (
    "purpose.allowed_use",
    "purpose.prohibited_use",
    "access.read",
    "consent.required",
    "residency.cross_border_transfer",
    "ai.training",
    "ai.inference",
    "protection.anonymization",
    "masking.display",
    "retention.lifecycle",
    "access.row_filter",
    "compliance.regulatory",
    "quality.reliability",
)
PURPOSES = (
    "analytics.reporting",
    "marketing.personalization",
    "sharing.third_party",
    "research.general",
    "commercial.general",
    "operations.support",
    "ai.inference",
    None,
)
SYSTEMS = ("SALESFORCE", "ADS_PLATFORM", "EXTERNAL_LLM_VENDOR", "INTERNAL_WAREHOUSE")
ROLES = ("clinical", "member_services", "research", "marketing", "agent", None)
USE_TEXTS = (
    "fine-tune a model on this data",
    "compare ai.training and ai.inference guidance",
    "export rows to a partner",
    "show the masked column",
    "quarterly numbers",
)
KEYWORDS = {
    "fine-tune": "ai.training",
    "ai.training": "ai.training",
    "ai.inference": "ai.inference",
    "export": "residency.cross_border_transfer",
    "masked": "masking.display",
}

USAGE_OK = "usage_guidance:spec.usage.permittedUses:permitted"
USAGE_NO = "usage_guidance:spec.usage.prohibitedUses:prohibited"
AI = "ai_governance:spec.aiGovernance:"


@dataclass
class Rule:
    policy: str
    family: str
    kind: str | None
    key: str
    scenario: str
    asset: str
    base: str
    column: str | None = None
    band: int = 2
    weight: float = 1.0
    mode: str = "enforce"
    conflict: str = "none"
    since: str | None = None
    until: str | None = None
    uses: tuple = ()
    grant_role: str | None = None
    roles: tuple = ()
    method: str | None = None
    exempt: tuple = ()
    transfer_default: str | None = None
    transfer: tuple = ()  # effect, operations, systems, dest, consumer, approval, anonymize, role
    actors: tuple = ()
    time_column: str | None = None
    window: tuple = ()  # purpose, type, days
    consent: tuple = ()  # purpose, basis column, requirement
    expression: str | None = None
    retention: tuple = ()  # n, unit, trigger, action
    restriction: str | None = None
    regulation: str | None = None
    version: int = 1


def _permit(policy, asset, uses, scenario="purpose.allowed_use", **kw):
    return Rule(policy, "usage_guidance", "permitted", USAGE_OK, scenario, asset, "allow", uses=uses, **kw)


def _prohibit(policy, asset, uses, scenario="purpose.prohibited_use", **kw):
    return Rule(policy, "usage_guidance", "prohibited", USAGE_NO, scenario, asset, "deny", uses=uses, **kw)


def _ai(policy, kind, asset, base, scenario, **kw):
    return Rule(policy, "ai_governance", kind, AI + kind, scenario, asset, base, **kw)


def _mask(policy, asset, method, base, exempt=(), **kw):
    return Rule(
        policy, "masking", None, "masking:spec.accessControl.masking", "masking.display", asset, base,
        column=COLUMN_OF[asset], method=method, exempt=exempt, **kw,
    )


def _plain(policy, family, key, scenario, asset, base, **kw):
    return Rule(policy, family, None, key, scenario, asset, base, **kw)


def _grant(policy, asset, role, listed):
    key = f"role_grant:spec.accessControl.allowedRoles:{role}:allow"
    return Rule(policy, "role_grant", "allow", key, "access.read", asset, "allow", grant_role=role, roles=listed)


GUARD_USES = ("analytics", "reporting", "support")
GUARD_BANS = ("marketing", "advertising", "personalization")
READERS = ("clinical", "research")

RULES = (
    _permit("use guardrails", CUSTOMERS, GUARD_USES),
    _permit("use guardrails", USAGE, GUARD_USES),
    _permit("use guardrails", TICKETS, GUARD_USES),
    _prohibit("use guardrails", CUSTOMERS, GUARD_BANS),
    _prohibit("use guardrails", USAGE, GUARD_BANS),
    _prohibit("use guardrails", TICKETS, GUARD_BANS),
    _ai("use guardrails", "training", CUSTOMERS, "deny", "ai.training"),
    _ai("use guardrails", "training", USAGE, "deny", "ai.training"),
    _ai("use guardrails", "training", TICKETS, "deny", "ai.training"),
    _ai("use guardrails", "inference", CUSTOMERS, "allow", "ai.inference"),
    _ai("use guardrails", "inference", TICKETS, "allow", "ai.inference"),
    _ai("use guardrails", "anonymization", CUSTOMERS, "conditional", "protection.anonymization"),
    _ai("use guardrails", "anonymization", TICKETS, "conditional", "protection.anonymization"),
    _permit("audience use", CUSTOMERS, ("analytics.reporting",)),
    _prohibit("audience use", CUSTOMERS, ("marketing.personalization", "sharing.third_party")),
    _plain(
        "transfer guardrails", "transfer_governance", "transfer_governance:spec.transferGovernance",
        "residency.cross_border_transfer", CUSTOMERS, "conditional", transfer_default="conditional",
        transfer=(
            ("conditional", "export", "SALESFORCE", "US", "EU", True, True, "PRIVACY_ADMIN"),
            ("deny", None, "ADS_PLATFORM", None, None, False, False, None),
            ("deny", None, "EXTERNAL_LLM_VENDOR", None, None, False, False, None),
        ),
    ),
    _plain(
        "telemetry transfer", "transfer_governance", "transfer_governance:spec.transferGovernance",
        "residency.cross_border_transfer", USAGE, "deny", transfer_default="deny",
        transfer=(("conditional", "export", "INTERNAL_WAREHOUSE", None, None, True, False, None),),
    ),
    _plain(
        "customer access windows", "access_window", "access_window:spec.accessWindows", "access.read",
        CUSTOMERS, "conditional", actors=("agent", "analyst"), time_column="created_at",
        window=(("research.general", "rolling", 90), ("commercial.general", "rolling", 30)),
    ),
    _plain(
        "usage access windows", "access_window", "access_window:spec.accessWindows", "access.read",
        USAGE, "conditional", actors=("agent", "analyst"), time_column="ts",
        window=(("research.general", "as_of", 90), ("commercial.general", "as_of", 30)),
    ),
    _plain(
        "audience consent", "consent_requirement", "consent_requirement:spec.consentRequirements",
        "consent.required", CUSTOMERS, "conditional",
        consent=(
            ("analytics.reporting", "consent_measurement", "Measurement use requires measurement consent."),
            ("marketing.personalization", "consent_personalization", "Personalization requires an opt-in."),
            ("sharing.third_party", "consent_activation", "Third-party activation requires an opt-in."),
        ),
    ),
    _grant("ticket readers", TICKETS, "clinical", READERS),
    _grant("ticket readers", TICKETS, "research", READERS),
    Rule(
        "ticket readers", "role_grant", "deny", "role_grant:spec.accessControl.deniedRoles:public:deny",
        "access.read", TICKETS, "deny", grant_role="PUBLIC",
    ),
    _mask("email masking", CUSTOMERS, "partial", "mask_partial", ("clinical", "DATA_STEWARD")),
    _mask("ticket redaction", TICKETS, "redact", "mask_full"),
    _mask("device hashing", USAGE, "hash", "mask_full"),
    _mask("vector vault", FEATURES, "custom.vault_mask", "require_review", band=1, mode="monitor"),
    _mask("amount tokens", PAYMENTS, "tokenize", "mask_full", ("research",), band=3),
    _plain(
        "payment retention", "retention", "retention:spec.retention", "retention.lifecycle", PAYMENTS,
        "retain", band=1, weight=0.55, retention=(5, "years", "order closed", "archive"),
    ),
    _plain(
        "future retention", "retention", "retention:spec.retention", "retention.lifecycle", FEATURES,
        "retain", since="2025-01-01 00:00:00", retention=(1, "years", "feature dropped", "delete"),
    ),
    _plain(
        "regional rows", "row_access", "row_access:spec.rowFilter.rules", "access.row_filter", CUSTOMERS,
        "conditional", roles=("member_services",), expression="region = caller_region",
    ),
    _plain(
        "payment compliance", "compliance", "compliance:spec.compliance.regulations:gdpr",
        "compliance.regulatory", PAYMENTS, "log_only", band=2, weight=0.55, mode="advisory", regulation="GDPR",
    ),
    _permit(
        "statute 2023", PAYMENTS, ("operations.support", "research.general"), "compliance.regulatory",
        until="2024-01-15 00:00:00",
    ),
    _ai(
        "statute 2024", "restrictions", PAYMENTS, "conditional", "compliance.regulatory",
        since="2024-01-15 00:00:00", restriction="Apply the 2024 checklist first.",
    ),
    _ai(
        "reconciled analytics", "restrictions", PAYMENTS, "conditional", "quality.reliability",
        restriction="Use reconciled rows only.",
    ),
    _permit("payment operations", PAYMENTS, ("operations.support",)),
    _permit("prospect permit", FEATURES, ("prospect_outreach",), conflict="conflicted"),
    _prohibit(
        "prospect block", FEATURES, ("prospect_outreach",), "purpose.allowed_use", conflict="conflicted"
    ),
    _ai("feature lifecycle", "training", FEATURES, "allow", "ai.training"),
    _permit("feature lifecycle", FEATURES, ("ai.inference",), "ai.inference", band=3),
    _plain(
        "use guardrails", "classification", "classification:spec.classification",
        "classification.sensitivity", CUSTOMERS, "log_only",
    ),
    _plain(
        "use guardrails", "business_context", "business_context:metadata.businessContext",
        "metadata.domain", CUSTOMERS, "log_only",
    ),
)

# table, sensitivity, category, pii
TABLE_FACTS = (
    (CUSTOMERS, "confidential", "pii", True),
    (PAYMENTS, "internal", "financial", False),
    (USAGE, "confidential", "operational.telemetry", True),
    (TICKETS, "confidential", "pii", True),
    (FEATURES, "internal", "operational", False),
    (BACKUP, "restricted", "pii", True),
)

# asset: column, data type, data type id, sensitivity, pii
CATALOG = {
    CUSTOMERS: (
        ("customer_id", "integer", "id.surrogate", "internal", False),
        ("email", "text", "pii.contact.email", "confidential", True),
        ("region", "text", "custom.sales_region", "internal", False),
        ("arr", "numeric", "financial.amount", "internal", False),
        ("created_at", "timestamptz", None, "internal", False),
    ),
    PAYMENTS: (
        ("transaction_id", "integer", "id.surrogate", "internal", False),
        ("amount", "numeric", "financial.amount", "restricted", False),
        ("settlement_state", "text", None, "internal", False),
    ),
    USAGE: (
        ("event_id", "integer", "id.surrogate", "internal", False),
        ("device_id", "text", "pii.device", "confidential", True),
        ("ts", "timestamptz", None, "internal", False),
    ),
    TICKETS: (
        ("ticket_id", "integer", "id.surrogate", "internal", False),
        ("ticket_text", "text", "custom.support_free_text", "confidential", True),
    ),
    FEATURES: (
        ("vec_id", "integer", "id.surrogate", "internal", False),
        ("embedding", "array", "custom.vector", "internal", False),
    ),
    BACKUP: (
        ("page_id", "integer", "id.surrogate", "internal", False),
        ("html", "text", None, "restricted", True),
    ),
}


def _ts(text):
    return datetime.fromisoformat(text) if text else None


def instruction_rows():
    rows = []
    for number, r in enumerate(RULES, start=1):
        database, schema, table = r.asset.split(".")
        rows.append(
            (
                number, r.policy, r.version, r.family, r.kind, r.key, r.scenario, database, schema, table,
                r.column, r.base, r.band, r.weight, r.mode, r.conflict, _ts(r.since), _ts(r.until),
                list(r.uses) or None,
                r.grant_role,
                list(r.roles) or None,
                (r.method, list(r.exempt)) if r.method else None,
                (
                    r.transfer_default,
                    [
                        (t[0], *[[v] if v else None for v in t[1:5]], t[5], t[6], t[7])
                        for t in r.transfer
                    ],
                )
                if r.transfer_default
                else None,
                (list(r.actors), r.time_column, [tuple(w) for w in r.window]) if r.window else None,
                [tuple(c) for c in r.consent] or None,
                (list(r.roles), r.expression) if r.expression else None,
                tuple(r.retention) or None,
                [r.restriction] if r.restriction else None,
                r.regulation,
            )
        )
    return rows


# --- SQL text shared by Spark and the checking engine -----------------------------


def literal(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def pick(expression, values):
    arms = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {expression} {arms} END"


def div(a, n):
    return f"CAST(FLOOR({a} / {n}) AS BIGINT)"


def _part(i):
    return [a.split(".")[i] for a in ASSETS]


_SCEN = f"({div('event_id', 6)} % 13)"
_PURP = f"({div('event_id', 78)} % 8)"
_SYS = f"({div('event_id', 624)} % 4)"

REQUESTS = f"""
SELECT event_id AS request_id, ts AS requested_at, user_id AS actor,
  {pick('user_id % 6', ROLES)} AS role,
  {pick('event_id % 6', _part(0))} AS db,
  {pick('event_id % 6', _part(1))} AS sch,
  {pick('event_id % 6', _part(2))} AS tbl,
  CASE WHEN {_SCEN} = 8 THEN {pick('event_id % 6', [COLUMN_OF[a] for a in ASSETS])} END AS col,
  {pick(_SCEN, SCENARIOS)} AS scenario,
  {pick(_PURP, PURPOSES)} AS purpose,
  CASE WHEN {_SCEN} = 4 THEN 'export' END AS operation,
  CASE WHEN {_SCEN} = 4 THEN {pick(_SYS, SYSTEMS)} END AS dest_system,
  CASE WHEN {_SCEN} = 4 THEN 'US' END AS dest_jurisdiction,
  CASE WHEN {_SCEN} = 4 THEN CASE WHEN user_id % 2 = 0 THEN 'EU' ELSE 'US' END END AS consumer_jurisdiction,
  CASE WHEN user_id % 4 = 0 THEN @TS('2024-01-31 00:00:00') END AS as_of,
  {pick('event_id % 5', USE_TEXTS)} AS use_text
FROM {{events}}
"""

# One reference per query, a second one (the ungoverned backup) for view and error events.
_QCOLS = {
    CUSTOMERS: ("customer_id,region", "customer_id,email,region", "region,arr"),
    PAYMENTS: ("transaction_id", "transaction_id,amount", "settlement_state"),
    USAGE: ("event_id", "event_id,device_id", "event_id,ts"),
    TICKETS: ("ticket_id", "ticket_text", "ticket_id,ticket_text"),
    FEATURES: ("vec_id", "embedding", "vec_id,embedding"),
    BACKUP: ("page_id", "html", "page_id,html"),
}
_QSCEN = (
    "purpose.allowed_use", "access.read", None, "purpose.prohibited_use", "ai.training",
    "compliance.regulatory", "quality.reliability",
)


def _columns_case():
    arms = " ".join(
        f"WHEN {i} THEN {pick(f'({div(chr(113), 6)} % 3)'.replace('q', 'event_id'), _QCOLS[a])}"
        for i, a in enumerate(ASSETS)
    )
    return f"CASE event_id % 6 {arms} END"


QUERY_REFS = f"""
SELECT event_id AS query_id, CAST(1 AS INT) AS ref_no, ts AS requested_at, user_id AS actor,
  CASE event_id % 3
    WHEN 0 THEN {pick('event_id % 6', _part(0))} || '.' || {pick('event_id % 6', _part(1))} || '.' || {pick('event_id % 6', _part(2))}
    WHEN 1 THEN {pick('event_id % 6', _part(1))} || '.' || {pick('event_id % 6', _part(2))}
    ELSE {pick('event_id % 6', _part(2))} END AS ref_name,
  {pick('event_id % 6', _part(0))} AS default_db,
  {pick('event_id % 6', _part(1))} AS default_sch,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE {_columns_case()} END AS columns,
  event_id % 11 = 0 AS star,
  {pick(f"({div('event_id', 18)} % 7)", _QSCEN)} AS scenario,
  {pick(f"({div('event_id', 126)} % 8)", PURPOSES)} AS purpose,
  {pick('user_id % 6', ROLES)} AS role,
  CASE WHEN user_id % 4 = 0 THEN @TS('2024-01-31 00:00:00') END AS as_of,
  CASE WHEN event_id % 7 < 5 THEN CAST({pick('event_id % 5', (7, 30, 45, 90, 120))} AS INT) END AS window_days,
  CASE WHEN event_id % 4 = 0 THEN 'recent' ELSE '' END AS ctes,
  'SELECT ' || CASE WHEN event_id % 11 = 0 THEN '*' ELSE {_columns_case()} END || ' FROM ' || {pick('event_id % 6', _part(2))} AS sql_text
FROM {{events}}
UNION ALL
SELECT event_id, CAST(2 AS INT), ts, user_id,
  CASE WHEN event_id % 4 = 0 THEN 'recent' ELSE 'legacy_customer_backup' END,
  'master', 'public', 'page_id', FALSE,
  {pick(f"({div('event_id', 18)} % 7)", _QSCEN)},
  {pick(f"({div('event_id', 126)} % 8)", PURPOSES)},
  {pick('user_id % 6', ROLES)},
  CASE WHEN user_id % 4 = 0 THEN @TS('2024-01-31 00:00:00') END,
  CAST(NULL AS INT),
  CASE WHEN event_id % 4 = 0 THEN 'recent' ELSE '' END,
  'SELECT ' || CASE WHEN event_id % 11 = 0 THEN '*' ELSE {_columns_case()} END || ' FROM ' || {pick('event_id % 6', _part(2))}
FROM {{events}} WHERE event_type IN ('view', 'error')
"""

CUSTOMER_TABLE = """
SELECT c_custkey AS customer_id, c_name AS customer_name,
  lower(replace(c_name, '#', '.')) || '@example.com' AS email, r_name AS region,
  n_name AS country, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18, 2)) AS arr,
  CASE WHEN c_custkey % 2 = 0 THEN 'granted' ELSE 'refused' END AS consent_measurement,
  CASE WHEN c_custkey % 3 = 0 THEN 'granted' ELSE 'refused' END AS consent_personalization,
  CASE WHEN c_custkey % 5 = 0 THEN 'granted' ELSE 'refused' END AS consent_activation
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

PAYMENT_TABLE = """
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
  CAST(o_totalprice AS DECIMAL(18, 2)) AS amount, o_orderdate AS authorized_at,
  CASE o_orderstatus WHEN 'F' THEN 'reconciled' WHEN 'P' THEN 'settled_pending' ELSE 'authorized' END AS settlement_state
FROM {orders}
"""

PROCESSOR_TABLE = """
SELECT l_orderkey AS transaction_id,
  CAST(SUM(CAST(l_tax AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS fee_amount,
  CASE WHEN MAX(l_linestatus) = 'O' THEN 'authorized' ELSE 'reconciled' END AS settlement_state,
  MAX(l_shipdate) AS settled_at
FROM {lineitem} GROUP BY l_orderkey
"""

NETWORK_TABLE = """
SELECT o_orderkey AS transaction_id,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 <> 0 THEN 'reconciled' ELSE 'pending' END AS settlement_state
FROM {orders} WHERE o_orderpriority <> '5-LOW'
"""

# Catalog at scale: one table per part; NULL database or schema inherits the default.
CATALOG_TABLES = """
SELECT p_partkey AS table_no, 't' || CAST(p_partkey AS VARCHAR(20)) AS name,
  CASE WHEN p_partkey % 3 = 2 THEN 'product' WHEN p_partkey % 3 = 1 THEN 'master' END AS raw_db,
  CASE WHEN p_partkey % 4 = 1 THEN 'finance' WHEN p_partkey % 4 > 1 THEN 'public' END AS raw_sch,
  CASE WHEN p_partkey % 3 = 2 THEN 'product' ELSE 'master' END AS db,
  CASE WHEN p_partkey % 4 = 1 THEN 'finance' ELSE 'public' END AS sch,
  'Table of ' || p_name AS description,
  'tag' || CAST(CAST(FLOOR(p_partkey / 4) AS BIGINT) AS VARCHAR(20)) AS tag,
  'c' || CAST(CAST(FLOOR(p_partkey / 5) AS BIGINT) AS VARCHAR(20)) AS collection,
  'custom.type' || CAST(CAST(FLOOR(p_partkey / 8) AS BIGINT) AS VARCHAR(20)) AS custom_type,
  p_type, p_size
FROM {part}
"""

# Columns of each cataloged table: name, type, data type id ('*' = the table's own type), sensitivity, pii.
COLUMN_TEMPLATE = (
    ("id", "integer", "id.surrogate", "internal", False),
    ("contact_email", "text", "pii.contact.email", "confidential", True),
    ("region_code", "text", "custom.sales_region", "internal", False),
    ("amount", "numeric", "*", "restricted", False),
    ("notes", "text", None, "internal", True),
)

_K = div("c_custkey", 50)
_KPATH = (
    "CASE WHEN k % 3 = 2 THEN 'product' ELSE 'master' END || '.' || "
    "CASE WHEN k % 4 = 1 THEN 'finance' ELSE 'public' END || '.t' || CAST(k AS VARCHAR(20))"
)

# Policies at scale: one per customer. family = key % 10, selector = (key div 10) % 5, k = target number.
POLICIES = f"""
SELECT c_custkey AS policy_id, 'policy-' || CAST(c_custkey AS VARCHAR(20)) AS name,
  c_custkey % 10 AS family_no, {div('c_custkey', 10)} % 5 AS selector_no, c_custkey AS k,
  CASE WHEN c_custkey % 3 = 0 THEN 'master' END AS only_db,
  CASE WHEN c_custkey % 11 = 3 THEN 'public' WHEN c_custkey % 11 = 7 THEN 'finance' END AS only_sch,
  {pick('c_custkey % 7', (850, 600, 550, 550, 300, 90, 700))} AS priority,
  c_nationkey AS nation, {_KPATH.replace('k %', 'c_custkey %').replace('CAST(k ', 'CAST(c_custkey ')} AS target_path
FROM {{customer}}
"""


# Rulings on authored purpose entries: entry, key, category, fenced, kind.
DISPOSITIONS = (
    ("analytics", None, "analytics", False, "registry_category"),
    ("marketing", None, "marketing", False, "registry_category"),
    ("legacy_reporting", "analytics.reporting", None, False, "normalized_key"),
    ("outreach_0", "marketing.outreach", None, True, "do_not_map"),
    ("outreach_1", None, None, False, "deliberate_conflict"),
    ("never_used", None, None, False, None),
)

PUBLICATIONS = (
    ("pub-0", "2023-12-31 00:00:00"),
    ("pub-1", "2024-01-10 00:00:00"),
    ("pub-2", "2024-01-20 00:00:00"),
)


@dataclass
class Oracle:
    """Common table expressions the checking SQL builds on, in dependency order."""

    parts: dict = field(default_factory=dict)

    def add(self, name, needs, text):
        self.parts[name] = (needs, text)

    def with_(self, *names):
        seen = []

        def visit(name):
            for need in self.parts[name][0]:
                visit(need)
            if name not in seen:
                seen.append(name)

        for name in names:
            visit(name)
        return "WITH " + ",\n".join(f"{n} AS ({self.parts[n][1]})" for n in seen) + "\n"
