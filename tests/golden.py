"""A small governed estate and the answers it must give.

The policies, catalog and cases below are fixed values: they restate the published
demo estate this engine has to agree with.
"""

from datetime import datetime

NOW = datetime(2026, 7, 30)
MAPPED = "usage_guidance:spec.usage.permittedUses:permitted"
BANNED = "usage_guidance:spec.usage.prohibitedUses:prohibited"
LIMITS = "ai_governance:spec.aiGovernance:restrictions"

# database.schema.table: (tags, {column: data type id})
CATALOG = {
    "master.public.customers": (
        ["pii", "privacy_sensitive"],
        dict(
            customer_id=None, customer_name="pii.identity.full_name", email="pii.contact.email", account_status=None,
            arr="financial.revenue", region="custom.sales_region", marketing_consent="custom.consent_flag",
            consent_measurement="custom.consent_flag", consent_personalization="custom.consent_flag",
            consent_activation="custom.consent_flag", created_at=None,
        ),
    ),
    "master.public.subscriptions": (["financial"], dict(customer_id=None, arr="financial.revenue", end_date=None)),
    "product.public.product_usage_events": (
        ["telemetry"], dict(customer_id=None, device_id="technical.device_id", event_name=None, occurred_at=None),
    ),
    "product.public.support_tickets": (["support"], dict(ticket_id=None, ticket_text="custom.support_free_text")),
    "master.public.customer_exports": (["restricted_transfer"], dict(export_id=None, email="pii.contact.email")),
    "master.public.payment_methods": (
        ["pci"], dict(payment_method_id=None, card_token="financial.credit_card", card_last4="financial.credit_card"),
    ),
    "master.public.employees": (
        ["hr"],
        dict(
            employee_id=None, full_name="pii.identity.full_name", work_email="pii.contact.email",
            national_id="pii.government_id.national_id", salary="financial.salary", region="custom.sales_region",
        ),
    ),
    "product.public.ml_feature_store": (["ml"], dict(feature_id=None)),
    "master.public.legacy_customer_backup": ([], dict(customer_id=None, customer_name=None, email=None, exported_at=None)),
    "master.public.marketing_prospects": (["marketing"], dict(prospect_id=None, contact_email="pii.contact.email")),
    "master.finance.invoices": (["financial"], dict(invoice_id=None, amount="financial.revenue")),
    "master.finance.revenue_ledger": (["financial"], dict(invoice_id=None, amount="financial.revenue")),
    "master.public.ad_audience_exports": (["marketing"], dict(export_id=None)),
    "master.finance.payment_transactions": (
        ["payments"], dict(transaction_id=None, amount="financial.revenue", settlement_state=None),
    ),
    "master.finance.processor_settlements": (["payments"], dict(transaction_id=None)),
    "master.finance.network_settlements": (["payments"], dict(transaction_id=None, settlement_state=None)),
    "care.public.member_records": (
        ["health", "privacy_sensitive"],
        dict(member_id=None, diagnosis_code="custom.clinical_code", clinical_notes="custom.clinical_free_text"),
    ),
    "benefits.public.applicants": (["government"], dict(applicant_id=None, categorical_flag=None)),
    "benefits.public.qualifying_conditions": (["government"], dict(condition_id=None)),
}
COLLECTION = ("customer-view", ["customers", "subscriptions", "support_tickets", "customer_exports", "ml_feature_store"])


def on(databases, schemas="public", **targets):
    return dict(databases=databases.split(), schemas=schemas.split(), **targets)


def uses(ok=None, no=None):
    return dict(permitted_uses=ok and ok.split(), prohibited_uses=no and no.split())


# name, priority, selector, spec, scenario map
POLICIES = [
    ("adtech transfer", 600, on("master", tables=["ad_audience_exports"]),
     dict(transfer=("deny", [("conditional", ["export"], ["APPROVED_DSP_A", "APPROVED_DSP_B"], None, None, True, None, None)])), {}),
    ("audience use", 550, on("master", tables=["customers"]),
     uses("analytics.reporting", "marketing.personalization sharing.third_party"), {BANNED: "purpose.prohibited_use"}),
    ("audience consent", 600, on("master", tables=["customers"]),
     dict(consent=[("analytics.reporting", "consent_measurement", "measurement"),
                   ("marketing.personalization", "consent_personalization", "personalization"),
                   ("sharing.third_party", "consent_activation", "activation")]), {}),
    ("categorical eligibility", 850, on("benefits", tables=["applicants"]), uses("benefits.determination"),
     {MAPPED: "ai.automated_decisioning"}),
    ("income test", 550, on("benefits", tables=["applicants"]), dict(ai=(None, None, None, ["income test"])),
     {LIMITS: "ai.automated_decisioning"}),
    ("statute 2025", 550, on("benefits", tables=["applicants"]),
     dict(uses("benefits.determination"), effective_until="2027-01-01T00:00:00Z"), {MAPPED: "compliance.regulatory"}),
    ("statute 2026", 550, on("benefits", tables=["applicants", "qualifying_conditions"]),
     dict(ai=(None, None, None, ["checklist first"]), effective_from="2027-01-01T00:00:00Z"), {LIMITS: "compliance.regulatory"}),
    ("verification permit", 550, on("benefits", tables=["applicants"]), uses("verification_outreach"), {}),
    ("verification block", 550, on("benefits", tables=["applicants"]), uses(None, "verification_outreach"), {}),
    ("clinical masking", 600,
     on("care", columns=["care.public.member_records.diagnosis_code", "care.public.member_records.clinical_notes"]),
     dict(masking=("full", ["clinical"])), {}),
    ("care consent", 600, on("care", tables=["member_records"]),
     dict(consent=[("care.eligibility", "coverage_status", "active"), ("research.general", "research_consent", "research"),
                   ("marketing.advertising", "consumer_marketing_consent", "opt-in")]), {}),
    ("member roles", 550, on("care", tables=["member_records"]), dict(allowed_roles=["clinical"]), {}),
    ("research anonymization", 550, on("care", tables=["member_records"]), dict(ai=(False, None, True, None)), {}),
    ("care use", 550, on("care", tables=["member_records"]),
     uses("care.treatment care.eligibility", "marketing.advertising marketing.personalization"), {BANNED: "purpose.prohibited_use"}),
    ("customer view", 550, on("master product", collections=["customer-view"]), uses("analytics.reporting"), {MAPPED: "sharing.internal"}),
    ("customer guardrails", 550,
     on("master product", tables=["customers", "support_tickets", "product_usage_events"], tags=["privacy_sensitive"]),
     dict(uses("analytics reporting support", "marketing advertising personalization ml_training"), ai=(False, True, True, None)),
     {BANNED: "purpose.prohibited_use"}),
    ("device hashing", 550, on("product", columns=["product.public.product_usage_events.device_id"]), dict(masking=("hash", None)), {}),
    ("email masking", 550, on("master product", taxonomy_types=["pii.contact.email"]),
     dict(masking=("partial", ["DATA_STEWARD", "PRIVACY_ADMIN"])), {}),
    ("employee access", 550, on("master", tables=["employees"]),
     dict(uses("reporting"), allowed_roles=["HR_ADMIN", "PEOPLE_OPS"], denied_roles=["PUBLIC"]), {}),
    ("employee gdpr", 90, on("master", tables=["employees"]),
     dict(uses(None, "public_sharing"), regulations=["GDPR"], retention=("7 years", "employment end", "delete")),
     {BANNED: "sharing.public"}),
    ("employee region", 550, on("master", tables=["employees"]), dict(row_filter=(["PEOPLE_OPS"], "region = caller")), {}),
    ("finance guardrails", 550, on("master", "finance", tables=["invoices", "revenue_ledger"]),
     uses("compliance.reporting compliance.audit", "sharing.external"), {BANNED: "sharing.public"}),
    ("name review", 300, on("master", columns=["master.public.employees.full_name"]),
     dict(masking=("custom.vault_mask", None), enforcement_mode="monitor"), {}),
    ("master windows", 700, on("master", tables=["customers"]),
     dict(window=(["agent", "analyst"], "created_at", [("research.general", "rolling", 90), ("commercial.general", "rolling", 30)])), {}),
    ("embedding guardrails", 550, on("product", tables=["ml_feature_store"]), uses("embedding_storage", "ai"),
     {MAPPED: "ai.embedding_storage", BANNED: "ai.automated_decisioning"}),
    ("feature lifecycle", 550, on("product", tables=["ml_feature_store"]),
     dict(uses("ai.inference", "ai.third_party_export"), ai=(True, True, None, None)),
     {MAPPED: "ai.retrieval_context", BANNED: "ai.vendor_transfer"}),
    ("payment protection", 850,
     on("master", columns=["master.public.payment_methods.card_token", "master.public.payment_methods.card_last4"]),
     dict(masking=("tokenize", None)), {}),
    ("network authority", 550, on("master", "finance", tables=["network_settlements"]), uses("fraud.detection analytics.reporting"), {}),
    ("processor reconciliation", 550, on("master", "finance", tables=["processor_settlements"]), uses("compliance.audit operations.support"), {}),
    ("transaction operations", 550, on("master", "finance", tables=["payment_transactions"]),
     dict(uses("operations.support"), ai=(None, None, None, ["reconciled rows only"])), {LIMITS: "quality.reliability"}),
    ("product windows", 700, on("product", tables=["product_usage_events"]),
     dict(window=(["agent", "analyst"], "occurred_at", [("research.general", "as_of", 90), ("commercial.general", "as_of", 30)])), {}),
    ("prospect permit", 550, on("master", tables=["marketing_prospects"]), uses("prospect_outreach"), {}),
    ("prospect block", 550, on("master", tables=["marketing_prospects"]), uses(None, "prospect_outreach"), {}),
    ("revenue retention", 90, on("master", tables=["subscriptions"]),
     dict(uses("analytics reporting renewal_planning"), retention=("5 years", "subscription end", "archive")), {}),
    ("salary masking", 550, on("master", columns=["master.public.employees.salary", "master.public.employees.national_id"]),
     dict(masking=("full", None)), {}),
    ("ticket redaction", 550, on("product", columns=["product.public.support_tickets.ticket_text"]), dict(masking=("redact", None)), {}),
    ("transfer guardrails", 600, on("master", tables=["customers", "customer_exports"]),
     dict(transfer=("conditional", [
         ("conditional", ["export"], ["SALESFORCE"], ["US"], ["EU"], True, True, "PRIVACY_ADMIN"),
         ("deny", None, ["ADS_PLATFORM"], None, None, None, None, None),
         ("deny", None, ["EXTERNAL_LLM_VENDOR"], None, None, None, None, None)])), {}),
]

C, EMP, ML = "master.public.customers", "master.public.employees", "product.public.ml_feature_store"
CARE, APP = "care.public.member_records", "benefits.public.applicants"
PAY = "master.finance.payment_transactions"
USE, BAN, READ = "purpose.allowed_use", "purpose.prohibited_use", "access.read"
SEND, CONSENT, MASK, RULE = "residency.cross_border_transfer", "consent.required", "masking.display", "compliance.regulatory"
REVIEW, NONE = "review_required", "not_enough_published_state"


def ask(asset, scenario, decision=None, state="answered", reason=None, conditions=(), obligations=(), **request):
    return dict(asset=asset, scenario=scenario, decision=decision, state=state, reason=reason,
                conditions=set(conditions), obligations=set(obligations), request=request)


def export(asset, system, decision, conditions=(), dest="US", consumer="US"):
    return ask(asset, SEND, decision, conditions=conditions, operation="export", dest_system=system,
               dest_jurisdiction=dest, consumer_jurisdiction=consumer)


AUTHORIZE = [
    ask(C, BAN, "deny"),
    ask(C, USE, "allow", purpose="analytics.reporting"),
    ask(C, USE, state=REVIEW, reason="decision_requires_review"),
    ask("product.public.support_tickets", USE, state=REVIEW, purpose="operations.support"),
    ask("product.public.support_tickets", "ai.training", "deny"),
    ask(C, "ai.inference", "allow"),
    export(C, "SALESFORCE", "conditional", ["approval_required", "anonymize_first"], consumer="EU"),
    export(C, "ADS_PLATFORM", "deny"),
    export(C, "EXTERNAL_LLM_VENDOR", "deny"),
    export("master.public.customer_exports", "INTERNAL_WAREHOUSE", "conditional", ["approval_required"]),
    ask(EMP, READ, "deny"),
    ask(EMP + ".full_name", MASK, state=REVIEW),
    ask(ML, "ai.training", "allow"),
    ask(ML, "ai.retrieval_context", "allow", purpose="ai.inference"),
    ask(ML, "ai.embedding_storage", state=REVIEW, reason="decision_requires_review", purpose="ai.inference"),
    ask(ML, "ai.vendor_transfer", "deny"),
    ask(ML, "ai.automated_decisioning", "deny"),
    ask("master.public.legacy_customer_backup", USE, state=NONE, reason="no_published_instruction_state"),
    ask(EMP, "sharing.public", "deny"),
    ask("master.public.subscriptions", "sharing.internal", "allow", purpose="analytics.reporting"),
    ask("master.public.marketing_prospects", USE, state=REVIEW, reason="conflicted_published_state"),
    ask("master.public.subscriptions", "retention.lifecycle", "retain", obligations=["retain"]),
    ask(EMP, "access.row_filter", "conditional", conditions=["role_restricted"]),
    ask(EMP, RULE, "log_only"),
    ask("master.public.payment_methods.card_token", MASK, "mask_full", obligations=["mask"]),
    ask("master.finance.invoices", USE, "allow", purpose="compliance.reporting"),
    ask("master.finance.revenue_ledger", "sharing.public", "deny"),
    ask(C, READ, "conditional", conditions=["data_window_required"], purpose="research.general", role="agent"),
    ask(C, READ, "conditional", conditions=["data_window_required"], purpose="commercial.general", role="agent"),
    ask("product.public.product_usage_events", READ, "conditional", conditions=["data_window_required"],
        purpose="research.general", role="agent", as_of=datetime(2026, 8, 1)),
    ask("product.public.product_usage_events", READ, "conditional", conditions=["data_window_required"],
        purpose="commercial.general", role="agent", as_of=datetime(2026, 8, 1)),
    ask(C, READ, state=REVIEW, reason="access_window_context_required", role="agent"),
    ask("product.public.product_usage_events", READ, state=REVIEW, reason="access_window_context_required",
        purpose="research.general", role="agent"),
    ask(C, USE, state=REVIEW, reason="decision_requires_review", purpose="marketing.personalization"),
    ask(C, BAN, "deny", purpose="marketing.personalization"),
    ask(C, CONSENT, "conditional", conditions=["consent_required"], purpose="analytics.reporting"),
    ask(C, CONSENT, "conditional", conditions=["consent_required"], purpose="marketing.personalization"),
    ask(C, CONSENT, "conditional", conditions=["consent_required"], purpose="sharing.third_party"),
    ask(C, CONSENT, state=REVIEW, reason="consent_context_required"),
    export("master.public.ad_audience_exports", "APPROVED_DSP_A", "conditional", ["approval_required"], None, None),
    export("master.public.ad_audience_exports", "UNLISTED_DSP", "deny", (), None, None),
    ask("master.finance.network_settlements", USE, "allow", purpose="fraud.detection"),
    ask(PAY, USE, state=REVIEW, reason="decision_requires_review", purpose="fraud.detection"),
    ask(PAY, USE, "allow", purpose="operations.support"),
    ask("master.finance.processor_settlements", USE, "allow", purpose="compliance.audit"),
    ask(PAY, "quality.reliability", "conditional", conditions=["ai_restriction"], purpose="analytics.reporting"),
    ask(CARE, READ, "allow", role="clinical"),
    ask(CARE, READ, state=REVIEW, reason="decision_requires_review", role="member_services"),
    ask(CARE, READ, state=REVIEW, reason="decision_requires_review", role="research"),
    ask(CARE, READ, state=REVIEW, reason="decision_requires_review", role="marketing"),
    ask(CARE + ".clinical_notes", MASK, "allow", role="clinical"),
    ask(CARE + ".clinical_notes", MASK, "mask_full", obligations=["mask"], role="member_services"),
    ask(CARE, USE, "allow", purpose="care.eligibility", role="member_services"),
    ask(CARE, "protection.anonymization", "conditional", conditions=["anonymize_first"], purpose="research.general", role="research"),
    ask(CARE, "ai.training", "deny", role="research"),
    ask(CARE, BAN, "deny", purpose="marketing.advertising", role="marketing"),
    ask(CARE, CONSENT, "conditional", conditions=["consent_required"], purpose="care.eligibility"),
    ask(CARE, CONSENT, "conditional", conditions=["consent_required"], purpose="research.general"),
    ask(CARE, CONSENT, "conditional", conditions=["consent_required"], purpose="marketing.advertising"),
    ask(CARE, CONSENT, state=REVIEW, reason="consent_context_required", purpose="care.treatment", role="clinical"),
    ask(APP, RULE, "allow", purpose="benefits.determination"),
    ask(APP, RULE, "conditional", conditions=["ai_restriction"], purpose="benefits.determination", as_of=datetime(2027, 2, 1)),
    ask("benefits.public.qualifying_conditions", RULE, state=NONE, reason="not_currently_effective", purpose="benefits.determination"),
    ask(APP, "ai.automated_decisioning", "conditional", conditions=["ai_restriction"], purpose="benefits.determination"),
    ask(APP, USE, state=REVIEW, reason="conflicted_published_state"),
]


def check(tables, columns, verdict, scenario=USE, state=None, star=False, days=None, ungoverned=(), **query):
    return dict(tables=tables.split(), columns=columns.split(), verdict=verdict, scenario=scenario, state=state, star=star,
                days=days, ungoverned=set(ungoverned), query=query)


READER = dict(scenario=READ, role="agent")
AUG = datetime(2026, 8, 1)
VALIDATE = [
    check("customers", "region arr", "pass", purpose="analytics.reporting"),
    check("customers", "customer_name email region", "warn"),
    check("customers", "customer_name email marketing_consent", "fail", BAN),
    check("product.public.support_tickets", "ticket_text", "fail", "ai.training"),
    check("payment_methods", "card_last4", "warn"),
    check("employees", "salary", "fail", None),
    check("employees", "work_email", "warn"),
    check("customers subscriptions", "region arr customer_id", "pass", purpose="analytics.reporting"),
    check("payment_methods", "", "warn", star=True),
    check("payment_methods", "payment_method_id", "pass"),
    check("subscriptions", "customer_id arr end_date", "pass", purpose="analytics.reporting"),
    check("customers legacy_customer_backup", "customer_name exported_at customer_id", "warn", purpose="analytics.reporting",
          ungoverned=["legacy_customer_backup"]),
    check("customers", "region", "pass", purpose="analytics.reporting"),
    check("customers", "region", "fail", BAN),
    check("finance.invoices finance.revenue_ledger", "invoice_id amount", "pass", purpose="compliance.reporting"),
    check("master.public.customers", "customer_id account_status created_at", "pass", days=90, purpose="research.general", **READER),
    check("master.public.customers", "customer_id account_status created_at", "pass", days=30, purpose="commercial.general", **READER),
    check("master.public.customers", "customer_id account_status created_at", "fail", days=90, purpose="commercial.general", **READER),
    check("product.public.product_usage_events", "customer_id event_name occurred_at", "pass", days=90, as_of=AUG,
          purpose="research.general", **READER),
    check("product.public.product_usage_events", "customer_id event_name occurred_at", "pass", days=30, as_of=AUG,
          purpose="commercial.general", **READER),
    check("product.public.product_usage_events", "customer_id event_name occurred_at", "fail", days=90, as_of=AUG,
          purpose="commercial.general", **READER),
    check("customers", "customer_id consent_measurement consent_personalization consent_activation", "pass", purpose="analytics.reporting"),
    check("customers", "customer_id consent_measurement consent_personalization consent_activation", "warn", state=REVIEW,
          purpose="marketing.personalization"),
    check("master.finance.payment_transactions", "transaction_id settlement_state", "warn", state=REVIEW, purpose="fraud.detection"),
    check("master.finance.network_settlements", "transaction_id settlement_state", "pass", purpose="fraud.detection"),
    check("master.finance.payment_transactions", "transaction_id amount", "warn", "quality.reliability", purpose="analytics.reporting"),
    check("care.public.member_records", "member_id clinical_notes", "pass", purpose="care.treatment", role="clinical"),
    check("care.public.member_records", "member_id clinical_notes", "warn", purpose="care.treatment", role="member_services"),
    check("benefits.public.applicants", "applicant_id categorical_flag", "pass", RULE, purpose="benefits.determination"),
    check("benefits.public.applicants", "applicant_id categorical_flag", "warn", RULE, purpose="benefits.determination",
          as_of=datetime(2027, 2, 1)),
]


def _spec(selector, spec, priority):
    from stewardry.schemas import POLICY_SPEC, SELECTOR

    row = {f.name: spec.get(f.name) for f in POLICY_SPEC.fields}
    row["enforcement_mode"] = spec.get("enforcement_mode", "enforce")
    row["priority"] = priority
    row["sensitivity"], row["category"] = "confidential", "pii"
    row["selector"] = tuple(selector.get(f.name) for f in SELECTOR.fields)
    return tuple(row[f.name] for f in POLICY_SPEC.fields)


def policies(spark):
    from stewardry import schemas

    rows = [
        (i, name, 1, True, datetime(2026, 7, 16), _spec(selector, spec, priority),
         {k: (v, "user_confirmed") for k, v in scenario_map.items()})
        for i, (name, priority, selector, spec, scenario_map) in enumerate(POLICIES, start=1)
    ]
    return spark.createDataFrame(rows, schemas.POLICY)


def catalog(spark):
    tables, columns = [], []
    for path, (tags, cols) in CATALOG.items():
        scope = path.split(".")
        tables.append((*scope, tags))
        columns += [(*scope, name, kind) for name, kind in cols.items()]
    return (
        spark.createDataFrame(tables, "database string, schema string, table string, tags array<string>"),
        spark.createDataFrame(columns, "database string, schema string, table string, column string, data_type_id string"),
        spark.createDataFrame([(COLLECTION[0], m) for m in COLLECTION[1]], "collection_id string, member_table string"),
    )


def requests(spark):
    from stewardry.schemas import REQUEST

    rows = []
    for i, case in enumerate(AUTHORIZE):
        parts = case["asset"].split(".")
        base = dict(
            request_id=i, requested_at=NOW, database=parts[0], schema=parts[1], table=parts[2],
            column=parts[3] if len(parts) > 3 else None, scenario=case["scenario"], **case["request"],
        )
        rows.append(tuple(base.get(f.name) for f in REQUEST.fields))
    return spark.createDataFrame(rows, REQUEST)


def query_refs(spark):
    from datetime import timedelta

    rows = []
    for i, case in enumerate(VALIDATE):
        as_of = case["query"].get("as_of")
        upper = (as_of or NOW) if case["days"] else None
        for n, name in enumerate(case["tables"], start=1):
            rows.append(
                (i, n, NOW, name, "master", "public", case["columns"], case["star"], [], case["scenario"],
                 case["query"].get("purpose"), case["query"].get("role"), as_of,
                 upper - timedelta(days=case["days"]) if upper else None, upper)
            )
    return spark.createDataFrame(
        rows,
        "query_id long, ref_no int, requested_at timestamp_ntz, ref_name string, default_db string, default_sch string, "
        "columns array<string>, star boolean, ctes array<string>, scenario string, purpose string, role string, "
        "as_of timestamp_ntz, window_lower timestamp_ntz, window_upper timestamp_ntz",
    )
