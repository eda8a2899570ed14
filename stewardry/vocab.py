"""Closed vocabularies of the decision layer.

Every value in this module is a fixed value of the answer contract: callers
match on these strings, so they are spelled out plainly and in natural order.
"""

STATES = ("answered", "review_required", "not_enough_published_state")

# Most severe first; the position is the severity rank used by composition.
DECISIONS = (
    "deny",
    "require_review",
    "conditional",
    "mask_full",
    "mask_partial",
    "retain",
    "log_only",
    "allow",
)
SEVERITY = {decision: rank for rank, decision in enumerate(DECISIONS, start=1)}

VERDICTS = ("pass", "warn", "fail")

REASON_NO_STATE = "no_published_instruction_state"
REASON_NOT_EFFECTIVE = "not_currently_effective"
REASON_SCENARIO = "scenario_unresolved"
REASON_REVIEW = "decision_requires_review"
REASON_CONFLICT = "conflicted_published_state"
REASON_WINDOW = "access_window_context_required"
REASON_CONSENT = "consent_context_required"

CONDITION_KINDS = (
    "approval_required",
    "anonymize_first",
    "role_restricted",
    "ai_restriction",
    "data_window_required",
    "consent_required",
)

# Families that only describe an asset; a table covered by nothing else is thin.
CONTEXT_FAMILIES = ("classification", "business_context", "compliance")

FAMILY_SCENARIO = {
    "usage_guidance": "purpose.allowed_use",
    "role_grant": "access.read",
    "access_window": "access.read",
    "row_access": "access.row_filter",
    "masking": "masking.display",
    "consent_requirement": "consent.required",
    "transfer_governance": "residency.cross_border_transfer",
    "retention": "retention.lifecycle",
    "compliance": "compliance.regulatory",
    "classification": "classification.sensitivity",
    "business_context": "metadata.domain",
}
AI_SCENARIO = {
    "training": "ai.training",
    "inference": "ai.inference",
    "anonymization": "protection.anonymization",
    "restrictions": "ai.inference",
}

MASK_DECISION = {
    "partial": "mask_partial",
    "full": "mask_full",
    "redact": "mask_full",
    "tokenize": "mask_full",
    "hash": "mask_full",
}

SENSITIVITY_RANK = {"public": 0, "internal": 1, "confidential": 2, "restricted": 3}

# Gate vocabulary.
SQL_KINDS = ("sql_model", "migration_sql", "ad_hoc_sql")
USE_KINDS = ("export_job", "ai_training_job", "tool_use", "data_job")
PASS_DECISIONS = ("allow", "log_only", "retain")
CONTROL_DECISIONS = ("conditional", "mask_full", "mask_partial")
GATES = ("pass", "needs_controls", "needs_review", "fail")
DENY_CODES = {
    "purpose.prohibited_use": "PROHIBITED_USE",
    "ai.training": "AI_TRAINING_BLOCKED",
    "residency.cross_border_transfer": "TRANSFER_DENIED",
}
CONDITION_CODES = {
    "approval_required": "APPROVAL_REQUIRED",
    "anonymize_first": "ANONYMIZATION_REQUIRED",
    "role_restricted": "ROLE_RESTRICTED",
    "ai_restriction": "AI_RESTRICTION",
}
EXCEPTION_STATUSES = (
    "ready_without_exception",
    "pending_human_review",
    "resumed_with_controls",
    "requires_changes",
    "rejected_by_reviewer",
    "blocked_by_policy",
    "needs_policy_review",
)
