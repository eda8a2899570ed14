"""What one served rule says about one request.

Every expression takes the rule as a struct column, so the same text serves the
exploded form (one row per request and rule) and the array form (rules of a
scope kept as ``array<struct>`` and evaluated in place, without a shuffle).
"""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from stewardry import vocab
from stewardry.functions.expr import asset_path, in_force, lookup, role_is_listed, severity
from stewardry.functions.scale import BROADCAST_ROWS, fits, salted_join
from stewardry.schemas import CONDITION, OBLIGATION

SCOPE = ["database", "schema", "table", "column_key", "scenario"]


def _keyed(df):
    return df.withColumn("column_key", F.coalesce(F.col("column"), F.lit("")))


def packed_rules(rules, by=()):
    """Rules as scope keys plus one struct, ready for either join form.

    ``by`` names further equi keys, such as the publication a rule was served in.
    """
    body = [c for c in rules.columns if c not in ("database", "schema", "table", "scenario", *by)]
    return _keyed(rules).select(
        *by,
        *SCOPE,
        F.struct(*[F.col(c) for c in body], asset_path("database", "schema", "table", "column").alias("path")).alias("rule"),
    )


def candidate_rules(requests, rules, how="inner", limit=BROADCAST_ROWS, by=(), spread_by="request_id"):
    """Requests with each rule of their asset scope and scenario (exploded form)."""
    keyed, packed, keys = _keyed(requests), packed_rules(rules, by), [*by, *SCOPE]
    if fits(packed, limit):
        out = keyed.join(F.broadcast(packed), keys, how)
    else:
        out = salted_join(keyed, packed, keys, how, spread_by=[spread_by])
    return out.drop("column_key")


def with_rule_arrays(requests, rules, limit=BROADCAST_ROWS, small=None, by=()):
    """Each request with the rules of its scope as one array; no request is shuffled
    while the rule table fits the broadcast limit.

    A scope's array is as long as its rules. Where scopes are crowded, the row forms
    (:func:`decided_pairs` and the aggregates over it) give the same answers without arrays.
    """
    keyed, packed, keys = _keyed(requests), packed_rules(rules, by), [*by, *SCOPE]
    grouped = packed.groupBy(*keys).agg(F.collect_list("rule").alias("rules"))
    if fits(rules, limit) if small is None else small:
        out = keyed.join(F.broadcast(grouped), keys, "left")
    else:
        out = salted_join(keyed, grouped, keys, "left", spread_by=["request_id"])
    return out.drop("column_key")


def judged(rules, q):
    """Rules in force with what each says: array of (rule, decision), NULLs dropped.

    Later expressions read the decision as a field, so the family chain runs once
    per rule however often the result is looked at.
    """
    said = F.transform(rules, lambda r: F.struct(r.alias("rule"), decision(r, q).alias("decision")))
    return F.filter(said, lambda x: x["decision"].isNotNull())


def effective(rule, instant):
    return in_force(rule["effective_from"], rule["effective_until"], instant)


# --- one expression per family -------------------------------------------------


def permitted_use(rule, q):
    covered = F.exists(rule["uses"], lambda u: (u == q["purpose"]) | (u == q["purpose_category"]))
    return F.when(F.coalesce(covered, F.lit(False)), "allow").otherwise("require_review")


def prohibited_use(rule, q):
    return F.lit("deny")


def role_allow(rule, q):
    return F.when(role_is_listed(rule["roles"], q["role"]), "allow").otherwise("require_review")


def role_deny(rule, q):
    """A denied role bites its holders; PUBLIC bites a caller with no role."""
    return F.when(F.coalesce(q["role"], F.lit("PUBLIC")) == rule["grant_role"], F.lit("deny"))


def masking(rule, q):
    exempt = role_is_listed(rule["masking"]["exempt_roles"], q["role"])
    return F.when(exempt, "allow").otherwise(mask_decision(rule["masking"]["method"]))


def mask_decision(method):
    """partial -> mask_partial, other known methods -> mask_full, custom.* -> review."""
    return F.coalesce(lookup(method, vocab.MASK_DECISION), F.lit("require_review"))


def monitored_custom(rule):
    return (rule["mode"] == "monitor") & rule["masking"]["method"].startswith("custom.")


def matched_transfer(rule, q):
    """First transfer rule whose stated dimensions all match, else NULL."""

    def states(values, value):
        return values.isNull() | F.coalesce(F.array_contains(values, value), F.lit(False))

    return F.get(
        F.filter(
            rule["transfer"]["rules"],
            lambda t: states(t["operations"], q["operation"])
            & states(t["systems"], q["dest_system"])
            & states(t["dest_jurisdictions"], q["dest_jurisdiction"])
            & states(t["consumer_jurisdictions"], q["consumer_jurisdiction"]),
        ),
        F.lit(0),
    )


def transfer(rule, q):
    return F.coalesce(matched_transfer(rule, q)["effect"], rule["transfer"]["default_effect"])


def window_rule(rule, q):
    return F.get(
        F.filter(rule["window"]["rules"], lambda w: w["purpose"] == q["purpose"]), F.lit(0)
    )


def window_bounds(rule, q):
    """(lower, upper): as-of windows anchor on the declared instant, never on now."""
    matched = window_rule(rule, q)
    anchor = F.when(matched["type"] == "as_of", q["as_of"]).otherwise(q["requested_at"])
    return anchor - F.make_dt_interval(matched["lookback_days"]), anchor


def window_context_missing(rule, q):
    matched = window_rule(rule, q)
    return matched["purpose"].isNull() | ((matched["type"] == "as_of") & q["as_of"].isNull())


def access_window(rule, q):
    listed = role_is_listed(rule["window"]["actor_roles"], q["role"])
    return F.when(listed & ~window_context_missing(rule, q), "conditional").otherwise(
        "require_review"
    )


def consent_rule(rule, q):
    return F.get(F.filter(rule["consent"], lambda c: c["purpose"] == q["purpose"]), F.lit(0))


def consent(rule, q):
    return F.when(consent_rule(rule, q)["purpose"].isNotNull(), "conditional").otherwise(
        "require_review"
    )


def row_access(rule, q):
    return F.lit("conditional")


def ai_lifecycle(rule, q):
    return rule["base_decision"]


def retention(rule, q):
    return F.lit("retain")


def context_only(rule, q):
    return F.lit("log_only")


FAMILIES = {
    ("usage_guidance", "permitted"): permitted_use,
    ("usage_guidance", "prohibited"): prohibited_use,
    ("role_grant", "allow"): role_allow,
    ("role_grant", "deny"): role_deny,
    ("masking", None): masking,
    ("transfer_governance", None): transfer,
    ("access_window", None): access_window,
    ("consent_requirement", None): consent,
    ("row_access", None): row_access,
    ("ai_governance", None): ai_lifecycle,
    ("retention", None): retention,
    ("compliance", None): context_only,
    ("classification", None): context_only,
    ("business_context", None): context_only,
}


def decision(rule, q):
    """Decision of any rule; NULL when a denied role does not concern the caller."""
    out = F.lit("require_review")
    for (family, kind), expression in FAMILIES.items():
        here = rule["family"] == family
        if kind:
            here = here & (rule["kind"] == kind)
        out = F.when(here, expression(rule, q)).otherwise(out)
    return out


def reason_code(rule, q, decided):
    listed = role_is_listed(rule["window"]["actor_roles"], q["role"])
    return F.when(
        decided == "require_review",
        F.when(
            (rule["family"] == "access_window") & listed & window_context_missing(rule, q),
            F.lit(vocab.REASON_WINDOW),
        )
        .when(rule["family"] == "consent_requirement", F.lit(vocab.REASON_CONSENT))
        .otherwise(F.lit(vocab.REASON_REVIEW)),
    )


# --- conditions and obligations ------------------------------------------------


def _condition(kind, requirement, rule, role=None):
    return F.struct(
        F.lit(kind).alias("kind"),
        requirement.alias("requirement"),
        rule["policy"].alias("policy"),
        (role if role is not None else F.lit(None).cast("string")).alias("required_role"),
    )


def transfer_text(rule, q):
    matched = matched_transfer(rule, q)
    where = F.concat(
        F.coalesce(q["dest_system"], F.lit("an unnamed system")),
        F.coalesce(F.concat(F.lit(" ("), q["dest_jurisdiction"], F.lit(")")), F.lit("")),
    )
    return F.when(
        matched["effect"].isNull(),
        F.concat(F.lit("No transfer rule matched "), where, F.lit("; the default effect applies.")),
    ).otherwise(F.concat(F.lit("Transfer to "), where, F.lit(" needs approval.")))


def stamp(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def conditions(rule, q, decided):
    """Conditions one conditional rule attaches; an empty array otherwise."""
    none = F.array().cast(ArrayType(CONDITION))
    matched = matched_transfer(rule, q)
    default = matched["effect"].isNull()
    approval = default | F.coalesce(matched["requires_approval"], F.lit(False)) | (
        ~F.coalesce(matched["requires_anonymization"], F.lit(False))
    )
    transfer_conditions = F.array_compact(
        F.array(
            F.when(
                F.coalesce(matched["requires_anonymization"], F.lit(False)),
                _condition("anonymize_first", F.lit("This data must be anonymized before the transfer."), rule),
            ),
            F.when(
                approval,
                _condition("approval_required", transfer_text(rule, q), rule, matched["required_role"]),
            ),
        )
    )
    lower, upper = window_bounds(rule, q)
    window_text = F.concat(
        F.lit("Constrain "), rule["window"]["time_column"], F.lit(" to "), stamp(lower),
        F.lit(" through "), stamp(upper), F.lit(" for "), q["purpose"], F.lit("."),
    )
    family, kind = rule["family"], rule["kind"]
    return F.when(
        decided != "conditional", none
    ).when(family == "transfer_governance", transfer_conditions).when(
        family == "access_window", F.array(_condition("data_window_required", window_text, rule))
    ).when(
        family == "consent_requirement",
        F.array(_condition("consent_required", consent_rule(rule, q)["requirement"], rule)),
    ).when(
        family == "row_access",
        F.array(
            _condition(
                "role_restricted",
                F.concat(
                    F.lit("Row-level access is restricted to role(s): "),
                    F.concat_ws(", ", rule["row_filter"]["roles"]), F.lit("."),
                ),
                rule,
            )
        ),
    ).when(
        (family == "ai_governance") & (kind == "anonymization"),
        F.array(
            _condition("anonymize_first", F.lit("This data must be anonymized before the proposed AI use."), rule)
        ),
    ).when(
        family == "ai_governance",
        F.transform(rule["restrictions"], lambda text: _condition("ai_restriction", text, rule)),
    ).otherwise(none)


def obligations(rule, decided):
    none = F.array().cast(ArrayType(OBLIGATION))

    def entry(kind, method):
        return F.array(
            F.struct(
                F.lit(kind).alias("type"),
                rule["path"].alias("target"),
                method.alias("method"),
                rule["policy"].alias("policy"),
            )
        )

    return (
        F.when(decided.isin("mask_full", "mask_partial"), entry("mask", rule["masking"]["method"]))
        .when(decided == "retain", entry("retain", F.lit(None).cast("string")))
        .otherwise(none)
    )


# --- exploded form ---------------------------------------------------------------

REQUEST_FIELDS = (
    "role", "purpose", "purpose_category", "operation", "dest_system", "dest_jurisdiction",
    "consumer_jurisdiction", "as_of", "requested_at", "instant",
)


def context():
    return {name: F.col(name) for name in REQUEST_FIELDS}


def decided_pairs(requests, rules, how="inner", limit=BROADCAST_ROWS, by=(), spread_by="request_id"):
    """Exploded form: request, rule, in_force, decision, rule_reason, severity."""
    pairs = candidate_rules(requests, rules, how, limit, by, spread_by)
    rule, q = F.col("rule"), context()
    return (
        pairs.withColumn("in_force", F.coalesce(effective(rule, q["instant"]), F.lit(False)) & rule["rule_id"].isNotNull())
        .withColumn("decision", F.when(F.col("in_force"), decision(rule, q)))
        .withColumn("rule_reason", reason_code(rule, q, F.col("decision")))
        .withColumn("severity", severity(F.col("decision")))
    )
