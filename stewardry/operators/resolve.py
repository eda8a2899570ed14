"""Policies and catalog to served rules.

A policy expands to its rules in one narrow pass; its selector resolves to
scopes by equi joins; the two meet on the policy key. The result is written once
per publication and read by every evaluation.
"""

from functools import reduce

from pyspark.sql import Window, functions as F

from stewardry import vocab
from stewardry.functions.expr import asset_path, lookup, stable_id
from stewardry.functions.scale import reference_join
from stewardry.operators.decide import mask_decision
from stewardry.schemas import PARAMETERS
from stewardry.session import materialize

SOURCE_ORDER = ("selector", "collection", "taxonomy", "tag")
# Selector field to the source its resolution path names.
SELECTORS = {
    "tables": "selector",
    "columns": "selector",
    "collections": "collection",
    "taxonomy_types": "taxonomy",
    "tags": "tag",
}
POLICY_KEY = ["policy_id", "version"]
SCOPE = ["database", "schema", "table", "column"]


# --- rules of a policy ---------------------------------------------------------


def rule_builder():
    """A function that shapes rule structs; the typed NULLs are made once."""
    blank = {name: F.lit(None).cast(kind).alias(name) for name, kind in PARAMETERS.items()}

    def rule(family, kind, key, base, **parameters):
        given = {name: value.cast(PARAMETERS[name]).alias(name) for name, value in parameters.items()}
        return F.struct(
            F.lit(family).alias("family"),
            F.lit(kind).cast("string").alias("kind"),
            key.alias("instruction_key"),
            base.cast("string").alias("base_decision"),
            *{**blank, **given}.values(),
        )

    return rule


def _has(column):
    return F.coalesce(F.size(column), F.lit(0)) > 0


def usage_rules(spec, rule):
    permitted, prohibited = spec["permitted_uses"], spec["prohibited_uses"]
    return F.array(
        F.when(
            _has(permitted),
            rule("usage_guidance", "permitted", F.lit("usage_guidance:spec.usage.permittedUses:permitted"),
                 F.lit("allow"), uses=permitted),
        ),
        F.when(
            _has(prohibited),
            rule("usage_guidance", "prohibited", F.lit("usage_guidance:spec.usage.prohibitedUses:prohibited"),
                 F.lit("deny"), uses=prohibited),
        ),
    )


def ai_rules(spec, rule):
    ai = spec["ai"]

    def key(name):
        return F.lit(f"ai_governance:spec.aiGovernance:{name}")

    def flag(name, column):
        return F.when(
            column.isNotNull(),
            rule("ai_governance", name, key(name), F.when(column, "allow").otherwise("deny")),
        )

    return F.array(
        flag("training", ai["allow_training"]),
        flag("inference", ai["allow_inference"]),
        F.when(
            F.coalesce(ai["requires_anonymization"], F.lit(False)),
            rule("ai_governance", "anonymization", key("anonymization"), F.lit("conditional")),
        ),
        F.when(
            _has(ai["restrictions"]),
            rule("ai_governance", "restrictions", key("restrictions"), F.lit("conditional"),
                 restrictions=ai["restrictions"]),
        ),
    )


def role_rules(spec, rule):
    def grants(column, kind, base, path):
        roles = F.coalesce(column, F.array().cast("array<string>"))
        return F.transform(
            roles,
            lambda role: rule(
                "role_grant", kind,
                F.concat(F.lit(f"role_grant:spec.accessControl.{path}:"), F.lower(role), F.lit(f":{kind}")),
                F.lit(base), grant_role=role, roles=roles,
            ),
        )

    return F.concat(
        grants(spec["allowed_roles"], "allow", "allow", "allowedRoles"),
        grants(spec["denied_roles"], "deny", "deny", "deniedRoles"),
    )


def masking_rules(spec, rule):
    masking = spec["masking"]
    return F.array(
        F.when(
            masking.isNotNull(),
            rule("masking", None, F.lit("masking:spec.accessControl.masking"),
                 mask_decision(masking["method"]), masking=masking),
        )
    )


def _interval(text):
    """'7 years' -> 7, 'years'; split once, here."""
    return F.split_part(text, F.lit(" "), F.lit(1)).cast("int"), F.split_part(text, F.lit(" "), F.lit(2))


def context_rules(spec, rule):
    def one(present, family, path, base, **parameters):
        return F.when(present, rule(family, None, F.lit(f"{family}:{path}"), base, **parameters))

    number, unit = _interval(spec["retention"]["period"])
    keep = F.struct(
        number.alias("period_n"), unit.alias("period_unit"),
        spec["retention"]["trigger"].alias("trigger"), spec["retention"]["action"].alias("action"),
    )
    regulations = F.transform(
        F.coalesce(spec["regulations"], F.array().cast("array<string>")),
        lambda name: rule(
            "compliance", None, F.concat(F.lit("compliance:spec.compliance.regulations:"), F.lower(name)),
            F.lit("log_only"), regulation=name,
        ),
    )
    return F.concat(
        F.array(
            one(spec["row_filter"].isNotNull(), "row_access", "spec.rowFilter.rules", F.lit("conditional"),
                row_filter=spec["row_filter"]),
            one(spec["transfer"].isNotNull(), "transfer_governance", "spec.transferGovernance",
                spec["transfer"]["default_effect"], transfer=spec["transfer"]),
            one(spec["window"].isNotNull(), "access_window", "spec.accessWindows", F.lit("conditional"),
                window=spec["window"]),
            one(_has(spec["consent"]), "consent_requirement", "spec.consentRequirements", F.lit("conditional"),
                consent=spec["consent"]),
            one(spec["retention"].isNotNull(), "retention", "spec.retention", F.lit("retain"), retention=keep),
            one(spec["sensitivity"].isNotNull(), "classification", "spec.classification", F.lit("log_only")),
            one(spec["business_context"].isNotNull(), "business_context", "metadata.businessContext",
                F.lit("log_only")),
        ),
        regulations,
    )


EXPANSIONS = {
    "usage": usage_rules,
    "ai": ai_rules,
    "role": role_rules,
    "masking": masking_rules,
    "context": context_rules,
}


def expand(policies, *parts):
    """Rules of each policy: explode of the non-null rule structs, no shuffle."""
    spec, rule = F.col("spec"), rule_builder()
    rules = F.array_compact(F.concat(*[EXPANSIONS[p](spec, rule) for p in parts or EXPANSIONS]))
    return policies.withColumn("rule", F.explode(rules))


def default_scenario(rule):
    out = F.lit(None).cast("string")
    for family, scenario in vocab.FAMILY_SCENARIO.items():
        out = F.when(rule["family"] == family, F.lit(scenario)).otherwise(out)
    for kind, scenario in vocab.AI_SCENARIO.items():
        out = F.when((rule["family"] == "ai_governance") & (rule["kind"] == kind), F.lit(scenario)).otherwise(out)
    return out


def assigned_scenario(rule, scenario_map):
    """The family's scenario unless the policy maps this instruction key elsewhere."""
    return F.coalesce(F.try_element_at(scenario_map, rule["instruction_key"])["scenario_key"], default_scenario(rule))


def band(priority, explicit=None):
    """Default band of an authored priority; an explicit band wins."""
    derived = F.when(priority >= 800, 3).when(priority >= 500, 2).otherwise(1)
    return derived if explicit is None else F.coalesce(explicit, derived)


def weight(priority, explicit=None):
    derived = F.when(priority < 100, 0.55).otherwise(1.0)
    return derived if explicit is None else F.coalesce(explicit, derived)


def validity(text):
    """ISO instant ('2027-01-01T00:00:00Z', any offset, or a plain date) to a zone-free UTC timestamp.

    A text without an offset is UTC; the session's time zone plays no part.
    """
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.contains(":")
    instant = F.to_timestamp(F.when(zoned, text).otherwise(F.concat(text, F.when(text.contains(":"), "Z").otherwise("T00:00:00Z"))))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


# --- selector targets ------------------------------------------------------------


def selector_keys(policies, fields=tuple(SELECTORS), carry=()):
    """What policies target: one (kind, value) row per selector entry, with the columns to ``carry``."""
    empty = F.array().cast("array<string>")

    def entries(field):
        listed = F.coalesce(F.col(f"spec.selector.{field}"), empty)
        return F.transform(listed, lambda v: F.struct(F.lit(field).alias("kind"), v.alias("value")))

    return policies.select(
        *POLICY_KEY, *carry,
        F.col("spec.selector.databases").alias("only_databases"),
        F.col("spec.selector.schemas").alias("only_schemas"),
        F.explode(F.concat(*[entries(f) for f in fields])).alias("_k"),
    ).select(*POLICY_KEY, *carry, "only_databases", "only_schemas", "_k.kind", "_k.value")


def _keys(df, column, *pairs):
    found = F.array(*[F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in pairs])
    return (
        df.withColumn("_k", F.explode(F.filter(found, lambda k: k["value"].isNotNull())))
        .select("database", "schema", "table", column.alias("column"), "_k.kind", "_k.value")
    )


def table_keys(tables):
    return _keys(tables, F.lit(None).cast("string"), ("tables", F.col("table")))


def tag_keys(tables):
    tagged = tables.withColumn("tag", F.explode(F.array_distinct("tags")))
    return _keys(tagged, F.lit(None).cast("string"), ("tags", F.col("tag")))


def column_keys(columns):
    return _keys(
        columns, F.col("column"), ("columns", asset_path(*SCOPE)), ("taxonomy_types", F.col("data_type_id"))
    )


def collection_keys(collections, tables):
    members = collections.withColumnRenamed("member_table", "table")
    joined = reference_join(members, tables.select("database", "schema", "table"), ["table"], spread_by=["collection_id"])
    return _keys(joined, F.lit(None).cast("string"), ("collections", F.col("collection_id")))


def in_scope():
    """Databases and schemas restrict every target; absent means everywhere."""
    return (F.col("only_databases").isNull() | F.array_contains("only_databases", F.col("database"))) & (
        F.col("only_schemas").isNull() | F.array_contains("only_schemas", F.col("schema"))
    )


def meet(scope_keys, wanted, carry=()):
    """Scopes each policy reaches, with the source and reference that reached them."""
    joined = reference_join(scope_keys, wanted, ["kind", "value"], spread_by=SCOPE)
    source = lookup(F.col("kind"), SELECTORS)
    return joined.select(
        *POLICY_KEY, *carry, *SCOPE, source.alias("source"),
        F.when(source != "selector", F.col("value")).alias("ref"),
        in_scope().alias("in_scope"),
    )


def table_targets(policies, tables):
    return meet(table_keys(tables), selector_keys(policies, ["tables"]))


def column_targets(policies, columns):
    return meet(column_keys(columns), selector_keys(policies, ["columns"]))


def taxonomy_targets(policies, columns):
    return meet(column_keys(columns), selector_keys(policies, ["taxonomy_types"]))


def collection_targets(policies, collections, tables):
    return meet(collection_keys(collections, tables), selector_keys(policies, ["collections"]))


def tag_targets(policies, tables):
    return meet(tag_keys(tables), selector_keys(policies, ["tags"]))


def targets(policies, tables, columns, collections, carry=()):
    """Every scope a policy reaches: all selector kinds meet the catalog in one join; columns to ``carry`` come along."""
    parts = [table_keys(tables), tag_keys(tables), column_keys(columns), collection_keys(collections, tables)]
    keys = reduce(lambda a, b: a.unionByName(b), parts)
    return meet(keys, selector_keys(policies, carry=carry), carry).filter("in_scope").drop("in_scope")


# --- instructions ------------------------------------------------------------------


def source_rank(source):
    rank = F.lit(len(SOURCE_ORDER))
    for number, name in enumerate(SOURCE_ORDER):
        rank = F.when(source == name, F.lit(number)).otherwise(rank)
    return rank


def instructions(policies, tables, columns, collections, paths=True):
    """Served rules: one row per rule and scope, with the paths that led there (left out where ``paths`` is false).

    Masking keeps the column; any other family governs the whole table.
    """
    expanded = expand(policies)
    rule = F.col("rule")
    rules = expanded.select(
        *POLICY_KEY,
        F.when(F.col("rule.family") == "masking", "column").otherwise("table").alias("grain"),
        F.col("name").alias("policy"),
        rule,
        assigned_scenario(rule, F.col("scenario_map")).alias("scenario"),
        band(F.col("spec.priority")).alias("band"),
        weight(F.col("spec.priority")).alias("weight"),
        F.col("spec.enforcement_mode").alias("mode"),
        validity(F.col("spec.effective_from")).alias("effective_from"),
        validity(F.col("spec.effective_until")).alias("effective_until"),
    )
    masks = F.bool_or(F.col("spec.masking").isNotNull()).over(Window.partitionBy(*POLICY_KEY))
    reached = scopes(targets(policies.withColumn("masks", masks), tables, columns, collections, ["masks"]))
    # written once: the search for hot keys and the join read it, instead of resolving every selector twice
    reached = materialize(reached if paths else reached.drop("resolution_paths"), "reached")
    joined = reference_join(reached, rules, [*POLICY_KEY, "grain"], spread_by=SCOPE).drop("grain")
    joined = joined.withColumn("instruction_key", F.col("rule.instruction_key"))
    return joined.withColumn("primary_source", F.col("resolution_paths")[0]["source"]) if paths else joined


def scopes(reached):
    """Distinct scopes per policy, with the paths that led there: tables, and columns of a policy that ``masks``.

    Grouped before the rules join, so the shuffle carries keys and paths only; a
    group is as long as one policy's selector entries for one scope.
    """
    path = F.struct(source_rank(F.col("source")).alias("rank"), "source", "ref")
    grains = F.array(
        F.struct(F.lit("table").alias("grain"), F.lit(None).cast("string").alias("column")),
        F.when(F.col("masks"), F.struct(F.lit("column").alias("grain"), F.col("column").alias("column"))),
    )
    return (
        reached.withColumn("_g", F.explode(F.array_compact(grains)))
        .withColumns({"grain": F.col("_g.grain"), "column": F.col("_g.column")})
        .groupBy(*POLICY_KEY, "grain", *SCOPE)
        .agg(F.sort_array(F.collect_set(path)).alias("resolution_paths"))
    )


def flatten(resolved):
    """Resolved rules in the shape of the served instruction table."""
    return resolved.select(
        F.xxhash64(*POLICY_KEY, "instruction_key", *SCOPE).alias("rule_id"),
        "policy", "version", "rule.family", "rule.kind", "instruction_key", "scenario", *SCOPE,
        "rule.base_decision", F.col("band").cast("int").alias("band"), "weight", "mode",
        F.lit("none").alias("conflict_status"), "effective_from", "effective_until",
        *[F.col(f"rule.{name}") for name in PARAMETERS],
    )


# --- purpose vocabulary -------------------------------------------------------------


def use_entries(policies):
    """(policy, list, entry) occurrences; opposite uses of one entry stay apart."""
    def side(field, kind):
        return policies.select(
            "policy_id", "name", F.lit(kind).alias("list_kind"), F.explode(f"spec.{field}").alias("entry")
        )

    return side("permitted_uses", "permitted").unionByName(side("prohibited_uses", "prohibited"))


def known_families(entries):
    """Family tokens are the prefixes of dotted keys; no token holds a dot itself."""
    return (
        entries.filter(F.col("entry").contains("."))
        .select(F.split_part("entry", F.lit("."), F.lit(1)).alias("entry"))
        .distinct()
        .withColumn("is_family", F.lit(True))
    )


def normalise_entries(entries, dispositions, spread_by=("policy_id",)):
    """Authored entry to key, category or unmapped; a fenced entry stays unmapped."""
    spread = list(spread_by)
    joined = reference_join(
        entries, known_families(entries), ["entry"], "left", spread_by=spread, derived="families"
    )
    ruled = dispositions.withColumnRenamed("authored_entry", "entry")
    joined = reference_join(joined, ruled, ["entry"], "left", spread_by=spread)
    fenced = F.coalesce(F.col("do_not_map"), F.lit(False))
    resolved = F.when(fenced, None).when(F.col("entry").contains("."), F.col("entry")).otherwise(
        F.coalesce(F.when(F.col("is_family"), F.col("entry")), F.col("resolved_key"), F.col("resolved_category"))
    )
    return joined.withColumn("resolved", resolved).withColumn(
        "resolved_as",
        F.when(F.col("resolved").isNull(), "unmapped")
        .when(F.col("resolved").contains("."), "key")
        .otherwise("category"),
    )


def apply_vocabulary(rules, mapping):
    """Served uses with ruled entries replaced ({entry: key or category}, a short table).

    Run after conflict detection, which looks at entries as they were authored.
    """
    if not mapping:
        return rules
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return rules.withColumn("uses", F.transform("uses", lambda u: F.coalesce(F.try_element_at(table, u), u)))


def publish(policies, tables, columns, collections, mapping=None):
    """The served instruction table of one publication."""
    marked = mark_conflicts(flatten(instructions(policies, tables, columns, collections, paths=False)))
    return apply_vocabulary(marked, mapping).drop("conflict_group_id")


# --- conflicts ------------------------------------------------------------------------


def detect_conflicts(rules):
    """Rules whose unresolved use stands on a permitted and a prohibited list.

    Same scope, scenario and band. Members of a group share its id; the id is the
    cross reference, so no pair of opponents is ever written out.
    """
    key = [*SCOPE, "scenario", "band", "use"]
    uses = rules.filter(F.col("family") == "usage_guidance").select(
        "rule_id", "kind", *SCOPE, "scenario", "band", F.explode("uses").alias("use")
    ).filter(~F.col("use").contains("."))
    # a few narrow columns of the usage rules, written once: they are grouped, sampled and joined
    keyed = materialize(uses.withColumn("conflict_group_id", stable_id(*[F.col(k) for k in key])), "authored-uses")
    groups = (
        keyed.groupBy("conflict_group_id")
        .agg(
            F.count_if(F.col("kind") == "permitted").alias("n_permitted"),
            F.count_if(F.col("kind") == "prohibited").alias("n_prohibited"),
        )
        .filter("n_permitted > 0 AND n_prohibited > 0")
    )
    members = reference_join(
        keyed, groups, ["conflict_group_id"], spread_by=["rule_id"], derived="conflict-groups"
    )
    return members.select(
        "rule_id", "kind", *SCOPE, "use", "conflict_group_id",
        F.when(F.col("kind") == "permitted", F.col("n_prohibited")).otherwise(F.col("n_permitted")).alias("n_opponents"),
    )


def mark_conflicts(rules):
    """Rules with their conflict status set."""
    flagged = detect_conflicts(rules).groupBy("rule_id").agg(F.min("conflict_group_id").alias("conflict_group_id"))
    joined = reference_join(rules, flagged, ["rule_id"], "left", spread_by=["rule_id"], derived="flagged")
    return joined.withColumn(
        "conflict_status", F.when(F.col("conflict_group_id").isNotNull(), "conflicted").otherwise("none")
    )


# --- publications ---------------------------------------------------------------------


def snapshot(versions, publications):
    """Newest approved version of each policy per publication.

    ``publications`` is the short list [(id, published_at text)]; a version serves
    from the first publication after its approval.
    """
    served = F.array(
        *[
            F.struct(F.lit(pid).alias("publication_id"), F.lit(at).cast("timestamp_ntz").alias("at"))
            for pid, at in publications
        ]
    )
    latest = max(publications, key=lambda p: p[1])[0]
    exploded = versions.filter("approved").withColumn(
        "_pub", F.explode(F.filter(served, lambda p: p["at"] >= F.col("published_at")))
    )
    payload = F.struct(*[F.col(c) for c in versions.columns if c != "policy_id"])
    return (
        exploded.groupBy(F.col("_pub.publication_id").alias("publication_id"), "policy_id")
        .agg(F.max_by(payload, F.col("version")).alias("row"))
        .select("publication_id", "policy_id", "row.*")
        .withColumn("is_current", F.col("publication_id") == latest)
    )


def publication_diff(before, after, keys, compared):
    """Rows added, removed or changed between two snapshots; null-safe throughout."""
    left = before.select(*keys, F.struct(*compared).alias("before"))
    right = after.select(*keys, F.struct(*compared).alias("after"))
    joined = left.join(right, keys, "full_outer")
    return joined.withColumn(
        "change",
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .when(~F.col("before").eqNullSafe(F.col("after")), "changed"),
    ).filter("change IS NOT NULL")
