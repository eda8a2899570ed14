"""Inventory, parity, drift, identity and session checks."""

from functools import reduce

from pyspark.sql import Window, functions as F

from stewardry.functions.scale import reference_join, salted_join
from stewardry.operators.resolve import known_families
from stewardry.session import materialize

UUID = r"\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b"
NON_PERMISSIVE = ("deny", "require_review")


# --- purpose inventory ---------------------------------------------------------------


def served_uses(answers, rules):
    """(entry, case) rows, read only from the structured uses of cited usage rules."""
    cited = answers.select("case_id", F.explode("instructions").alias("c")).filter("c.family = 'usage_guidance'").select(
        "case_id", "c.rule_id"
    )
    uses = rules.filter("uses IS NOT NULL").select("rule_id", "uses")
    return (
        reference_join(cited, uses, ["rule_id"], spread_by=["case_id", "rule_id"])
        .select("case_id", F.explode("uses").alias("entry"))
        .distinct()
    )


def classify_entry(ruled_kind, is_family, fenced):
    """Ruling first, then the dot rule, the family token, the fence."""
    return (
        F.when(ruled_kind.isNotNull(), ruled_kind)
        .when(F.col("entry").contains("."), "registry_key")
        .when(is_family, "registry_category")
        .when(fenced, "do_not_map")
        .otherwise("legacy_unmapped")
    )


def use_inventory(occurrences, served, dispositions):
    """Every entry authored or served, with its classification and counts."""
    authored = occurrences.groupBy("entry").agg(
        F.count("*").alias("n_occurrences"),
        F.sort_array(F.collect_set("list_kind")).alias("list_kinds"),
    )
    in_cases = served.groupBy("entry").agg(F.count("*").alias("n_cases"))
    entries = authored.join(in_cases, "entry", "full_outer")
    ruled = dispositions.withColumnRenamed("authored_entry", "entry")
    joined = reference_join(entries, known_families(entries), ["entry"], "left", derived="families")
    joined = reference_join(joined, ruled, ["entry"], "left")
    family = F.coalesce(F.col("is_family"), F.lit(False))
    return joined.select(
        "entry",
        classify_entry(F.col("ruled_kind"), family, F.coalesce("do_not_map", F.lit(False))).alias("classification"),
        F.coalesce("n_occurrences", F.lit(0)).alias("n_occurrences"),
        F.coalesce("list_kinds", F.array().cast("array<string>")).alias("list_kinds"),
        F.coalesce("n_cases", F.lit(0)).alias("n_cases"),
        F.when(family, F.concat("entry", F.lit(".*"))).alias("matches"),
        "resolved_key", "resolved_category",
        F.col("n_occurrences").isNotNull().alias("in_pack"),
    )


def inventory_totals(inventory):
    """Entries, authored occurrences and (entry, case) pairs per classification, and of all (a null classification)."""
    return inventory.rollup("classification").agg(
        F.count("*").alias("n_entries"),
        F.count_if("in_pack").alias("n_authored"),
        F.sum("n_occurrences").cast("long").alias("n_occurrences"),
        F.sum("n_cases").cast("long").alias("n_pairs"),
        F.count_if(F.col("n_cases") == 0).alias("n_never_served"),
    )


DISPOSED = ("registry_category", "normalized_key", "deliberate_conflict")


def disposition_split(entries, dispositions):
    """Fenced entries must stay unmapped; ruled ones are mapped; the rest may become mapped."""
    ruled = dispositions.withColumnRenamed("authored_entry", "entry")
    joined = reference_join(entries.select("entry").distinct(), ruled, ["entry"])
    return joined.withColumn(
        "bucket",
        F.when(F.col("do_not_map"), "must_remain_unmapped")
        .when(F.col("resolved_key").isNotNull() | F.coalesce(F.col("ruled_kind").isin(*DISPOSED), F.lit(False)), "mapped")
        .otherwise("may_become_mapped"),
    )


def unaccounted_uses(served, dispositions):
    ruled = dispositions.select(F.col("authored_entry").alias("entry"))
    return reference_join(served.select("entry").distinct(), ruled, ["entry"], "left_anti")


def purpose_manifest(cases):
    """What each case declares and what the answer cites."""
    families = F.transform("instructions", lambda i: i["family"])
    return cases.select(
        "case_id",
        F.when(F.col("purpose").isNotNull(), "purposeful")
        .when(F.col("case_id").contains("purpose-inexpressible"), "inexpressible")
        .when(F.col("case_id").contains("purpose-missing"), "purpose_missing_control")
        .otherwise("purpose_blind")
        .alias("kind"),
        "state", "decision", "reason_code",
        F.array_sort(F.array_distinct(families)).alias("families"),
        F.size(F.filter(families, lambda f: f == "usage_guidance")).alias("n_usage_cited"),
    )


# --- parity ---------------------------------------------------------------------------


def expected_vs_actual(expected, actual, key, fields):
    """Field-wise differences; a side that is absent is itself a difference."""
    left = expected.select(key, F.struct(*fields).alias("expected"))
    right = actual.select(key, F.struct(*fields).alias("actual"))
    joined = left.join(right, key, "full_outer")
    deltas = F.array_compact(
        F.array(*[F.when(~F.col(f"expected.{f}").eqNullSafe(F.col(f"actual.{f}")), F.lit(f)) for f in fields])
    )
    return joined.withColumn(
        "deltas",
        F.when(F.col("expected").isNull(), F.array(F.lit("unexpected_case")))
        .when(F.col("actual").isNull(), F.array(F.lit("missing_answer")))
        .otherwise(deltas),
    )


def bites(state, decision):
    """A prohibition still bites unless the answer is permissive."""
    return ~((state == "answered") & ~F.coalesce(decision.isin(*NON_PERMISSIVE), F.lit(False)))


def parity_counters(checked):
    """Counters kept apart: a delegated check is no skip, a skip is no pass."""
    return checked.agg(
        F.count_if(F.col("delegated")).alias("delegated"),
        F.count_if(~F.col("delegated") & F.col("quarantined")).alias("skipped"),
        F.count_if(~F.col("delegated") & ~F.col("quarantined") & (F.size("deltas") == 0)).alias("passed"),
        F.count_if(~F.col("delegated") & ~F.col("quarantined") & (F.size("deltas") > 0)).alias("failed"),
    )


def red_team(cases):
    """Pass rate per attack; failing cases stay listed by ``failures``."""
    ok = F.col("got").eqNullSafe(F.col("expect"))
    return cases.groupBy("attack").agg(
        F.count("*").alias("n_cases"), F.count_if(ok).alias("n_held"), F.avg(ok.cast("double")).alias("held_rate")
    )


def failures(cases):
    return cases.filter(~F.col("got").eqNullSafe(F.col("expect")))


def tripwire(accepted, actual):
    """Both directions of a set difference; empty when the sets agree."""
    return actual.exceptAll(accepted).withColumn("change", F.lit("added")).unionByName(
        accepted.exceptAll(actual).withColumn("change", F.lit("removed"))
    )


def classification_drift(pinned, current, keys):
    left = pinned.select(*keys, F.col("data_type_id").alias("pinned_type"))
    right = current.select(*keys, F.col("data_type_id").alias("current_type"))
    return left.join(right, keys).filter(~F.col("pinned_type").eqNullSafe(F.col("current_type")))


def preflight(required, served, intended):
    """Required tables nobody serves, and intentionally ungoverned tables that are served."""
    missing = required.subtract(served).subtract(intended)
    surprising = intended.intersect(served)
    return missing.withColumn("issue", F.lit("missing")).unionByName(
        surprising.withColumn("issue", F.lit("unexpectedly_governed"))
    )


def recording_completeness(cases, recordings, required):
    """Cases without a recording, recordings without a case, required fields left empty."""
    joined = cases.select("case_id", F.lit(True).alias("known")).join(
        recordings.withColumn("recorded", F.lit(True)), "case_id", "full_outer"
    )
    empty = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required]))
    return joined.withColumn(
        "issue",
        F.when(F.col("recorded").isNull(), "missing_recording")
        .when(F.col("known").isNull(), "orphan_recording")
        .when(F.size(empty) > 0, F.concat(F.lit("empty:"), F.concat_ws(",", empty))),
    ).filter("issue IS NOT NULL").select("case_id", "issue")


def signature_collisions(cases):
    """Signatures more than one case carries; only the first of them can answer."""
    return cases.groupBy("signature").agg(
        F.count("*").alias("n_cases"), F.min("case_id").alias("first_case"), F.max("case_id").alias("last_case")
    ).filter("n_cases > 1")


# --- identity -----------------------------------------------------------------------------


def global_rank(df, order, label="ranked"):
    """1-based rank in a total order without a single-task window.

    Rows are range-partitioned and written, so partition numbers hold on a rerun;
    ranks inside a partition are shifted by the sizes of the ones before it.
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    pinned = materialize(parts, label)
    inside = Window.partitionBy("_part").orderBy(*order)
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = pinned.withColumn("_row", F.row_number().over(inside))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn("rank", F.col("_row") + F.col("_offset"))
        .drop("_part", "_row", "_offset")
    )


def canonicalise_ids(texts, key, text, prefix="00000000-0000-4000-8000-"):
    """Replace ids by canonical ones numbered in order of first appearance."""
    found = texts.select(
        key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(f"({UUID})"))).alias("pos", "id")
    )
    firsts = found.groupBy("id").agg(F.min(F.struct(key, "pos")).alias("at")).select("id", "at.*")
    ranked = global_rank(firsts, [key, "pos"], "first-ids").select(
        "id", F.concat(F.lit(prefix), F.lpad(F.col("rank").cast("string"), 12, "0")).alias("canonical")
    )
    named = reference_join(found, ranked, ["id"], spread_by=[key, "pos"])
    swaps = named.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "canonical"))), lambda x: x["canonical"]).alias("_ids")
    )
    joined = texts.join(swaps, key, "left")
    pieces = F.split(F.col(text), UUID)
    woven = F.zip_with(pieces, F.col("_ids"), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return joined.withColumn(text, F.when(F.col("_ids").isNull(), F.col(text)).otherwise(F.array_join(woven, ""))).drop("_ids")


def pin_windows(windows, pinned):
    """Rolling windows move anchor and lower bound together; as-of windows stay."""
    at = F.lit(pinned).cast("timestamp_ntz")
    rolling = F.col("window_type") == "rolling"
    return windows.withColumn("anchor_at", F.when(rolling, at).otherwise(F.col("anchor_at"))).withColumn(
        "lower_bound_at",
        F.when(rolling, at - F.make_dt_interval(F.col("lookback_days"))).otherwise(F.col("lower_bound_at")),
    )


def resolve_chained(asked, recorded, fields, ref="ref"):
    """'@case.field' to that field of the earlier answer; what does not resolve is named. The last dot parts the two."""
    text = F.col(ref)
    after = F.instr(F.reverse(text), ".")
    case = F.when(after > 0, F.substr(text, F.lit(2), F.length(text) - after - 1)).otherwise(F.substr(text, F.lit(2)))
    field = F.when(after > 0, F.substring_index(text, ".", -1)).otherwise("")
    keyed = asked.withColumn("case_id", case).withColumn("field", field)
    values = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    answers = recorded.select("case_id", values.alias("_values"))
    joined = salted_join(keyed, answers, ["case_id"], "left", spread_by=["request_id"])
    return (
        joined.withColumn("resolved", F.try_element_at("_values", F.col("field")))
        .withColumn(
            "problem",
            F.when(F.col("_values").isNull(), "unknown_case").when(F.col("resolved").isNull(), "unresolved_field"),
        )
        .drop("_values")
    )


def resolve_references(nodes, key="ref", target="target", value="value"):
    """(key, resolved, steps, problem) of nodes that hold a value or name another node, however long the chain.

    Pointers jump, twice as far every round, and only those that have not met their end go on. Nodes on the way to an
    end stand at every distance from it, so after the first round in which none arrives all others go round: 'cycle'.
    A name that no node has is 'unknown'. A key that stands twice keeps the least (target, value). Null keys are left out.
    """
    once = nodes.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    once = once.agg(F.min(F.struct(F.col(target).alias("target"), F.col(value).alias("value"))).alias("n"))
    once = materialize(once.select("key", "n.target", "n.value"), "refs")
    known = once.select(F.col("key").alias("target"), F.lit(True).alias("known"))
    starts = once.join(known, "target", "left")
    lost = F.col("target").isNotNull() & F.col("known").isNull()
    ends = F.col("target").isNull() | lost
    starts = materialize(
        starts.select("key", F.when(ends, F.col("key")).otherwise(F.col("target")).alias("at"), (~ends).cast("long").alias("steps"), lost.alias("lost"), "value", ends.alias("ends")),
        "refs-starts",
    )
    # pointers that have met their end, and those of the last round, some of which just did
    there, latest = [], starts.select("key", "at", "steps", F.col("ends").alias("there"))
    while True:
        known = reduce(lambda a, b: a.unionByName(b), there, latest)
        further = known.select(F.col("key").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"), "there")
        # both sides are read as written, so that the skew join can split a popular end
        jumps = latest.where("not there").drop("there").join(further, "at")
        jumps = jumps.select("key", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), "there")
        there.append(latest.where("there"))
        latest = materialize(jumps, "refs-jumps")
        if not latest.where("there").limit(1).collect():
            break
    terminal = starts.where("ends").select(F.col("key").alias("at"), "lost", "value")
    ended = reduce(lambda a, b: a.unionByName(b), there).join(terminal, "at").select(
        "key", F.when(~F.col("lost"), F.col("value")).alias("resolved"), "steps", F.when(F.col("lost"), "unknown").alias("problem")
    )
    none = [F.lit(None).cast(ended.schema[c].dataType).alias(c) for c in ("resolved", "steps")]
    return ended.unionByName(latest.select("key", *none, F.lit("cycle").alias("problem")))


# --- sessions ------------------------------------------------------------------------------


def sequence_check(calls, session, order, label, expected):
    """Sessions whose ordered calls equal the expected sequence.

    Only the first ``len(expected)`` calls of a session are ever ordered (a ranked
    limit that Spark applies before the shuffle); longer sessions fail by count.
    """
    size = len(expected)
    want = F.array(*[F.lit(x) for x in expected])
    rank = F.row_number().over(Window.partitionBy(*session).orderBy(*order))
    heads = calls.select(*session, *order, label).withColumn("_pos", rank).filter(F.col("_pos") <= size)
    matched = heads.groupBy(*session).agg(F.count_if(F.col(label) == want[F.col("_pos") - 1]).alias("n_matched"))
    counted = calls.groupBy(*session).agg(F.count("*").alias("n_calls"))
    return counted.join(matched, session).withColumn(
        "holds", (F.col("n_calls") == size) & (F.col("n_matched") == size)
    )


def session_outcomes(calls, session, at, budget=1):
    """Revisions, final dashboard state and reroutes per session, by plain aggregates.

    ``tool`` is validate or authorize, ``label`` its verdict or decision.
    """
    validation, label = F.col("tool") == "validate", F.col("label")
    warn = validation & (label == "warn")
    summed = calls.groupBy(*session).agg(
        F.count("*").alias("n_calls"),
        F.count_if(warn).alias("n_warned"),
        F.max_by(F.when(validation, label), F.when(validation, F.struct(*at))).alias("last_verdict"),
        F.min(F.when(~validation & (label == "deny"), F.struct(*at))).alias("_denied"),
        F.max(F.when(~validation & (label == "allow"), F.struct(*at))).alias("_allowed"),
    )
    return summed.select(
        *session, "n_calls",
        F.least("n_warned", F.lit(budget)).alias("revisions"),
        F.when((F.col("n_warned") > budget) | (F.col("last_verdict") == "fail"), "aborted")
        .when(F.col("last_verdict") == "pass", "validated")
        .when(F.col("last_verdict").isNotNull(), "open")
        .alias("dashboard"),
        F.coalesce(F.col("_denied") < F.col("_allowed"), F.lit(False)).alias("rerouted"),
    )
