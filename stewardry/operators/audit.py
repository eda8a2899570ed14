"""Evidence, explanations, discovery and coverage over decisions and served rules."""

from pyspark.sql import Window, functions as F

from stewardry import vocab
from stewardry.functions.expr import asset_path
from stewardry.functions.scale import reference_join, salted_join
from stewardry.operators import compose
from stewardry.session import materialize

TABLE = ["database", "schema", "table"]


def evidence_entries(answers):
    """One audit row per answer, citing its first-ranked rule."""
    first = F.get("instructions", F.lit(0))
    return answers.select(
        "request_id",
        asset_path("database", "schema", "table", "column").alias("asset"),
        "scenario", "state", "decision", "reason_code", "decision_id", "publication_id",
        first["policy"].alias("policy"),
        first["version"].alias("policy_version"),
        first["instruction_key"].alias("instruction_key"),
        first["rule_id"].alias("rule_id"),
        F.transform("conditions", lambda c: c["kind"]).alias("conditions"),
        F.transform("obligations", lambda o: F.concat(o["type"], F.lit(": "), o["target"])).alias("obligations"),
        F.greatest(F.coalesce(F.size("prohibitions"), F.lit(0)), F.lit(0)).alias("prohibitions"),
    )


def explain_current(entries, current_rules, limit=200_000):
    """Whether the cited row is still served; only answered entries are explained."""
    served = current_rules.select("rule_id", F.lit(True).alias("served")).distinct()
    joined = reference_join(entries, served, ["rule_id"], "left", spread_by=["request_id"], limit=limit)
    return joined.withColumn(
        "explanation_current",
        F.when((F.col("state") == "answered") & F.col("rule_id").isNotNull(), F.coalesce("served", F.lit(False))),
    ).drop("served")


RECEIPT_KINDS = ("decision", "authorization", "validation")


def explain_receipts(asked, receipts):
    """Resolve an id by its kind; a question must name exactly one kind."""
    named = F.array_compact(
        F.array(
            *[
                F.when(
                    F.trim(f"{k}_id") != "", F.struct(F.lit(k).alias("kind"), F.trim(f"{k}_id").alias("id"))
                )
                for k in RECEIPT_KINDS
            ]
        )
    )
    known = receipts.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_id").alias("id")) for k in RECEIPT_KINDS])).alias("r")
    ).select("r.kind", "r.id", F.lit(True).alias("known")).distinct()
    one = asked.withColumn("_n", F.size(named)).withColumn("_r", F.when(F.size(named) == 1, named[0]))
    keyed = one.withColumn("kind", F.col("_r.kind")).withColumn("id", F.col("_r.id"))
    return (
        salted_join(keyed, known, ["kind", "id"], "left", spread_by=["question_id"])
        .withColumn(
            "outcome",
            F.when(F.col("_n") != 1, "invalid_question").when(F.col("known"), "explained").otherwise("unknown_id"),
        )
        .drop("_n", "_r", "known")
    )


def packet(entries, order="request_id"):
    """Totals of an evidence packet; the first publication in order names it."""
    return entries.agg(
        F.count("*").alias("total"),
        F.count("explanation_current").alias("explained"),
        F.count_if("explanation_current").alias("current"),
        F.count_if(F.col("state") != "answered").alias("honest_corners"),
        F.min_by("publication_id", order).alias("publication_id"),
    )


def honest_corners(entries):
    return entries.filter("state != 'answered'")


def cited_policy_usage(answers):
    """Citations and denials per policy and version, with totals."""
    cited = answers.select(F.explode("instructions").alias("c"))
    return cited.rollup(F.col("c.policy").alias("policy"), F.col("c.version").alias("version")).agg(
        F.count("*").alias("citations"), F.count_if(F.col("c.decision") == "deny").alias("denials")
    )


def discover(rules, database=None, schema=None):
    """Rule count and scenario keys per scope; the key set is a closed vocabulary."""
    kept = rules
    if database:
        kept = kept.filter(F.col("database") == database)
    if schema:
        kept = kept.filter(F.col("schema") == schema)
    return kept.groupBy(*TABLE, "column").agg(
        F.count("*").alias("instruction_count"), F.sort_array(F.collect_set("scenario")).alias("scenario_keys")
    )


def rulebook(rules, database, schema, table=None, scenario=None):
    """Current rules of an asset including its columns."""
    kept = rules.filter((F.col("database") == database) & (F.col("schema") == schema))
    if table:
        kept = kept.filter(F.col("table") == table)
    return kept.filter(F.col("scenario") == scenario) if scenario else kept


def meaning(columns, rules):
    """Type, classification and masking of each column; the strongest band names the mask."""
    chosen = (
        rules.filter("family = 'masking' AND column IS NOT NULL")
        .groupBy(*TABLE, "column")
        .agg(F.min_by("masking.method", F.struct(-F.col("band"), F.col("policy"), F.col("rule_id"))).alias("mask_method"))
    )
    return columns.join(chosen, [*TABLE, "column"], "left")


def decision_context(facts, rules):
    """Asset facts beside its rules per family; families are few, so the map is short."""
    per_family = rules.groupBy(*TABLE, "family").agg(F.count("*").alias("n"))
    gathered = per_family.groupBy(*TABLE).agg(
        F.sum("n").alias("n_rules"), F.sort_array(F.collect_list(F.struct("family", "n"))).alias("families")
    )
    return facts.join(gathered, TABLE, "left").withColumn("n_rules", F.coalesce("n_rules", F.lit(0)))


def baseline_requests(tables, instant, scenario="purpose.allowed_use"):
    """The baseline question asked of every table, no purpose declared."""
    none, at = F.lit(None).cast("string"), F.lit(instant).cast("timestamp_ntz")
    return tables.select(
        F.xxhash64(*TABLE).alias("request_id"), at.alias("requested_at"), none.alias("role"), *TABLE,
        none.alias("column"), F.lit(scenario).alias("scenario"), none.alias("purpose"), none.alias("operation"),
        none.alias("dest_system"), none.alias("dest_jurisdiction"), none.alias("consumer_jurisdiction"),
        F.lit(None).cast("timestamp_ntz").alias("as_of"),
    )


def baseline(tables, rules, instant):
    return compose.decide_in_place(baseline_requests(tables, instant), rules).select(
        *TABLE, "state", "decision", "reason_code"
    )


def coverage_delta(before, after):
    joined = before.select(*TABLE, F.col("state").alias("before_state")).join(
        after.select(*TABLE, F.col("state").alias("after_state")), TABLE, "full_outer"
    )
    return joined.filter(~F.col("before_state").eqNullSafe(F.col("after_state")))


def ungoverned(tables, rules):
    """Cataloged tables with no rule at all, and thin ones only context rules reach."""
    reached = rules.groupBy(*TABLE).agg(
        F.bool_and(F.col("family").isin(*vocab.CONTEXT_FAMILIES)).alias("thin")
    )
    return (
        tables.select(*TABLE)
        .join(reached, TABLE, "left")
        .withColumn("status", F.when(F.col("thin").isNull(), "ungoverned").when(F.col("thin"), "thin"))
        .filter("status IS NOT NULL")
        .drop("thin")
    )


def decision_trend(answers, span=7):
    """Decisions per day and scenario, share of denials, moving average over days.

    The window runs over daily aggregates, never over requests.
    """
    daily = answers.groupBy(F.to_date("requested_at").alias("day"), "scenario").agg(
        F.count("*").alias("n"), F.count_if(F.col("decision") == "deny").alias("denied")
    )
    days = Window.partitionBy("scenario").orderBy("day").rowsBetween(-(span - 1), 0)
    return daily.withColumn("deny_share", F.col("denied") / F.col("n")).withColumn(
        "moving_denied", F.avg("denied").over(days)
    )


def decision_calendar(answers, span=7):
    """Decisions per scenario and calendar day, days without requests included, with the mean over the last ``span`` days.

    Every (scenario, decision) seen has a row for each day from the first of the log to the last; before the first
    day nothing counts, so early means are over the days there are. An answer without a decision counts as ``none``.
    Only daily aggregates meet the calendar, which is as long as the log has days.
    """
    daily = materialize(
        answers.groupBy("scenario", F.coalesce("decision", F.lit("none")).alias("decision"), F.to_date("requested_at").alias("day"))
        .agg(F.count("*").alias("n"))
        .where("day is not null"),
        "daily-decisions",
    )
    first, last = daily.agg(F.min("day"), F.max("day")).first()
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    every = daily.select("scenario", "decision").distinct().withColumn("day", days)
    # zeros beside the counts and one more aggregate, so that a null scenario meets itself
    dense = daily.unionByName(every.withColumn("n", F.lit(0).cast("long")))
    dense = dense.groupBy("scenario", "decision", "day").agg(F.sum("n").alias("n"))
    recent = Window.partitionBy("scenario", "decision").orderBy("day").rowsBetween(-(span - 1), 0)
    of_day = Window.partitionBy("scenario", "day")
    total = F.sum("n").over(of_day)
    return dense.withColumn("share", F.when(total > 0, F.col("n") / total)).withColumn("moving_n", F.avg("n").over(recent))


# Registers of a sketch as a power of two; the relative standard error of its estimate.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def actor_sketches(requests, at="requested_at", actor="actor"):
    """One mergeable sketch of the distinct actors per asset and day, a few kilobytes whatever they count."""
    day = F.to_date(at).alias("day")
    return requests.groupBy(*TABLE, day).agg(F.hll_sketch_agg(F.col(actor).cast("string"), F.lit(SKETCH_BITS)).alias("actors_sketch"))


def united_actors(sketches, by=tuple(TABLE)):
    """Estimated distinct actors per ``by`` from the sketches of its days; no actor is read again."""
    united = sketches.groupBy(*by).agg(F.hll_union_agg("actors_sketch").alias("s"), F.count("*").alias("n_days"))
    return united.select(*by, "n_days", F.hll_sketch_estimate("s").alias("actors"))


def actor_counts(requests):
    return united_actors(actor_sketches(requests))
