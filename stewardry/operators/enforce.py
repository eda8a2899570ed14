"""Apply what an answer projects to tables of any size."""

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from stewardry.functions import masks
from stewardry.functions.expr import in_force, lookup, role_is_listed, severity
from stewardry.functions.scale import fits, reference_join, salted_join
from stewardry.operators.decide import mask_decision


def mask_map(rules, asset, role, columns=(), at=None):
    """{column: method} of one table for a caller's role at an instant (now, where none is given).

    As in a decision the most severe method of a column wins; ties go to the higher
    band, then to the policy and the rule. A rule without a column covers ``columns``,
    those of the catalog. One row per column is collected, data rows never.
    """
    database, schema, table = asset.split(".")
    instant = (F.current_timestamp() if at is None else F.lit(at)).cast("timestamp_ntz")
    covered = F.when(F.col("column").isNull(), F.array(*[F.lit(c) for c in columns]).cast("array<string>")).otherwise(
        F.array("column")
    )
    strength = F.struct(severity(mask_decision(F.col("masking.method"))), -F.col("band"), "policy", "rule_id")
    rows = (
        rules.filter(
            (F.col("family") == "masking")
            & (F.col("database") == database)
            & (F.col("schema") == schema)
            & (F.col("table") == table)
            & in_force(F.col("effective_from"), F.col("effective_until"), instant)
            & ~role_is_listed(F.col("masking.exempt_roles"), F.lit(role))
        )
        .withColumn("covered", F.explode(covered))
        .groupBy("covered")
        .agg(F.min_by("masking.method", strength).alias("method"))
        .collect()
    )
    return {r["covered"]: r["method"] for r in rows}


def apply_masks(df, chosen, secret):
    """One projection with the native expression of each masked column."""
    return df.withColumns(
        {column: masks.mask(F.col(column), method, secret) for column, method in chosen.items() if column in df.columns}
    )


def apply_row_filter(df, entitlements, role, column="region"):
    """Rows of the regions the role is entitled to; a role without any sees none."""
    allowed = entitlements.filter(F.col("role") == role).select(F.col("region").alias(column)).distinct()
    if fits(allowed):
        return df.join(F.broadcast(allowed), column, "left_semi")
    return salted_join(df, allowed, [column], "left_semi")


def apply_access_window(df, time_column, anchor, lookback_days):
    """Rows in [anchor - N days, anchor]; literal bounds reach the file scan."""
    lower = F.lit(anchor - timedelta(days=lookback_days)).cast("timestamp_ntz")
    upper = F.lit(anchor).cast("timestamp_ntz")
    return df.filter((F.col(time_column) >= lower) & (F.col(time_column) <= upper))


def tag_access_windows(df, time_column, windows):
    """Rows with every purpose whose window [(purpose, anchor, days)] holds them."""
    held = F.array(
        *[
            F.when(
                F.col(time_column).between(
                    F.lit(anchor - timedelta(days=days)).cast("timestamp_ntz"), F.lit(anchor).cast("timestamp_ntz")
                ),
                F.lit(purpose),
            )
            for purpose, anchor, days in windows
        ]
    )
    return df.withColumn("purpose", F.explode(F.array_compact(held)))


def consent_bases(df, bases):
    """(row, purpose, granted) from one basis column per purpose."""
    pairs = F.array(
        *[
            F.struct(F.lit(purpose).alias("purpose"), F.coalesce(F.col(column) == "granted", F.lit(False)).alias("granted"))
            for purpose, column in bases.items()
        ]
    )
    return df.withColumn("_c", F.explode(pairs)).select(*df.columns, "_c.purpose", "_c.granted")


def apply_consent(df, bases, purpose):
    """Rows whose basis column records consent; a purpose without a basis sees none."""
    column = bases.get(purpose)
    return df.filter(F.col(column) == "granted") if column else df.filter(F.lit(False))


def consent_matrix(df, bases, segment):
    """Granted and refused per purpose and segment, with totals for each and all."""
    return consent_bases(df, bases).cube(segment, "purpose").agg(
        F.count_if("granted").alias("granted"), F.count_if(~F.col("granted")).alias("refused")
    )


def select_source(sources, by_purpose, purposes):
    """Rows of the source each purpose must use; other sources never answer it."""
    parts = [
        sources[by_purpose[p]].withColumn("purpose", F.lit(p)).withColumn("source", F.lit(by_purpose[p]))
        for p in purposes
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def reconcile(feeds, key, state):
    """One row per key over all feeds: agree, disagree, or missing somewhere.

    Keys are unique within a feed, so a union and one aggregate give what a chain of
    full outer joins would, with one shuffle instead of one per join.
    """
    tagged = [df.select(key, F.lit(name).alias("feed"), F.col(state).alias("state")) for name, df in feeds.items()]
    stacked = reduce(lambda a, b: a.unionByName(b), tagged)
    mine = {n: F.col("feed") == n for n in feeds}
    folded = stacked.groupBy(key).agg(
        *[F.max(F.when(mine[n], F.col("state"))).alias(f"{n}_state") for n in feeds],
        *[F.bool_or(mine[n]).alias(f"_has_{n}") for n in feeds],
    )
    states = F.array(*[F.col(f"{n}_state") for n in feeds])
    missing = F.array_compact(F.array(*[F.when(~F.col(f"_has_{n}"), F.lit(n)) for n in feeds]))
    return (
        folded.withColumn("missing", F.concat_ws(",", missing))
        .withColumn(
            "status",
            F.when(F.col("missing") != "", "missing")
            .when(F.size(F.array_distinct(states)) == 1, "agree")
            .otherwise("disagree"),
        )
        .drop(*[f"_has_{n}" for n in feeds])
    )


def role_views(df, views):
    """One table, one projection per role: {role: {column: expression}} over the same scan."""
    shapes = [
        F.struct(F.lit(role).alias("role"), *[expr.cast("string").alias(name) for name, expr in columns.items()])
        for role, columns in views.items()
    ]
    return df.select(F.explode(F.array(*shapes)).alias("v")).select("v.*")


def anonymize(df, drop, generalise, k):
    """Drop identifiers, coarsen quasi-identifiers, suppress groups smaller than ``k``.

    Group sizes come from a partial aggregate joined back, so a group with a large
    share of the rows never lands in one task.
    """
    coarse = df.drop(*drop).withColumns(generalise)
    # a struct is never null, so rows without a value form groups of their own
    coarse = coarse.withColumn("_group", F.struct(*generalise))
    sizes = coarse.groupBy("_group").count().filter(F.col("count") >= k).select("_group")
    return reference_join(coarse, sizes, ["_group"], "left_semi", derived="group-sizes").drop("_group")


def transfer_dispositions(exports, destinations, keys, derived=None):
    """Export rows as release, hold or reject by their destination's decision; a null key meets a null key."""
    keyed = exports.withColumn("_to", F.struct(*keys))
    decided = destinations.withColumn("_to", F.struct(*[F.col(k).cast(exports.schema[k].dataType) for k in keys])).drop(*keys)
    joined = reference_join(keyed, decided, ["_to"], "left", derived=derived).drop("_to")
    disposition = F.coalesce(
        lookup(F.col("decision"), {"allow": "release", "log_only": "release", "retain": "release", "deny": "reject"}),
        F.lit("hold"),
    )
    return joined.withColumn("disposition", disposition)


def write_dispositions(rows, path):
    rows.write.mode("overwrite").partitionBy("disposition").parquet(path)


def retention_due(df, trigger, years, as_of, action):
    """Rows whose trigger plus the period has passed.

    A year has at least 365 days, which gives the scan a plain bound on the trigger;
    the calendar test decides.
    """
    due = F.col(trigger) + F.make_interval(years=F.lit(years))
    newest = F.lit(as_of - timedelta(days=365 * years)).cast("timestamp_ntz")
    return df.filter(F.col(trigger) <= newest).withColumn("due_at", due).filter(F.col("due_at") <= F.lit(as_of).cast("timestamp_ntz")).withColumn(
        "action", F.lit(action)
    )


def ingestion_gate(documents, corpora, key="source", derived=None):
    """Documents of admitted corpora; ``corpora`` carries the decision per corpus."""
    gated = corpora.withColumn("gate", F.when(F.col("decision") == "allow", "INGEST").otherwise("SKIP"))
    return reference_join(documents, gated, [key], "left", spread_by=["doc_id"], derived=derived).withColumn(
        "gate", F.coalesce("gate", F.lit("SKIP"))
    )


def determine(applicants, categorical, income, threshold):
    """A categorical qualifier wins over the income test; the test still shows."""
    met = income <= threshold
    return applicants.withColumns(
        {
            "determination": F.when(categorical, "eligible").when(met, "eligible").otherwise("ineligible"),
            "basis": F.when(categorical, "categorical").otherwise("income"),
            "reasons": F.concat_ws(
                ",",
                F.array_compact(
                    F.array(
                        F.when(categorical, F.lit("categorical_qualifier")),
                        F.when(met, F.lit("income_test_met")).otherwise(F.lit("income_test_not_met")),
                    )
                ),
            ),
        }
    )
