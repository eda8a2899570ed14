"""What a publication changes: fingerprints of scopes, and the requests whose answer flips."""

from pyspark.sql import functions as F

from stewardry.functions.scale import reference_join
from stewardry.operators import compose
from stewardry.operators.decide import SCOPE

ANSWER = ("state", "decision", "reason_code")


def _keyed(df):
    return df.withColumn("column_key", F.coalesce(F.col("column"), F.lit("")))


def scope_fingerprints(rules):
    """(scope, n_rules, fingerprint): the sum of the rules' hashes, whatever their order; equal rules count as often as they stand."""
    body = sorted(c for c in rules.columns if c not in SCOPE)
    # the places of a row's nulls are hashed beside its fields, so that a null cannot pass for its neighbour
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in body])
    h = F.xxhash64(nulls, *body).cast("decimal(38,0)")
    return _keyed(rules).groupBy(*SCOPE).agg(F.count("*").alias("n_rules"), F.sum(h).alias("fingerprint"))


def changed_scopes(before, after):
    """Scopes whose set of rules differs between two publications: added, removed or changed. One shuffle of two aggregates."""
    sides = scope_fingerprints(before).withColumn("side", F.lit(0)).unionByName(scope_fingerprints(after).withColumn("side", F.lit(1)))
    side = lambda n: F.max(F.when(F.col("side") == n, F.struct("n_rules", "fingerprint")))
    both = sides.groupBy(*SCOPE).agg(side(0).alias("old"), side(1).alias("new"))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return both.select(*SCOPE, change.alias("change")).where("change is not null")


def publication_flips(requests, before, after):
    """Requests whose answer differs between two publications, with both answers.

    Only requests of changed scopes are decided, twice; all others have the same rules and so the same answer.
    ``before`` and ``after`` are the served rules of each publication.
    """
    scopes = changed_scopes(before, after)
    asked = reference_join(_keyed(requests), scopes, SCOPE, "inner", spread_by=["request_id"], derived="changed-scopes")
    asked = asked.drop("column_key").withColumnRenamed("change", "scope_change")
    first = compose.decide_in_place(asked, before)
    first = first.withColumnsRenamed({c: f"before_{c}" for c in ("n_rules", "n_live", *ANSWER)})
    both = compose.decide_in_place(first, after).withColumnsRenamed({c: f"after_{c}" for c in ("n_rules", "n_live", *ANSWER)})
    old, new = (F.struct(*[F.col(f"{side}_{c}") for c in ANSWER]) for side in ("before", "after"))
    return both.where(~old.eqNullSafe(new))
