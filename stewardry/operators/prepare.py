"""Request preparation: identity, routing, scenario, instant and purpose."""

from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.expr import purpose_category, stable_id
from stewardry.functions.scale import fits, salted_join

# Fixed key order of the request identity.
SIGNATURE_FIELDS = (
    "as_of",
    "column",
    "consumer_jurisdiction",
    "database",
    "dest_jurisdiction",
    "dest_system",
    "operation",
    "purpose",
    "scenario",
    "schema",
    "table",
)


def signature(tool, role="role", fields=SIGNATURE_FIELDS):
    """Identity of a call: strings trimmed, keys in one order, tool and role added.

    Every part stands behind its length, so no value can pass for another field.
    """
    named = [F.trim(F.col(f"`{name}`").cast("string")) for name in (*fields, role)]
    return stable_id(F.lit(tool), *named)


def with_signature(requests, tool="authorize"):
    return requests.withColumn("signature", signature(tool))


def match_cases(requests, cases, spread_by="request_id"):
    """Route each request to the case with the same whole signature; no fallback."""
    known = cases.select("signature", "case_id")
    if fits(known):
        return requests.join(F.broadcast(known), "signature")
    return salted_join(requests, known, ["signature"], spread_by=[spread_by])


def unmatched(requests, cases, spread_by="request_id"):
    known = cases.select("signature").distinct()
    if fits(known):
        return requests.join(F.broadcast(known), "signature", "left_anti")
    return salted_join(requests, known, ["signature"], "left_anti", spread_by=[spread_by])


def scenario_from_text(requests, keywords, text="use_text"):
    """Map free text over a user-supplied keyword table (a small dict).

    Exactly one distinct scenario resolves; none or several stay unresolved.
    """
    lowered = F.lower(F.col(text))
    hits = F.array(
        *[F.when(lowered.contains(word.lower()), F.lit(key)) for word, key in keywords.items()]
    )
    found = F.array_distinct(F.array_compact(hits))
    return (
        requests.withColumn("_found", found)
        .withColumn("resolved_scenario", F.when(F.size("_found") == 1, F.col("_found")[0]))
        .withColumn(
            "reason_code", F.when(F.size("_found") != 1, F.lit(vocab.REASON_SCENARIO))
        )
        .drop("_found")
    )


def evaluation_instant(as_of="as_of", requested_at="requested_at"):
    return F.coalesce(F.col(as_of), F.col(requested_at))


def prepared(requests):
    """Columns every evaluation needs beside the raw request."""
    return requests.withColumn("instant", evaluation_instant()).withColumn(
        "purpose_category", purpose_category(F.col("purpose"))
    )


def publication_at(instant, publications):
    """Publication current at an instant; ``publications`` is the short list [(id, published_at text)]."""
    ordered = sorted(publications, key=lambda p: p[1])
    current = F.lit(None).cast("string")
    for publication_id, published_at in ordered:
        current = F.when(instant >= F.lit(published_at).cast("timestamp_ntz"), F.lit(publication_id)).otherwise(current)
    return current


def declared_state(meta, key="purpose_key"):
    """Three states of an annotation map: declared value, declared blind, undeclared."""
    has = F.coalesce(F.map_contains_key(meta, key), F.lit(False))
    return (
        F.when(~has, "undeclared").when(meta[key].isNull(), "declared_blind").otherwise("declared")
    )


def receipts(publication, sig, instant):
    """Deterministic decision, authorization and validation ids, of the instant to the microsecond."""
    at = F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return {
        f"{kind}_id": stable_id(F.lit(kind), publication, sig, at)
        for kind in ("decision", "authorization", "validation")
    }
