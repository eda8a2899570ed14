"""Small column expressions shared by the operators."""

from pyspark.sql import functions as F

from stewardry import vocab


def severity(decision):
    """Severity rank of a decision, 1 = most severe; NULL for NULL."""
    rank = F.lit(None).cast("int")
    for name, value in vocab.SEVERITY.items():
        rank = F.when(decision == name, F.lit(value)).otherwise(rank)
    return rank


def decision_of(rank):
    """Inverse of :func:`severity`."""
    name = F.lit(None).cast("string")
    for label, value in vocab.SEVERITY.items():
        name = F.when(rank == value, F.lit(label)).otherwise(name)
    return name


def lookup(column, mapping, default=None):
    out = F.lit(default).cast("string")
    for key, value in mapping.items():
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def asset_path(*parts):
    return F.concat_ws(".", *parts)


def purpose_category(purpose):
    return F.split_part(purpose, F.lit("."), F.lit(1))


def in_force(effective_from, effective_until, instant):
    """Half-open validity: from <= instant < until, NULL unbounded."""
    return (effective_from.isNull() | (effective_from <= instant)) & (
        effective_until.isNull() | (instant < effective_until)
    )


def role_is_listed(roles, role):
    return F.coalesce(F.array_contains(roles, role), F.lit(False))


def first_seen(values):
    """Distinct values in order of first appearance, blanks dropped."""
    return F.filter(F.array_distinct(values), lambda v: v.isNotNull() & (F.trim(v) != ""))


def stable_id(*parts):
    """Deterministic id: a retried task mints the same value, other parts another one."""
    return F.sha2(F.concat(*[framed(p) for p in parts]), 256)


def framed(part):
    """Text behind its length, a dash for NULL: joined parts can be told apart whatever they hold."""
    text = part.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
