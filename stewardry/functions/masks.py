"""Masking projections as native column expressions."""

from pyspark.sql import functions as F

# The patterns below are the whole redaction vocabulary, in order.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
CARD = r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"
NATIONAL_ID = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
PHONE = r"[+]?[0-9]{0,3} ?[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}"
REDACTIONS = (
    ("email", EMAIL),
    ("card", CARD),
    ("national_id", NATIONAL_ID),
    ("phone", PHONE),
)


def _may_hold(label, column):
    """A cheap test every text with a hit passes, so most texts skip the pattern."""
    return column.contains("@") if label == "email" else column.rlike("[0-9]{3}")


def partial(column):
    """First character and the domain of an e-mail; first character otherwise."""
    text = column.cast("string")
    first = F.substring(text, 1, 1)
    return F.when(
        text.contains("@"), F.concat(first, F.lit("***@"), F.substring_index(text, "@", -1))
    ).otherwise(F.concat(first, F.lit("***")))


def full(column):
    return F.when(column.isNotNull(), F.lit("****"))


def hashed(column, salt):
    return F.sha2(F.concat(F.lit(salt), column.cast("string")), 256)


def tokenize(column, key):
    """Stable token: equal values join across tables, NULL stays NULL."""
    return F.concat(
        F.lit("tok_"), F.substring(F.sha2(F.concat(F.lit(key), F.lit("|"), column.cast("string")), 256), 1, 32)
    )


def _without(label, pattern, column):
    return F.when(_may_hold(label, column), F.regexp_replace(column, pattern, f"[{label}]")).otherwise(column)


def redact(column):
    for label, pattern in REDACTIONS:
        column = _without(label, pattern, column)
    return column


def redact_counted(df, column):
    """Redact a text column and count the hits per pattern (``n_<label>``).

    Each pattern sees the text the earlier ones left behind, once.
    """
    for label, pattern in REDACTIONS:
        text = F.col(column)
        hits = F.when(_may_hold(label, text), F.regexp_count(text, F.lit(pattern))).otherwise(0)
        df = df.withColumns({f"n_{label}": hits, column: _without(label, pattern, text)})
    return df


def mask(column, method, secret):
    """The projection a served masking rule names; unknown methods hide all."""
    return {
        "partial": lambda: partial(column),
        "full": lambda: full(column),
        "redact": lambda: redact(column),
        "hash": lambda: hashed(column, secret),
        "tokenize": lambda: tokenize(column, secret),
    }.get(method, lambda: full(column))()
