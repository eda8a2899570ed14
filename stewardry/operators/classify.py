"""Column classification by name, by value, by hand; rollup to the table."""

from pyspark.sql import functions as F

from stewardry import vocab

# Name patterns in order of preference, with their data type,
# sensitivity and whether the type is personal data.
NAME_PATTERNS = (
    ("(^|_)e?mail($|_)", "pii.contact.email", "confidential", True),
    ("(^|_)(phone|mobile)($|_)", "pii.contact.phone", "confidential", True),
    ("(^|_)name($|_)", "pii.name", "confidential", True),
    ("(^|_)(amount|price|arr|salary)($|_)", "financial.amount", "restricted", False),
    ("(^|_)region($|_)", "custom.sales_region", "internal", False),
    ("(^|_)(notes|text|comment)($|_)", "custom.free_text", "confidential", True),
    ("(^|_)id$|^id$", "id.surrogate", "internal", False),
)
SOURCE_RANK = {"manual": 0, "value": 1, "pattern": 2}


def by_name(columns, patterns=NAME_PATTERNS, name="column"):
    """First matching pattern of the (small, configured) list; NULL type when none."""
    lowered = F.lower(F.col(name))
    hit = F.lit(None).cast("struct<data_type_id:string,sensitivity:string,is_pii:boolean>")
    for pattern, type_id, sensitivity, pii in reversed(patterns):
        hit = F.when(
            lowered.rlike(pattern),
            F.struct(
                F.lit(type_id).alias("data_type_id"),
                F.lit(sensitivity).alias("sensitivity"),
                F.lit(pii).alias("is_pii"),
            ),
        ).otherwise(hit)
    return columns.withColumn("_hit", hit).select(
        *columns.columns,
        "_hit.data_type_id",
        "_hit.sensitivity",
        "_hit.is_pii",
        F.when(F.col("_hit").isNotNull(), "pattern").alias("source"),
    )


def by_value(table, columns, patterns, threshold):
    """Share of non-null values matching each pattern; one pass, one small result."""
    shares = []
    for column in columns:
        for type_id, pattern in patterns.items():
            shares.append(
                F.struct(
                    F.lit(column).alias("column"),
                    F.lit(type_id).alias("data_type_id"),
                    F.count(column).alias("n_values"),
                    F.count_if(F.col(column).rlike(pattern)).alias("n_hits"),
                )
            )
    scored = table.agg(F.array(*shares).alias("s")).select(F.inline("s"))
    rate = F.when(F.col("n_values") > 0, F.col("n_hits") / F.col("n_values"))
    return scored.withColumn("hit_rate", rate).withColumn("classified", F.coalesce(rate >= threshold, F.lit(False)))


def override(assignments, keys):
    """One classification per column: manual before value before pattern."""
    rank = F.lit(len(SOURCE_RANK))
    for source, value in SOURCE_RANK.items():
        rank = F.when(F.col("source") == source, F.lit(value)).otherwise(rank)
    payload = [c for c in assignments.columns if c not in keys]
    best = F.min_by(F.struct(*payload), F.struct(rank, F.col("data_type_id")))
    return assignments.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def sensitivity_rank(column):
    rank = F.lit(None).cast("int")
    for name, value in vocab.SENSITIVITY_RANK.items():
        rank = F.when(column == name, F.lit(value)).otherwise(rank)
    return rank


def rollup(columns, keys):
    """Table sensitivity and PII: the most sensitive of its columns."""
    names = F.array(*[F.lit(n) for n in vocab.SENSITIVITY_RANK])
    return (
        columns.groupBy(*keys)
        .agg(
            F.max(sensitivity_rank(F.col("sensitivity"))).alias("rank"),
            F.bool_or("is_pii").alias("pii"),
            F.count("*").alias("n_columns"),
        )
        .select(*keys, names[F.col("rank")].alias("sensitivity"), "pii", "n_columns")
    )
