"""Queries that enforce answers on the data tables, and governed relational queries."""

from datetime import datetime

from pyspark.sql import functions as F

from stewardry.functions import masks
from stewardry.operators import asof, compose, enforce, lattice
from stewardry.plans import estate
from stewardry.plans.registry import cte, query
from stewardry.schemas import S

SECRET = "s3cr3t"
BASES = {
    "analytics.reporting": "consent_measurement",
    "marketing.personalization": "consent_personalization",
    "sharing.third_party": "consent_activation",
}
PARTIAL = "left({c}, 1) || '***' || CASE WHEN contains({c}, '@') THEN '@' || split_part({c}, '@', -1) ELSE '' END"


def _redact_sql(column):
    for label, pattern in masks.REDACTIONS:
        column = f"regexp_replace({column}, '{pattern}', '[{label}]', 'g')"
    return column


def _hits_sql(column):
    counts = {}
    for label, pattern in masks.REDACTIONS:
        counts[label] = f"len(regexp_extract_all({column}, '{pattern}'))"
        column = f"regexp_replace({column}, '{pattern}', '[{label}]', 'g')"
    return counts


# --- masks ---------------------------------------------------------------------------


@query(
    "mask_partial",
    f"SELECT customer_id, {PARTIAL.format(c='email')} AS email, {PARTIAL.format(c='customer_name')} AS customer_name FROM customers",
    ["customers"],
)
def mask_partial(w):
    return w.customers().select(
        "customer_id", masks.partial(F.col("email")).alias("email"), masks.partial(F.col("customer_name")).alias("customer_name")
    )


@query("mask_full", "SELECT transaction_id, '****' AS amount FROM payments", ["payments"])
def mask_full(w):
    return w.payments().select("transaction_id", masks.full(F.col("amount")).alias("amount"))


@query(
    "mask_hash",
    f"SELECT event_id, sha256('{SECRET}' || CAST(user_id AS VARCHAR)) AS device_id FROM events",
)
def mask_hash(w):
    return w.table("events").select("event_id", masks.hashed(F.col("user_id"), SECRET).alias("device_id"))


def _token(column):
    return f"'tok_' || left(sha256('{SECRET}|' || CAST({column} AS VARCHAR)), 32)"


@query(
    "mask_tokenize",
    f"""SELECT {_token('o_custkey')} AS customer_token, count(*) AS n_orders FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1""",
)
def mask_tokenize(w):
    """Tokens of two tables join without the raw key."""
    left = w.payments().select(masks.tokenize(F.col("customer_id"), SECRET).alias("customer_token"))
    right = w.customers().select(masks.tokenize(F.col("customer_id"), SECRET).alias("customer_token"))
    return left.join(right, "customer_token", "left_semi").groupBy("customer_token").agg(F.count("*").alias("n_orders"))


@query(
    "mask_redact_text",
    "SELECT doc_id, sha256(" + _redact_sql("text") + ") AS redacted_hash, "
    + ", ".join(f"{expr} AS n_{label}" for label, expr in _hits_sql("text").items())
    + " FROM documents",
)
def mask_redact_text(w):
    redacted = masks.redact_counted(w.table("documents").select("doc_id", "text"), "text")
    return redacted.select(
        "doc_id",
        F.sha2("text", 256).alias("redacted_hash"),
        *[F.col(f"n_{label}").cast("long").alias(f"n_{label}") for label, _ in masks.REDACTIONS],
    )


@query(
    "apply_masks",
    f"""SELECT 'customers' AS table_name, customer_id AS row_id, {PARTIAL.format(c='email')} AS value FROM customers
    UNION ALL SELECT 'payments', transaction_id, {_token('amount')} FROM payments
    UNION ALL SELECT 'usage', event_id, sha256('{SECRET}' || 'dev-' || CAST(user_id AS VARCHAR)) FROM events
    UNION ALL SELECT 'tickets', doc_id, sha256({_redact_sql('text')}) FROM documents""",
    ["customers", "payments"],
)
def apply_masks(w):
    """Masks chosen by the served rules for the marketing role."""
    rules = w.rules()

    def masked(df, asset):
        return enforce.apply_masks(df, enforce.mask_map(rules, asset, "marketing", df.columns), SECRET)

    usage = w.table("events").select("event_id", F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("device_id"))
    tickets = w.table("documents").select("doc_id", F.col("text").alias("ticket_text"))
    parts = [
        ("customers", masked(w.customers(), estate.CUSTOMERS), "customer_id", F.col("email")),
        ("payments", masked(w.payments(), estate.PAYMENTS), "transaction_id", F.col("amount")),
        ("usage", masked(usage, estate.USAGE), "event_id", F.col("device_id")),
        ("tickets", masked(tickets, estate.TICKETS), "doc_id", F.sha2("ticket_text", 256)),
    ]
    out = None
    for name, df, key, value in parts:
        rows = df.select(F.lit(name).alias("table_name"), F.col(key).alias("row_id"), value.alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- row filter, windows, consent -----------------------------------------------------

ENTITLED = (("people_ops", "EUROPE"), ("people_ops", "ASIA"), ("auditor", "AMERICA"))


@query(
    "apply_row_filter",
    "SELECT customer_id, region FROM customers WHERE region IN ('EUROPE', 'ASIA')",
    ["customers"],
)
def apply_row_filter(w):
    entitled = w.spark.createDataFrame(list(ENTITLED), "role string, region string")
    return enforce.apply_row_filter(w.customers(), entitled, "people_ops").select("customer_id", "region")


ANCHOR = datetime(2024, 1, 20)


@query(
    "apply_access_window",
    """SELECT event_id, 'research.general' AS purpose FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-06' AND TIMESTAMP '2024-01-20'
    UNION ALL SELECT event_id, 'commercial.general' FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-13' AND TIMESTAMP '2024-01-20'""",
)
def apply_access_window(w):
    events = w.table("events").select("event_id", "ts")
    scanned = enforce.apply_access_window(events, "ts", ANCHOR, 14)
    return enforce.tag_access_windows(
        scanned, "ts", [("research.general", ANCHOR, 14), ("commercial.general", ANCHOR, 7)]
    ).select("event_id", "purpose")


_BASES_SQL = " UNION ALL ".join(
    f"SELECT customer_id, segment, '{p}' AS purpose, {c} = 'granted' AS granted FROM customers" for p, c in BASES.items()
)
cte("bases", _BASES_SQL, "customers")


@query("apply_consent", "SELECT customer_id, purpose FROM bases WHERE granted", ["bases"])
def apply_consent(w):
    return enforce.consent_bases(w.customers(), BASES).filter("granted").select("customer_id", "purpose")


@query(
    "consent_matrix",
    """SELECT coalesce(segment, 'ALL') AS segment, coalesce(purpose, 'ALL') AS purpose,
    CAST(count(*) FILTER (WHERE granted) AS BIGINT) AS granted, CAST(count(*) FILTER (WHERE NOT granted) AS BIGINT) AS refused FROM bases GROUP BY CUBE (segment, purpose)""",
    ["bases"],
)
def consent_matrix(w):
    return enforce.consent_matrix(w.customers(), BASES, "segment").select(
        F.coalesce("segment", F.lit("ALL")).alias("segment"), F.coalesce("purpose", F.lit("ALL")).alias("purpose"),
        "granted", "refused",
    )


# --- sources and roles -------------------------------------------------------------------

AUTHORITY = {"fraud.detection": "network", "operations.support": "transactions", "compliance.audit": "processor"}


def feeds(w):
    return {
        "transactions": w.payments().select("transaction_id", "settlement_state"),
        "processor": w.processor().select("transaction_id", "settlement_state"),
        "network": w.network().select("transaction_id", "settlement_state"),
    }


@query(
    "select_authoritative_source",
    """SELECT 'fraud.detection' AS purpose, 'network' AS source, transaction_id, settlement_state FROM network
    UNION ALL SELECT 'operations.support', 'transactions', transaction_id, settlement_state FROM payments
    UNION ALL SELECT 'compliance.audit', 'processor', transaction_id, settlement_state FROM processor""",
    ["network", "payments", "processor"],
)
def select_authoritative_source(w):
    return enforce.select_source(feeds(w), AUTHORITY, list(AUTHORITY)).select(
        "purpose", "source", "transaction_id", "settlement_state"
    )


@query(
    "reconcile_sources",
    """SELECT transaction_id, t AS transactions_state, p AS processor_state, n AS network_state,
    concat_ws(',', CASE WHEN t IS NULL THEN 'transactions' END, CASE WHEN p IS NULL THEN 'processor' END, CASE WHEN n IS NULL THEN 'network' END) AS missing,
    CASE WHEN t IS NULL OR p IS NULL OR n IS NULL THEN 'missing' WHEN t = p AND p = n THEN 'agree' ELSE 'disagree' END AS status
    FROM (SELECT transaction_id, settlement_state AS t FROM payments)
    FULL JOIN (SELECT transaction_id, settlement_state AS p FROM processor) USING (transaction_id)
    FULL JOIN (SELECT transaction_id, settlement_state AS n FROM network) USING (transaction_id)""",
    ["network", "payments", "processor"],
)
def reconcile_sources(w):
    return enforce.reconcile(feeds(w), "transaction_id", "settlement_state")


@query(
    "reconciled_only",
    """SELECT settlement_state, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS amount FROM payments
    WHERE transaction_id IN (SELECT transaction_id FROM network WHERE settlement_state = 'reconciled') GROUP BY 1""",
    ["payments", "network"],
)
def reconciled_only(w):
    good = w.network().filter("settlement_state = 'reconciled'").select("transaction_id")
    kept = w.payments().join(good, "transaction_id", "left_semi")
    return kept.groupBy("settlement_state").agg(
        F.count("*").alias("n_rows"), F.sum("amount").cast("double").alias("amount")
    )


@query(
    "role_context_views",
    f"""SELECT 'clinical' AS role, customer_id AS row_id, email, CAST(arr AS VARCHAR) AS arr, 'full' AS context FROM customers
    UNION ALL SELECT 'member_services', customer_id, {PARTIAL.format(c='email')}, '****', 'service' FROM customers
    UNION ALL SELECT 'research', NULL, NULL, CAST(arr AS VARCHAR), CASE WHEN consent_measurement = 'granted' THEN 'cohort' ELSE 'withheld' END FROM customers
    UNION ALL SELECT 'marketing', customer_id, CASE WHEN consent_activation = 'granted' THEN email END, NULL,
      CASE WHEN consent_activation = 'granted' THEN 'opted_in' ELSE 'withheld' END FROM customers""",
    ["customers"],
)
def role_context_views(w):
    nothing, email, arr = F.lit(None).cast("string"), F.col("email"), F.col("arr")
    opted = F.col("consent_activation") == "granted"
    row_id = F.col("customer_id")
    views = {
        "clinical": dict(row_id=row_id, email=email, arr=arr, context=F.lit("full")),
        "member_services": dict(row_id=row_id, email=masks.partial(email), arr=masks.full(arr), context=F.lit("service")),
        "research": dict(
            row_id=nothing, email=nothing, arr=arr,
            context=F.when(F.col("consent_measurement") == "granted", "cohort").otherwise("withheld"),
        ),
        "marketing": dict(
            row_id=row_id, email=F.when(opted, email), arr=nothing,
            context=F.when(opted, "opted_in").otherwise("withheld"),
        ),
    }
    return enforce.role_views(w.customers(), views).withColumn("row_id", F.col("row_id").cast("long"))


@query(
    "anonymize",
    """WITH c AS (SELECT region, segment, CAST(floor(arr / 2500) AS BIGINT) AS arr_band, CAST(arr AS DOUBLE) AS arr FROM customers)
    SELECT region, segment, arr_band, count(*) AS n_rows FROM c GROUP BY ALL HAVING count(*) >= 5""".replace("WITH c AS", ", c AS", 1),
    ["customers"],
)
def anonymize(w):
    kept = enforce.anonymize(
        w.customers(),
        ["customer_id", "customer_name", "email", "country"],
        {"region": F.col("region"), "segment": F.col("segment"), "arr_band": F.floor(F.col("arr") / 2500).cast("long")},
        5,
    )
    return kept.groupBy("region", "segment", "arr_band").agg(F.count("*").alias("n_rows"))


# Levels of each quasi-identifier from fine to coarse, as the checking SQL writes them.
LADDERS = {
    "place": ("country", "region", "'*'"),
    "segment": ("segment", "'*'"),
    "arr_band": (
        "CAST(CAST(floor(arr / 2500) AS BIGINT) AS VARCHAR)", "CAST(CAST(floor(arr / 5000) AS BIGINT) AS VARCHAR)", "'*'",
    ),
}
FEWEST = 5


def _over_nodes(select):
    """One SELECT per node of the lattice; {0}, {1}, {2} are its expressions, {levels} its level numbers, {height} their sum."""
    for node in lattice.nodes(LADDERS):
        steps = [levels[n] for levels, n in zip(LADDERS.values(), node)]
        numbers = ", ".join(f"{n} AS {name}_level" for name, n in zip(LADDERS, node))
        yield select.format(*steps, levels=numbers, height=sum(node))


cte(
    "node_groups",
    " UNION ALL ".join(
        _over_nodes(
            "SELECT {levels}, {height} AS height, {0} AS place, {1} AS segment, {2} AS arr_band, count(*) AS n "
            "FROM customers GROUP BY ALL"
        )
    ),
    "customers",
)
cte(
    "node_losses",
    f"""SELECT *, row_number() OVER (ORDER BY n_lost > 0, CASE WHEN n_lost > 0 THEN n_lost ELSE height END, height,
      place_level, segment_level, arr_band_level) = 1 AS chosen FROM (
      SELECT place_level, segment_level, arr_band_level, height, count(*) AS n_groups,
        CAST(sum(CASE WHEN n < {FEWEST} THEN n ELSE 0 END) AS BIGINT) AS n_lost FROM node_groups GROUP BY 1, 2, 3, 4)""",
    "node_groups",
)


def ladders():
    def band(width):
        return F.floor(F.col("arr") / width).cast("long").cast("string")

    star = F.lit("*")
    return {
        "place": [F.col("country"), F.col("region"), star],
        "segment": [F.col("segment"), star],
        "arr_band": [band(2500), band(5000), star],
    }


@query(
    "anonymity_levels",
    "SELECT place_level, segment_level, arr_band_level, height, n_groups, n_lost, chosen FROM node_losses",
    ["node_losses"],
)
def anonymity_levels(w):
    steps = ladders()
    losses = lattice.node_losses(lattice.finest_groups(w.customers(), steps), steps, FEWEST)
    node, _, _ = lattice.choose(losses, steps)
    levels = F.struct(*[F.col(f"{name}_level") for name in steps])
    return losses.withColumn("chosen", levels == F.struct(*[F.lit(n) for n in node]))


@query(
    "anonymize_lattice",
    f"""SELECT g.place, g.segment, g.arr_band, g.n AS n_rows FROM node_groups g JOIN node_losses USING (place_level, segment_level, arr_band_level)
    WHERE chosen AND n >= {FEWEST}""",
    ["node_groups", "node_losses"],
)
def anonymize_lattice(w):
    """Customers at the lowest levels under which no group is smaller than five, counted by group."""
    drop = ["customer_id", "customer_name", "email", "country", "region", "arr"]
    kept = lattice.generalise(w.customers(), drop, ladders(), FEWEST)
    return kept.groupBy("place", "segment", "arr_band").agg(F.count("*").alias("n_rows"))


EXPORTS = f"""
SELECT c_custkey AS export_id, {estate.pick('c_custkey % 4', estate.SYSTEMS)} AS dest_system,
  CASE WHEN {estate.div('c_custkey', 4)} % 3 = 0 THEN 'product' ELSE 'master' END AS db,
  CASE WHEN {estate.div('c_custkey', 4)} % 3 = 0 THEN 'product_usage_events' ELSE 'customers' END AS tbl,
  CASE WHEN c_nationkey % 2 = 0 THEN 'EU' ELSE 'US' END AS consumer_jurisdiction
FROM {{customer}}
"""
cte("exports", EXPORTS)


def dispositions(w):
    exports = w.sql(EXPORTS)
    keys = ["db", "tbl", "dest_system", "consumer_jurisdiction"]
    contexts = exports.select(*keys).distinct()
    null = F.lit(None).cast(S)
    asked = contexts.select(
        F.xxhash64(*keys).alias("request_id"),
        F.lit("2024-01-15").cast("timestamp_ntz").alias("requested_at"), null.alias("role"),
        F.col("db").alias("database"), F.lit("public").alias("schema"), F.col("tbl").alias("table"),
        null.alias("column"), F.lit("residency.cross_border_transfer").alias("scenario"), null.alias("purpose"),
        F.lit("export").alias("operation"), "dest_system", F.lit("US").alias("dest_jurisdiction"),
        "consumer_jurisdiction", F.lit(None).cast("timestamp_ntz").alias("as_of"),
    )
    decided = compose.decide_in_place(asked, w.rules()).select(
        F.col("database").alias("db"), F.col("table").alias("tbl"), "dest_system", "consumer_jurisdiction", "decision"
    )
    return enforce.transfer_dispositions(exports, decided, keys, derived="destinations")


@query(
    "transfer_partition",
    """SELECT export_id, dest_system, CASE WHEN dest_system IN ('ADS_PLATFORM', 'EXTERNAL_LLM_VENDOR') THEN 'reject'
      WHEN tbl = 'product_usage_events' AND dest_system <> 'INTERNAL_WAREHOUSE' THEN 'reject' ELSE 'hold' END AS disposition
    FROM exports""",
    ["exports"],
)
def transfer_partition(w):
    return dispositions(w).select("export_id", "dest_system", "disposition")


@query(
    "retention_due",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate + INTERVAL 5 YEAR, '%Y-%m-%d') AS due_at, 'archive' AS action
    FROM lineitem WHERE l_shipdate + INTERVAL 5 YEAR <= TIMESTAMP '2003-06-30'""",
)
def retention_due(w):
    rows = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    due = enforce.retention_due(rows, "l_shipdate", 5, datetime(2003, 6, 30), "archive")
    return due.select("l_orderkey", "l_linenumber", F.date_format("due_at", "yyyy-MM-dd").alias("due_at"), "action")


@query(
    "ingestion_gate",
    """SELECT source, gate, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM (
      SELECT *, CASE WHEN CAST(replace(source, 'src', '') AS INT) % 3 = 0 THEN 'INGEST' ELSE 'SKIP' END AS gate FROM documents)
    GROUP BY 1, 2""",
)
def ingestion_gate(w):
    docs = w.table("documents").select("doc_id", "source", "n_chars")
    number = F.regexp_replace("source", "src", "").cast("int")
    corpora = docs.select("source").distinct().withColumn(
        "decision", F.when(number % 3 == 0, "allow").when(number % 3 == 1, "conditional").otherwise("deny")
    )
    gated = enforce.ingestion_gate(docs, corpora, derived="corpora")
    return gated.groupBy("source", "gate").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))


STATUTES = (
    ("F", "v1", None, "1997-01-01 00:00:00"),
    ("F", "v2", "1997-01-01 00:00:00", "1999-06-01 00:00:00"),
    ("F", "v3", "2000-01-01 00:00:00", None),
    ("O", "w1", "1996-01-01 00:00:00", None),
)


@query(
    "statute_in_force_join",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'v1'
      WHEN o_orderdate < TIMESTAMP '1999-06-01' THEN 'v2' WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'v3' END
      WHEN o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1996-01-01' THEN 'w1' END AS statute FROM orders""",
)
def statute_in_force_join(w):
    versions = w.spark.createDataFrame(list(STATUTES), "law string, statute string, f string, u string").select(
        "law", "statute",
        F.col("f").cast("timestamp_ntz").alias("effective_from"), F.col("u").cast("timestamp_ntz").alias("effective_until"),
    )
    records = w.table("orders").select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("law"))
    return asof.in_force_at(records, versions, ["law"], "o_orderdate").select(
        "o_orderkey", F.col("in_force.statute").alias("statute")
    )


@query(
    "precedence_determination",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' OR c_acctbal <= 1000 + 500 * (c_custkey % 5) THEN 'eligible' ELSE 'ineligible' END AS determination,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'categorical' ELSE 'income' END AS basis,
    concat_ws(',', CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'categorical_qualifier' END,
      CASE WHEN c_acctbal <= 1000 + 500 * (c_custkey % 5) THEN 'income_test_met' ELSE 'income_test_not_met' END) AS reasons
    FROM customer""",
)
def precedence_determination(w):
    rows = w.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return enforce.determine(
        rows, F.col("c_mktsegment") == "HOUSEHOLD", F.col("c_acctbal"), 1000 + 500 * (F.col("c_custkey") % 5)
    ).select("c_custkey", "determination", "basis", "reasons")


# --- governed relational queries -----------------------------------------------------------


def money(column):
    return F.sum(column).cast("double")


@query("gq_sum_by_region", "SELECT region, CAST(sum(arr) AS DOUBLE) AS arr FROM customers GROUP BY 1", ["customers"])
def gq_sum_by_region(w):
    return w.customers().groupBy("region").agg(money("arr").alias("arr"))


@query(
    "gq_detail_filter",
    f"SELECT customer_name, {PARTIAL.format(c='email')} AS email FROM customers WHERE region = 'EUROPE'",
    ["customers"],
)
def gq_detail_filter(w):
    rows = w.customers().filter("region = 'EUROPE'")
    chosen = enforce.mask_map(w.rules(), estate.CUSTOMERS, "marketing")
    return enforce.apply_masks(rows, chosen, SECRET).select("customer_name", "email")


@query(
    "gq_join_sum",
    "SELECT region, CAST(sum(amount) AS DOUBLE) AS amount FROM customers JOIN payments USING (customer_id) GROUP BY 1",
    ["customers", "payments"],
)
def gq_join_sum(w):
    per_customer = w.payments().groupBy("customer_id").agg(F.sum("amount").alias("amount"))
    return w.customers().join(per_customer, "customer_id").groupBy("region").agg(money("amount").alias("amount"))


@query(
    "gq_cte_sum",
    """SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS amount FROM (SELECT p.*, n.transaction_id AS net
    FROM payments p LEFT JOIN network n ON n.transaction_id = p.transaction_id) WHERE net IS NULL GROUP BY 1""",
    ["payments", "network"],
)
def gq_cte_sum(w):
    recent = w.payments().join(w.network().select("transaction_id"), "transaction_id", "left_anti")
    return recent.groupBy("customer_id").agg(money("amount").alias("amount"))


@query("gq_count_by_region", "SELECT region, count(*) AS n_customers FROM customers GROUP BY 1", ["customers"])
def gq_count_by_region(w):
    return w.customers().groupBy("region").agg(F.count("*").alias("n_customers"))


@query(
    "gq_cross_schema_join",
    "SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, CAST(fee_amount AS DOUBLE) AS fee_amount FROM payments JOIN processor USING (transaction_id)",
    ["payments", "processor"],
)
def gq_cross_schema_join(w):
    fees = w.processor().select("transaction_id", "fee_amount")
    return w.payments().join(fees, "transaction_id").select(
        "transaction_id", F.col("amount").cast("double").alias("amount"), F.col("fee_amount").cast("double").alias("fee_amount")
    )


@query(
    "gq_star_limit",
    "SELECT transaction_id, customer_id, CAST(amount AS DOUBLE) AS amount, settlement_state FROM payments ORDER BY amount DESC, transaction_id LIMIT 5",
    ["payments"],
)
def gq_star_limit(w):
    top = w.payments().drop("authorized_at").orderBy(F.col("amount").desc(), "transaction_id").limit(5)
    return top.withColumn("amount", F.col("amount").cast("double"))


@query(
    "gq_window_filter",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'",
)
def gq_window_filter(w):
    return enforce.apply_access_window(
        w.table("events").select("event_id", "user_id", "ts"), "ts", datetime(2024, 1, 12), 7
    ).select("event_id", "user_id")


@query(
    "gq_not_equal_filter",
    "SELECT transaction_id, settlement_state FROM payments WHERE settlement_state <> 'reconciled'",
    ["payments"],
)
def gq_not_equal_filter(w):
    return w.payments().filter("settlement_state != 'reconciled'").select("transaction_id", "settlement_state")
