"""Sinks."""

from pyspark.sql import functions as F

from stewardry.functions.scale import reference_join

LEDGER_FIELDS = (
    "request_id", "authorization_id", "decision_id", "signature", "state", "decision", "reason_code",
    "scenario", "purpose", "role", "actor", "database", "schema", "table", "column", "instant",
)
MAX_ROWS_PER_FILE = 5_000_000
RESULTS_PER_ROW = 1_000


def ledger_rows(decisions):
    return decisions.select(
        *LEDGER_FIELDS, F.to_date("requested_at").alias("eval_date"), "publication_id"
    )


def append_ledger(decisions, path):
    """Receipts partitioned by evaluation date and publication.

    The rebalance hint gives even files, splitting a crowded day; ids make repeated
    receipts harmless to readers.
    """
    (
        ledger_rows(decisions)
        .hint("rebalance", "eval_date", "publication_id")
        .write.mode("append")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy("eval_date", "publication_id")
        .parquet(path)
    )


def read_ledger(spark, path):
    """The ledger with repeated receipts of one call folded together."""
    return spark.read.parquet(path).dropDuplicates(["authorization_id", "request_id"])


def gate_report(results, summaries, path):
    """Machine-readable report: summary and nested results per change set.

    One row per change set; a set with more than ``RESULTS_PER_ROW`` results
    continues on further rows, so no group is ever collected whole.
    """
    sized = reference_join(
        results, summaries.select("change_set_id", "total"), ["change_set_id"], spread_by=["change_id"]
    )
    pieces = F.ceil(F.col("total") / F.lit(RESULTS_PER_ROW)).cast("int")
    nested = (
        sized.withColumn("piece", F.pmod(F.xxhash64("change_id"), pieces).cast("int"))
        .groupBy("change_set_id", "piece")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("change_id", "kind", "decision", "gate", "reason_codes", "required_controls"))
            ).alias("results")
        )
    )
    reference_join(nested, summaries, ["change_set_id"], spread_by=["piece"]).write.mode("overwrite").json(path)
