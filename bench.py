"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stewardry.plans import catalogue  # noqa: E402
from stewardry.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "compose_decision",
    "compose_decision_exploded",
    "collect_conditions",
    "satisfy_conditions",
    "query_verdict",
    "intent_flip_pairs",
    "resolution_paths",
    "detect_conflicts",
    "coverage_baseline",
    "gate_summary",
    "apply_masks",
    "mask_redact_text",
    "apply_access_window",
    "consent_matrix",
    "reconcile_sources",
    "retention_due",
    "gq_join_sum",
    "evidence_packet",
    "canonicalise_ids",
    "session_outcomes",
    "exception_status_counts",
    "sink_ledger",
    "stream_decide",
)


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        catalogue.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).replace("sf", ""),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
