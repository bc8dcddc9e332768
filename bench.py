"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local threads, BENCH_RUNS
(default 2) the measured runs per query after one warm-up; the median counts. Results go to the noop sink, so every
column of every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from wardflow.plans.queries import QUERIES
from wardflow.session import build_session

HEADLINE = [
    "dim_patient",
    "fact_encounter",
    "fact_lab_results",
    "patient_encounter_summary",
    "patient_visit_summary",
    "department_dashboard",
    "abnormal_results_summary",
    "department_rollup",
    "layer_row_counts",
    "run_summary",
    "batch_health",
    "error_patterns",
    "validated_rows",
    "routed_rows",
    "reason_counts",
    "import_all",
    "masked_patients_analyst",
    "row_policy_clinician",
    "classified_columns",
    "classified_documents",
    "note_summaries",
    "extracted_fields",
    "categorized_turns",
]
# These land files and run streams, with a fixed cost per micro-batch; one run each is enough.
ONCE = ["incremental_summary", "error_alerts"]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    for name in ONCE:
        seconds[name] = round(timed(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
