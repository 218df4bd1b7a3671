"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]. Each query runs once to
warm up, then $BENCH_RUNS times; the median is reported. The long model queries run once. Results go to Spark's
``noop`` sink, which takes every row and column.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from wardflow.catalogue.queries import QUERIES
from wardflow.session import local_session

HEADLINE = (
    "rate_full_by_diagnosis",
    "patient_history",
    "encounters_with_history",
    "visit_gap",
    "visit_number_dates",
    "med_change_flag",
    "feature_table",
    "feature_table_join",
    "patients_first_row",
    "diagnosis_map",
    "melt_active",
    "fill_median",
    "one_hot",
    "profile_missing",
    "dq_tables",
    "score_input_check",
    "surrogate_keys",
    "stratified_split_sizes",
    "seeded_sample",
    "class_report",
    "pr_curve",
    "roc_auc",
    "risk_bands",
    "trend_by_admission",
    "ingest_patients",
    "ingest_encounters",
    "ingest_diagnoses",
    "ingest_medications",
)
# Fits of a hundred trees and more: timed once, without a run to warm up.
LONG = ("gbt_score", "gbt_grid", "attribution", "three_class_forest")


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else (*HEADLINE, *LONG)
    spark = local_session(cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    found = {}
    for name in names:
        if name in LONG:
            found[name] = round(seconds(spark, name, folder), 3)
            continue
        seconds(spark, name, folder)
        found[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(found.values()), 3),
                "unit": "sec",
                "queries": found,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
