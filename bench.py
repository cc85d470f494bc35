"""Times the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from orderlens.operators import kpis
from orderlens.plans import medallion
from orderlens.registry.inputs import SETTINGS, Inputs
from orderlens.registry.queries import QUERIES
from orderlens.session import build_session, scratch_path, staged
from orderlens.sources import lake

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = (
    "j11_silver_build",
    "a06_late_rate_by_state",
    "a07_late_rate_by_category",
    "a08_seller_performance",
    "a09_cross_state_impact",
    "a10_delay_review_impact",
    "a11_monthly_trend",
    "a12_weekday_pattern",
    "a13_executive_dashboard",
    "a15_late_rate_by_year",
    "l05_recent_orders",
    "l06_priority_queue",
    "p28_payload_projection",
    "s12_ingest_incremental",
    "m03_stratified_split",
    "m09_classification_metrics",
    "m10_roc_auc",
    "m16_priority_policy",
    "d02_dataset_drift",
    "d05_monitoring_summary",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run, repeats: int = REPEATS) -> float:
    taken = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def main() -> None:
    spark = build_session(
        "orderlens-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["j11_silver_build"](Inputs(spark, FOLDER)))  # warm the JVM once

    timings = {
        name: median_seconds(lambda build=QUERIES[name]: drain(build(Inputs(spark, FOLDER)))) for name in HEADLINE
    }
    stored = staged(Inputs(spark, FOLDER).silver)
    timings["gold_from_stored_silver"] = median_seconds(
        lambda: [drain(table) for table in kpis.gold_in_one_pass(stored, SETTINGS).values()]
    )
    # The jobs themselves, from a stored Bronze.
    home = scratch_path(spark, "bench")
    lake.write_bronze(Inputs(spark, FOLDER).tables, f"{home}/bronze")
    timings["job_refine"] = median_seconds(lambda: medallion.refine(spark, home, SETTINGS).collect())
    timings["job_publish"] = median_seconds(lambda: medallion.publish(spark, home, SETTINGS))
    timings["m08_score_batch"] = median_seconds(
        lambda: drain(QUERIES["m08_score_batch"](Inputs(spark, FOLDER))), repeats=1
    )
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries (median of runs)",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
