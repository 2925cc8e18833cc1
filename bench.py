"""Benchmark: the full pipeline and the business questions at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1):

* ``staging``   raw stand-in extracts -> typed, cleaned, validated Parquet
* ``warehouse`` staging -> 3 dimensions + 2 month-partitioned facts, checked
* ``q1``..``q5``, ``drill_across`` over the written star (read back from Parquet)
* ``dq_constraints`` all warehouse constraints over the written star

Prints one JSON line.  ``rows_per_sec`` is input rows (customer + orders + events)
through staging and warehouse, the figure comparable with the source system's published load rate.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from innkeeper import catalog, session  # noqa: E402
from innkeeper.plans import analytics as A  # noqa: E402
from innkeeper.plans import pipeline as P  # noqa: E402
from innkeeper.plans import warehouse as W  # noqa: E402
from innkeeper.sources import standin  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session.build_session(f"local[{cpus}]", shuffle_partitions=cpus, app="innkeeper-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # JVM start-up and first code generation are not query work: timed apart,
    # reported as warmup_sec and left out of the total.
    t0 = time.perf_counter()
    standin.table(spark, sf_dir, "region").select("r_name").distinct().collect()
    warmup = round(time.perf_counter() - t0, 3)
    root = session.scratch_path(spark, "innkeeper-bench")
    raw = standin.raw_extracts(spark, sf_dir)
    staged = timed("staging", lambda: P.run_staging(spark, raw, f"{root}/staging", enforce=False))
    built = timed(
        "warehouse",
        lambda: P.run_warehouse(
            spark, staged.path, f"{root}/warehouse", enforce=False
        ),
    )
    star = P.read_star(spark, built.path, built.row_counts)
    questions = {
        "q1": lambda: A.cheapest_most_available(star, catalog.Q1_YEAR, catalog.Q1_MONTH),
        "q2": lambda: A.most_reviewed(star, catalog.Q2_YEAR, catalog.Q2_MONTH),
        "q3": lambda: A.priciest_neighbourhoods(star, 1),
        "q4": lambda: A.recommend_month(star, catalog.Q4_GUESTS, catalog.Q4_MIN_DAYS, catalog.Q4_YEAR, catalog.Q4_MONTH),
        "q5": lambda: A.recommend_range(star, catalog.Q5_GUESTS, catalog.Q5_START, catalog.Q5_END),
        "drill_across": lambda: A.drill_across(star),
        "dq_constraints": lambda: W.constraint_report(star),
    }
    for name, build in questions.items():
        timed(name, lambda build=build: build().collect())
    input_rows = sum(standin.table(spark, sf_dir, t).count() for t in ("customer", "orders", "events"))
    load = times["staging"] + times["warehouse"]
    print(
        json.dumps(
            {
                "metric": "pipeline_plus_questions_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "warmup_sec": warmup,
                "input_rows": input_rows,
                "rows_per_sec": round(input_rows / load, 1) if load else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
