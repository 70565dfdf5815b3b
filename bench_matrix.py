"""Time the seven pairwise runs of the matrix at their full row counts.

``BENCH_CPUS`` names the local cores, ``BENCH_OUT`` the output folder. Prints
one JSON line. Only row counts, columns, skew, caching, shuffle partitions and
adaptive execution apply to a local session; slow hosts and start delays do not.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tracewright.operators import runs
from tracewright.operators.scenarios import run_scenario


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    out = os.environ.get("BENCH_OUT") or tempfile.mkdtemp(prefix="bench-matrix-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tracewright-bench-matrix")
        .config("spark.driver.memory", "16g")
        .config("spark.default.parallelism", "20")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    table = runs.run_settings(runs.scenario_runs(runs.pinned_versions(spark)))
    pairwise = table.where("id LIKE 'pairwise-%'").orderBy("id").collect()
    seconds = {}
    for run in pairwise:
        started = time.perf_counter()
        run_scenario(spark, run.settings, f"{out}/{run.id}").write.format("noop").mode("overwrite").save()
        seconds[run.id] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "pairwise_suite", "value": total, "unit": "sec", "runs": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
