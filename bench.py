"""Benchmark: build the whole model graph at one scale factor, then run the
reports and the data-quality suite over the built tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

"load:raw_tables" times writing the six raw tables; "build:<models>" times
one dependency level of materialised models (marts, dimensions, facts),
built concurrently on 4 threads and reading the tables written before it
(staging views and the ephemeral history are computed inside their
consumers); "rpt_*" time each report (run 4 at a time, "reports_total" the
phase) and "dq_suite" the checks, all over the written tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.operators import quality  # noqa: E402
from basketry.plans.pipeline import BUILD_THREADS, MODEL_ORDER, Models, build_levels, load_raw, materialize  # noqa: E402
from basketry.session import get_session, release_anchors  # noqa: E402

REPORTS = ["rpt_kpi", "rpt_segments", "rpt_loyalty", "rpt_frequency", "rpt_segment_rate", "rpt_hourly",
           "rpt_daily", "rpt_departments", "rpt_top_reordered", "rpt_peak_times", "rpt_top_products"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="bk-bench-")
    extra = {"spark.checkpoint.dir": os.path.join(scratch, "ckpt")}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_session(f"local[{cpus}]", app_name="basketry-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)), extra=extra)
    root = os.path.join(scratch, "warehouse")
    times: dict[str, float] = {}

    t_all = time.time()
    m = Models.from_fixtures(spark, sf_dir)
    t = time.time()
    load_raw(m, root)
    times["load:raw_tables"] = round(time.time() - t, 3)
    # The build, level by level: models of one level run concurrently (4
    # threads, as the reference's builds), each level reads the tables
    # written by the previous ones.
    for level in build_levels(MODEL_ORDER):
        t = time.time()
        materialize(m, root, level, load=False, threads=BUILD_THREADS)
        times["build:" + "+".join(level)] = round(time.time() - t, 3)
    build = time.time() - t_all

    # The reports, run side by side as a dashboard issues them.
    def run_report(name):
        t0 = time.time()
        m.report(name).collect()
        return name, round(time.time() - t0, 3)

    t = time.time()
    with ThreadPoolExecutor(max_workers=BUILD_THREADS) as pool:
        for name, sec in pool.map(run_report, REPORTS):
            times[name] = sec
    times["reports_total"] = round(time.time() - t, 3)

    class _T:
        def __getitem__(self, k):
            return m.raw[k] if k in m.raw else getattr(m, k)

    t = time.time()
    quality.run_dq_suite(_T(), threads=BUILD_THREADS).collect()
    times["dq_suite"] = round(time.time() - t, 3)
    total = time.time() - t_all
    release_anchors(spark)  # the run is over: nothing reads the numbering anchors any more

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_build_reports_dq_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "build_sec": round(build, 3),
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
