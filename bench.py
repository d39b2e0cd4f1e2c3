"""Benchmark: the ten models (and the DAG build) on the driver's tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's full plan is executed with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "m_dim_pool", "m_dim_block", "m_fact_price_1d", "m_fact_block", "m_fact_network_stats_1d",
    "m_fact_pool_stats_1d", "m_obt_block", "m_obt_network_stats_1d", "m_obt_pool_stats_1d",
    "c_calendar", "w1_dedupe_latest", "o2_topk_mixed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    from chainstar.operators.sinks import create_namespaces
    from chainstar.session import checkpoint_dir, get_session
    from chainstar.plans import catalog
    from chainstar.plans.marts import Marts, build
    from chainstar.sources.standins import load_sources

    scratch = tempfile.mkdtemp(prefix="chainstar-bench-")   # local run: no shared folder set
    spark = get_session(f"local[{cpus}]", max(8, cpus * 2), app="chainstar-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                               "spark.ui.showConsoleProgress": "false",
                               "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    checkpoint_dir(spark, f"{scratch}/checkpoint")
    # Warm the JVM (codegen, file listing) outside the timings.
    catalog.QUERIES["m_fact_price_1d"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    plan_times: dict[str, float] = {}
    for name in (only or HEADLINE):
        t0 = time.perf_counter()          # plan construction (size checks) included
        df = catalog.QUERIES[name](spark, sf_dir)
        t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        plan_times[name] = round(t1 - t0, 3)

    if not only:
        # The whole DAG materialised (dims and facts as Parquet tables, the
        # block tables bucketed by block_id, OBTs as views read once), each
        # model reading its inputs' tables.
        out = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"
        t0 = time.perf_counter()
        marts = Marts(spark, load_sources(spark, sf_dir), run_ts=catalog.RUN_TS, strict=False)
        create_namespaces(spark)
        built = build(marts, out, block_buckets=max(8, cpus * 2), use_catalog=True)
        for name in ("obt.block", "obt.network_stats_1d", "obt.pool_stats_1d"):
            built[name].write.format("noop").mode("overwrite").save()
        times["dag_build_all"] = round(time.perf_counter() - t0, 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "models_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "plan_sec": plan_times,
    }))


if __name__ == "__main__":
    main()
