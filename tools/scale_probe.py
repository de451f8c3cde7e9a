"""How run time grows with input: the driver events table replicated k times.

Copy c gets new ids (event_id + c * n) and timestamps shifted by c * 30 days,
so trade volume, history length and bar counts all grow k-fold (beyond
100,000 bars the chunked windows engage).  Replication uses ``explode`` of a
sequence (a generator, not a join).  Prints one JSON line per k.

Usage: python tools/scale_probe.py SF_DIR SCRATCH_DIR k1 [k2 ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tradeflow.plans.job import run_job  # noqa: E402
from tradeflow.queries import QUERIES  # noqa: E402
from tradeflow.session import make_session  # noqa: E402

KEYS = ["minute_bars", "bar_features", "silver_trades", "regime_symbol_rollup", "account_ranking",
        "tier_by_regime"]


def main() -> int:
    sf, scratch, ks = sys.argv[1], sys.argv[2], [int(k) for k in sys.argv[3:]]
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = make_session("scale-probe", master=f"local[{cpus}]",
                         **{"spark.sql.shuffle.partitions": str(2 * int(cpus))})
    events = spark.read.parquet(f"{sf}/events.parquet")
    n = events.count()
    QUERIES["account_ranking"](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    for k in ks:
        d = os.path.join(scratch, f"x{k}")
        (events.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
         .select((F.col("event_id") + F.col("_c") * n).alias("event_id"),
                 (F.col("ts") + F.make_dt_interval(days=F.col("_c") * 30)).alias("ts"),
                 "user_id", "event_type", "value", "props")
         .write.mode("overwrite").parquet(f"{d}/events.parquet"))
        out = {"k": k, "events": n * k}
        for key in KEYS:
            t0 = time.perf_counter()
            QUERIES[key](spark, d).write.format("noop").mode("overwrite").save()
            out[key] = round(time.perf_counter() - t0, 2)
        t0 = time.perf_counter()
        run_job(spark, os.path.join(d, "wh"), events_dir=d)
        out["job_pipeline"] = round(time.perf_counter() - t0, 2)
        print(json.dumps(out), flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
