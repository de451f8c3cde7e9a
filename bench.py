"""Benchmark: registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every registered query is planned fresh from the driver tables and executed
to the ``noop`` sink (full execution, no driver collect).  Then the layered
job runs end to end (``job_pipeline``, comparable to the reference's whole
pipeline) and the reference's analyst queries run on the stored layers
(``layer_*``, comparable to its published per-query timings); the job also
runs from a headered CSV of the same trades (``job_pipeline_csv``).  One warm-up
query runs first so JVM start-up is not charged to the first key.  Prints ONE
JSON line: {"metric", "value" (sum of seconds), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tradeflow.operators import (  # noqa: E402
    account_performance,
    day_over_day,
    moving_daily_pnl,
    pnl_by_tier_regime,
    tier_dominance,
    top_in_regime,
    top_n_per_group,
)
from tradeflow.plans.job import run_job  # noqa: E402
from tradeflow.plans.lineage import shared_checkpoint_dir  # noqa: E402
from tradeflow.queries import Q3_END, Q3_START, Q3_SYMBOLS, Q4_SYMBOL, QUERIES, REGIME  # noqa: E402
from tradeflow.schema import TRADE_COLUMNS  # noqa: E402
from tradeflow.session import make_session  # noqa: E402
from tradeflow.sources.fixtures import trades_from_events  # noqa: E402
from tradeflow.warehouse import Warehouse  # noqa: E402

# Analyst queries on the stored layers (how the reference times its SQL).
LAYER_QUERIES = {
    "layer_q1_tier_by_regime": lambda w: pnl_by_tier_regime(w.silver),
    "layer_q2_top5_high_vol": lambda w: top_in_regime(w.gold_b, REGIME, 5),
    "layer_q3_day_over_day": lambda w: day_over_day(w.silver, Q3_SYMBOLS, Q3_START, Q3_END),
    "layer_q4_moving_daily_pnl": lambda w: moving_daily_pnl(w.silver, Q4_SYMBOL),
    "layer_q5_tier_dominance": lambda w: tier_dominance(w.gold_b, REGIME),
    "layer_top3_per_regime_symbol": lambda w: top_n_per_group(
        account_performance(w.silver), ["vol_regime", "symbol"], [F.col("total_pnl").desc_nulls_last()], 3),
}

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(timings: dict, key: str, action) -> None:
    """Time ``action()``; a failure is reported on stderr and recorded as None."""
    t0 = time.perf_counter()
    try:
        action()
        timings[key] = round(time.perf_counter() - t0, 3)
    except Exception as exc:  # keep benchmarking the other entries
        print(f"[bench] {key} failed: {exc!r}", file=sys.stderr)
        timings[key] = None


def main() -> int:
    spark = make_session(
        "tradeflow-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(max(8, 2 * int(CPUS))),
            "spark.driver.memory": "8g",
        },
    )
    keys = sys.argv[1:] or list(QUERIES)
    run(QUERIES["account_ranking"](spark, SF_DIR))  # warm-up
    timings: dict[str, float] = {}
    for key in keys:
        timed(timings, key, lambda key=key: run(QUERIES[key](spark, SF_DIR)))
    if not sys.argv[1:]:
        # The layered job end to end (events -> bronze + bars -> features -> silver
        # -> gold), then the analyst queries on the stored layers.
        root = os.environ.get("BENCH_WAREHOUSE")
        if not root:
            root = f"{shared_checkpoint_dir(spark).rstrip('/')}/tradeflow-bench-{uuid.uuid4().hex}"
        timed(timings, "job_pipeline", lambda: run_job(spark, root, events_dir=SF_DIR))
        # the same trades as the reference's landing format (headered CSV), written
        # once from the events table (untimed), then the job from CSV: parse,
        # quarantines, expectations, bars, features, silver, gold
        csv_dir = f"{root}-landing-csv"
        landing: dict = {}
        timed(landing, "csv", lambda: (
            trades_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet"))
            .withColumn("trade_date", F.date_format("trade_date", "yyyy-MM-dd"))
            .withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .select(*TRADE_COLUMNS).write.mode("overwrite").option("header", True).csv(csv_dir)))
        if landing["csv"] is not None:
            timed(timings, "job_pipeline_csv", lambda: run_job(spark, f"{root}-from-csv", csv=csv_dir))
        else:
            timings["job_pipeline_csv"] = None
        wh = Warehouse(spark, root)
        for key, q in LAYER_QUERIES.items():
            timed(timings, key, lambda q=q: run(q(wh)))
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "sum_query_seconds",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": int(CPUS),
        "n_queries": len(timings),
        "failed": [k for k, v in timings.items() if v is None],
        "reference_sec": {"job_pipeline": 60.0, "job_pipeline_csv": 60.0, "layer_q1_tier_by_regime": 3.88,
                          "layer_top3_per_regime_symbol": 1.73},
    }
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
