"""The layered batch job (S6): raw -> bronze -> bars -> features -> silver -> gold.

Each layer is written as partitioned Parquet and the next stage re-reads it
with its declared schema, so every layer is also a lineage cut: a lost
executor only recomputes the current stage, and the bar features are computed
once although both the thresholds and the labels read them.

    python -m tradeflow.plans.job --root /data/tradeflow --csv /landing/trades/*.csv
    python -m tradeflow.plans.job --root /data/tradeflow --events /root/testdata/sf0.1
    python -m tradeflow.plans.job --root /data/tradeflow --late /landing/late/*.csv
    python -m tradeflow.plans.job --root /data/tradeflow --late /landing/late/*.csv --by-delta
"""

from __future__ import annotations

import argparse
import sys
import time
import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeflow.operators import (
    priced_trades,
    attach_labels,
    bar_features,
    label_bars,
    minute_bars,
    rank_accounts,
    vol_thresholds,
)
from tradeflow.operators.cells import counted_bars
from tradeflow.operators.economics import storage_precision
from tradeflow.operators.quality import with_failed_rules
from tradeflow.operators.regimes import BAR_LABEL_COLUMNS
from tradeflow.operators.rollups import gold_from_rollups, gold_rollups
from tradeflow.plans.colocated import ColocatedLayers
from tradeflow.plans.lineage import materialize
from tradeflow.schema import BAR_LAYER_SCHEMA, BRONZE_SCHEMA, COUNTED_BAR_SCHEMA, FEATURE_SCHEMA, SILVER_SCHEMA
from tradeflow.sinks import write_layer
from tradeflow.sinks.files import remove_partitions
from tradeflow.sources import read_layer, read_trades_csv
from tradeflow.sources.files import CORRUPT_COL
from tradeflow.sources.fixtures import trades_raw_from_events


@dataclass
class Layout:
    """Paths of every layer under one root (any Hadoop URI), and one run's folder for intermediate results."""

    root: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("warehouse", "bronze_trades")

    @property
    def quarantine(self) -> str:
        """Rows whose text did not parse (raw line kept)."""
        return self._p("warehouse", "quarantine_trades", "parse")

    @property
    def quarantine_expectations(self) -> str:
        """Typed rows that failed an expectation (``failed_rules`` kept)."""
        return self._p("warehouse", "quarantine_trades", "expectations")

    @property
    def staging(self) -> str:
        """Intermediate results of this run, shared like every layer; removed by ``clear_staging``."""
        return self._p("staging", self.run)

    @property
    def bars(self) -> str:
        return self._p("warehouse", "minute_bars")

    @property
    def features(self) -> str:
        return self._p("warehouse", "bar_features")

    @property
    def colocated(self) -> str:
        """What the colocated form keeps beside bronze: labelled bars, cells, number of buckets."""
        return self._p("warehouse", "colocated")

    @property
    def silver(self) -> str:
        return self._p("warehouse", "silver_trades")

    @property
    def gold_regime(self) -> str:
        return self._p("warehouse", "gold", "agg_by_vol_regime")

    @property
    def gold_ranking(self) -> str:
        return self._p("warehouse", "gold", "account_ranking_by_regime")

    @property
    def gold_daily(self) -> str:
        return self._p("warehouse", "gold", "daily_pnl_by_tier_trend")


def clear_staging(spark: SparkSession, layout: Layout) -> None:
    """Remove the run's intermediate results, once the layers that read them are written."""
    remove_partitions(spark, f"{layout.root.rstrip('/')}/staging", [layout.run])


@dataclass
class JobReport:
    counts: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    bars_stored_by_ingest: bool = False


def colocated_layers(spark: SparkSession, layout: Layout, **sizes: int) -> ColocatedLayers:
    """The job's bronze as bucketed trades, with the labelled bars beside it."""
    return ColocatedLayers(spark, layout.colocated, trades_path=layout.bronze, **sizes)


def ingest_bronze(spark: SparkSession, layout: Layout, report: JobReport, csv: str | None = None,
                  events_dir: str | None = None, store: ColocatedLayers | None = None) -> None:
    """Raw trades -> bronze (partitioned by trade_date, time-ordered files).

    CSV input is typed with the declared schema; rows that do not parse (dates
    included) go to the parse quarantine, typed rows failing an expectation
    (N2) to the expectation quarantine, the rest to bronze.  The text is parsed
    once, into a staging table under the job's root with one folder per route;
    the layers are written from it.  With ``store`` bronze is dealt to buckets
    that the bars share; the bars are then built here, because their counts say
    how the trades are dealt.
    """
    if csv is not None:
        staged = stage_trades(spark, layout, csv)
        if store is not None:
            write_bars(counted_bars(staged["good"]), layout)
            report.bars_stored_by_ingest = True
        write_bronze(spark, staged["good"], layout, store)
        staged["failed"].write.mode("overwrite").parquet(layout.quarantine_expectations)
        staged["bad"].write.mode("overwrite").parquet(layout.quarantine)
        report.counts.update({"ingested": staged["n"].get("good", 0), "quarantined": staged["n"].get("bad", 0)})
        report.counts.update({f"failed_{k}": v for k, v in staged["failures"].items()})
    elif events_dir is not None:
        # Pricing needs the minute bars (markout), so they are built here, once,
        # and stored as the bars layer; bronze is priced against the stored copy.
        events = spark.read.parquet(f"{events_dir.rstrip('/')}/events.parquet")
        flow = trades_raw_from_events(events, with_tier=True)
        write_bars(minute_bars(flow) if store is None else counted_bars(flow), layout)
        bars = read_layer(spark, layout.bars, BAR_LAYER_SCHEMA).drop("trade_date")
        # stored prices carry their storage precision
        write_bronze(spark, storage_precision(priced_trades(flow, None, bars=bars)), layout, store)
        report.bars_stored_by_ingest = True
    else:
        raise ValueError("give csv or events_dir")


def write_bronze(spark: SparkSession, trades: DataFrame, layout: Layout, store: ColocatedLayers | None = None) -> None:
    """Bronze by day; with ``store`` (whose bars are stored already) in buckets by cell."""
    if store is None:
        write_layer(trades, layout.bronze, ["trade_date"], sort_by=["ts"])
    else:
        store.plan(read_layer(spark, layout.bars, COUNTED_BAR_SCHEMA))
        store.write_trades(trades)


def stage_trades(spark: SparkSession, layout: Layout, csv: str) -> dict:
    """Parse a trades CSV once: routes ``good``, ``failed`` (an expectation) and ``bad`` (no parse), and counts."""
    return route_trades(read_trades_csv(spark, csv).parsed, layout)


def route_trades(parsed: DataFrame, layout: Layout) -> dict:
    """Store parsed trades once, by route; see ``stage_trades``."""
    checked = with_failed_rules(parsed.withColumn("trade_date", F.col("trade_date").try_cast("date")))
    route = F.when(F.col("_bad"), "bad").when(F.col("failed_rules").isNotNull(), "failed").otherwise("good")
    stored = materialize(checked.withColumn("_route", route), "trades", layout.staging)
    routes = {name: stored.filter(F.col("_route") == name).drop("_route", "_bad") for name in ("good", "failed", "bad")}
    counts = {r["_route"]: r["n"] for r in stored.groupBy("_route").agg(F.count(F.lit(1)).alias("n")).collect()}
    failures = routes["failed"].select(F.explode("failed_rules").alias("rule")).groupBy("rule").count().collect()
    return {
        "good": routes["good"].drop("failed_rules", CORRUPT_COL),
        "failed": routes["failed"].drop(CORRUPT_COL),
        "bad": routes["bad"].drop("failed_rules"),
        "n": counts,
        "failures": {r["rule"]: r["count"] for r in failures},
    }


def upsert_bronze(spark: SparkSession, layout: Layout, late: DataFrame, store: ColocatedLayers | None = None) -> list[date]:
    """Late or corrected trades into bronze, rewriting only the days they touch; returns those days.

    Touched days are the late rows' days plus the days currently holding any
    of their trade ids (a corrected timestamp can move a trade to another
    day).  Per trade id one row stays: a late row before a stored one, the
    latest time first, then the greatest row, so repeated late rows of one id
    give the same winner on every run.  The result is staged under the job's
    root and written with dynamic partition overwrite; touched days that end
    up empty are removed, every other day's files stay as they are.  Downstream
    layers are rebuilt from bronze as usual.  With ``store`` the touched days are
    dealt to its buckets again.
    """
    columns = BRONZE_SCHEMA.fieldNames()
    bronze = read_layer(spark, layout.bronze, BRONZE_SCHEMA).select(*columns)
    late = materialize(late.select(*columns), "late", layout.staging)
    moved_from = bronze.join(late.select("trade_id").distinct(), "trade_id", "left_semi").select("trade_date")
    touched = materialize(late.select("trade_date").unionByName(moved_from).distinct(), "touched", layout.staging)
    current = bronze.join(touched, "trade_date", "left_semi").withColumn("_late", F.lit(0))
    merged = current.unionByName(late.withColumn("_late", F.lit(1)))
    w = Window.partitionBy("trade_id").orderBy(
        F.col("_late").desc(), F.col("ts").desc(), F.struct(*[c for c in columns if c != "ts"]).desc())
    latest = merged.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_late")
    staged = materialize(latest, "bronze_upsert", layout.staging)
    days = [r["trade_date"] for r in touched.orderBy("trade_date").collect()]
    held = {r["trade_date"] for r in staged.select("trade_date").distinct().collect()}
    if store is None:
        write_layer(staged, layout.bronze, ["trade_date"], sort_by=["ts"], dynamic=True)
    else:
        store.replace_days(staged, counted_bars(staged))
    remove_partitions(spark, layout.bronze, [f"trade_date={d}" for d in days if d not in held])
    return days


def write_bars(bars: DataFrame, layout: Layout) -> None:
    write_layer(bars.withColumn("trade_date", F.to_date("ts_min")), layout.bars, ["trade_date"],
                sort_by=["symbol", "ts_min"])


def build_bars(spark: SparkSession, layout: Layout, report: JobReport | None = None, store: ColocatedLayers | None = None) -> None:
    """Bronze -> minute bars: the only pass over the trade volume before silver.

    Skipped when the ingest already stored them (events input).
    """
    if report is not None and report.bars_stored_by_ingest:
        return
    bronze = read_layer(spark, layout.bronze, BRONZE_SCHEMA)
    write_bars(minute_bars(bronze) if store is None else counted_bars(bronze), layout)
    if store is not None:
        store.plan(read_layer(spark, layout.bars, COUNTED_BAR_SCHEMA), keep_buckets=True)


def build_features(spark: SparkSession, layout: Layout) -> None:
    """Minute bars -> rolling features, stored once (read by thresholds and labels)."""
    bars = read_layer(spark, layout.bars, BAR_LAYER_SCHEMA).drop("trade_date")
    feats = bar_features(bars).withColumn("trade_date", F.to_date("ts_min"))
    write_layer(feats, layout.features, ["trade_date"], sort_by=["symbol", "ts_min"])


def build_silver(spark: SparkSession, layout: Layout, store: ColocatedLayers | None = None) -> None:
    """Features -> thresholds -> labelled bars -> labels on every trade.

    With ``store`` the bars join the trades bucket by bucket, and silver is
    written by the tasks that read them: the trades pass no exchange.
    """
    feats = read_layer(spark, layout.features, FEATURE_SCHEMA).drop("trade_date")
    bars = label_bars(feats, vol_thresholds(feats))
    if store is not None:
        store.write_bars(bars.select(*BAR_LABEL_COLUMNS))
        store.open_trades(BRONZE_SCHEMA)
        write_layer(store.silver(), layout.silver, ["trade_date", "symbol"], sort_by=["ts"], rebalance=False)
        return
    bronze = read_layer(spark, layout.bronze, BRONZE_SCHEMA)
    write_layer(attach_labels(bronze, bars), layout.silver, ["trade_date", "symbol"], sort_by=["ts"])


def build_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Silver -> the three gold tables from one GROUPING SETS pass over silver.

    The aggregated result (small) is stored once under the job's own root; the
    three tables and the leaderboard's input are cut from it.
    """
    silver = read_layer(spark, layout.silver, SILVER_SCHEMA)
    gold = gold_from_rollups(materialize(gold_rollups(silver), "gold_rollups", layout.staging))
    gold_b = rank_accounts(gold["perf"])
    write_layer(gold["gold_a"], layout.gold_regime, ["vol_regime"])
    write_layer(gold_b, layout.gold_ranking, ["vol_regime", "symbol"])
    write_layer(gold["gold_c"], layout.gold_daily, ["trade_date"])
    return {"agg_by_vol_regime": gold["gold_a"], "account_ranking_by_regime": gold_b,
            "daily_pnl_by_tier_trend": gold["gold_c"]}


def upsert_late_csv(spark: SparkSession, layout: Layout, report: JobReport, late_csv: str,
                    store: ColocatedLayers | None = None) -> None:
    """Late trades from a CSV through the same checks as the ingest, then an upsert into bronze."""
    staged = stage_trades(spark, layout, late_csv)
    upsert_bronze(spark, layout, staged["good"], store)
    staged["failed"].write.mode("append").parquet(layout.quarantine_expectations)
    staged["bad"].write.mode("append").parquet(layout.quarantine)
    n = staged["n"]
    report.counts.update({"late": n.get("good", 0), "late_quarantined": n.get("bad", 0) + n.get("failed", 0)})
    report.counts.update({f"failed_{k}": v for k, v in staged["failures"].items()})


def run_job(spark: SparkSession, root: str, csv: str | None = None, events_dir: str | None = None,
            late_csv: str | None = None, colocated: bool = False, **sizes: int) -> JobReport:
    """Run every stage; with ``late_csv`` the bronze stage is an upsert instead of a load.

    ``colocated`` stores bronze in buckets that the bars share
    (``plans.colocated``; ``sizes`` are its cell and bucket sizes); a warehouse
    loaded so is also updated so.
    """
    layout = Layout(root)
    report = JobReport()
    store = colocated_layers(spark, layout, **sizes) if colocated else None
    if late_csv is not None:
        bronze_stage = lambda: upsert_late_csv(spark, layout, report, late_csv, store)
    else:
        bronze_stage = lambda: ingest_bronze(spark, layout, report, csv=csv, events_dir=events_dir, store=store)
    stages = [
        ("bronze", bronze_stage),
        ("bars", lambda: build_bars(spark, layout, report, store)),
        ("features", lambda: build_features(spark, layout)),
        ("silver", lambda: build_silver(spark, layout, store)),
        ("gold", lambda: build_gold(spark, layout)),
    ]
    for name, stage in stages:
        t0 = time.perf_counter()
        stage()
        report.seconds[name] = round(time.perf_counter() - t0, 3)
    clear_staging(spark, layout)
    return report


def main(argv: list[str] | None = None) -> int:
    from tradeflow.plans.incremental import build_increments, refresh
    from tradeflow.session import make_session

    p = argparse.ArgumentParser(description="raw -> bronze -> features -> silver -> gold")
    p.add_argument("--root", required=True, help="root folder of the warehouse (any Hadoop URI)")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="headered trades CSV (file, folder or glob)")
    src.add_argument("--events", help="folder holding events.parquet (fixture adapter)")
    src.add_argument("--late", help="CSV of late/corrected trades to upsert into an existing bronze")
    p.add_argument("--by-delta", action="store_true",
                   help="keep what merges by day; with --late rebuild only what the file touches")
    p.add_argument("--colocated", action="store_true", help="bronze in buckets that the bars share")
    args = p.parse_args(argv)
    spark = make_session("tradeflow-job")
    t0 = time.perf_counter()
    if args.by_delta and args.late:
        report = refresh(spark, args.root, args.late)
    else:
        report = run_job(spark, args.root, csv=args.csv, events_dir=args.events, late_csv=args.late, colocated=args.colocated)
        if args.by_delta:
            build_increments(spark, Layout(args.root))
    print(f"[job] stages {report.seconds} counts {report.counts} total {time.perf_counter() - t0:.1f}s")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
