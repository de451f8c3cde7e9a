"""The kept leaderboard equals the ranking after any change, and reads and writes its own ranges only."""

from __future__ import annotations

import glob
import os
import random

from tradeflow.operators import rank_accounts
from tradeflow.plans import partition_filters
from tradeflow.plans.lineage import materialize
from tradeflow.plans.rank_index import RankIndex, changed_rows
from tests.test_incremental import same

DDL = ("account_id string, tier string, vol_regime string, symbol string, n_trades long, total_pnl double, "
       "gross_notional double, total_fees double")


def rows(seed):
    rnd = random.Random(seed)
    out = []
    for regime, symbol, n in (("high", "a", 300), ("high", "b", 40), ("low", "a", 1), ("low", None, 25), (None, "a", 10)):
        for i in range(n):
            value = None if rnd.random() < 0.05 else float(rnd.randint(0, 40))  # many ties
            out.append((f"A{i:04d}", rnd.choice(["x", "y"]), regime, symbol, 1, value, 2.0, 0.5))
        out.append((None, "x", regime, symbol, 1, 7.0, 2.0, 0.5))
    return out


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*/*/*.parquet")}


def test_index_follows_changes(spark, scratch_dir):
    now = {r[0:4]: r for r in rows(1)}
    frame = lambda rs: spark.createDataFrame(list(rs), DDL)
    index = RankIndex(spark, scratch_dir, range_rows=20)
    index.build(frame(now.values()))
    assert same(index.ranking(), rank_accounts(frame(now.values()), range_rows=None))

    def apply(changes, removed=()):
        gone = [now[k] for k in {*changes, *removed} if k in now]
        for k in removed:
            del now[k]
        now.update(changes)
        n = index.change(frame(gone), frame(changes.values()))
        assert same(index.ranking(), rank_accounts(frame(now.values()), range_rows=None))
        return n

    # one account moves from one place to another: two ranges of one group at most
    key = next(k for k in now if k[2] == "high" and k[3] == "b" and now[k][5] is not None)
    before = files(index.rows_path)
    assert apply({key: (*now[key][:5], 1000.0, 2.0, 0.5)}) <= 2
    after = files(index.rows_path)
    assert {f.split("/part-")[0] for f in before.items() ^ after.items() for f in [f[0]]} <= {
        f"{index.rows_path}/vol_regime=high/symbol=b/_range={n}" for n in range(200)}
    assert sum(before[f] == after.get(f) for f in before) >= len(before) - 2
    # a group grows fivefold and its ranges are cut, another group goes, a new one comes
    grown = {(f"N{i}", "x", "high", "b"): (f"N{i}", "x", "high", "b", 1, float(i % 7), 2.0, 0.5) for i in range(200)}
    apply(grown)
    assert index.ranges.filter("_n > 40 AND vol_regime = 'high' AND symbol = 'b'").count() == 0
    apply({("Z", "x", "new", "c"): ("Z", "x", "new", "c", 1, None, 2.0, 0.5)}, [k for k in now if k[2] is None])
    assert not glob.glob(f"{index.rows_path}/vol_regime=__HIVE_DEFAULT_PARTITION__/*/*/*.parquet")
    # the best ten come from the first ranges
    best = index.top("high", "a", 10)
    want = rank_accounts(frame(now.values()), range_rows=None).filter("vol_regime = 'high' AND symbol = 'a' AND pnl_row_num <= 10")
    assert same(best, want.drop("cumulative_pnl"))
    assert any("_range" in f for f in partition_filters(best))
    assert len(index.first_ranges("high", "a", 10)) <= 2 < index.ranges.filter("vol_regime = 'high' AND symbol = 'a'").count()


def test_changed_rows_and_empty_index(spark, scratch_dir):
    some = materialize(spark.createDataFrame(rows(2)[:30], DDL), "some")
    gone, new = changed_rows(some, some.limit(0))
    assert gone.count() == 30 and new.count() == 0
    index = RankIndex(spark, scratch_dir)
    index.build(some.limit(0))
    assert index.ranking().count() == 0 and index.top("high", "a").count() == 0
    index.change(some.limit(0), some)
    assert same(index.ranking(), rank_accounts(some, range_rows=None))
