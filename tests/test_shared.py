"""Reports from the shared passes against the same reports over the trades."""

import pytest

from helpers import epoch, rows, trades
from lotwise.operators.shared import GRAINS, grain, grains, holders
from lotwise.plans.catalog import CHECKS, REPORTS, SHARED, build_reports, shared_builders


def planted(spark):
    """Nulls in every key, accounts that change their type, email or country, ties and trades without a close."""
    base = [
        {"login": login, "symbol": symbol, "type_account": kind, "email": email, "country_name": country, "profit": profit,
         "final_lot": lot, "breachedby": breached, "open_time": opened, "close_time": closed, "open_time_str": text, "starting_balance": balance}
        for login in (50000001, 50000002, None) for symbol in ("EURUSD", "US30", None)
        for kind, email, breached in (("Real 100K", "a@x", None), ("demo", None, "daily"), (None, "b@x", None), ("Real P2", "b@x", "max"))
        for country, profit, lot, balance in (("Norland", 5, 1, 900), (None, None, None, None), ("Sudland", 5, 2, 800), ("Norland", -3, 2, 900))
        for opened, closed, text in ((epoch("2024-08-22 00:10:00"), epoch("2024-08-22 00:10:02"), "2024-08-22 03:10:00"),
                                     (epoch("2024-08-22 22:30:00"), None, "2024-08-23 01:30:00"), (None, epoch("2024-08-22 01:30:00"), None))
    ]
    return trades(spark, base)


@pytest.fixture(scope="module", params=["planted", "empty"])
def both(request, spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("shared"))
    t = planted(spark)
    (t.limit(0) if request.param == "empty" else t).write.parquet(f"{root}/trades")
    t = spark.read.parquet(f"{root}/trades")
    grains(t).write.partitionBy("grain").parquet(f"{root}/grains")
    holders(t).write.parquet(f"{root}/holders")
    tables = [spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in (("grains", grains(t)), ("holders", holders(t)))]
    return f"{root}/trades", build_reports(t), {name: build() for name, build in shared_builders(t, *tables).items()}


@pytest.mark.parametrize("name", sorted(SHARED))
def test_shared_equals_direct(both, name):
    _, direct, shared = both
    assert shared[name].dtypes == direct[name].dtypes
    # the sample's rows are compared by the test of the daily job
    assert rows(shared[name]) == rows(direct[name])


def test_one_scan_and_one_expand(spark, both):
    path, *_ = both
    t = spark.read.parquet(path)
    plan = grains(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan
    assert {r.grain for r in grains(t).select("grain").distinct().collect()} <= set(GRAINS)
    assert set(GRAINS["open_hour"]) <= set(grain(grains(t), "open_hour").columns)


def test_scans_of_the_trades_in_a_report_set(spark, both):
    path, _, shared = both
    checks = [check(spark.read.parquet(path)) for check in CHECKS.values()]

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
        return sum("FileScan parquet" in line and path in line for line in plan.splitlines())

    assert all(scans(shared[name]) == 0 for name in set(SHARED) - {"high_pnl_traders_real"})
    # the exposure stores its legs while it is described: one more; two for the shared passes
    found = {name: scans(df) for name, df in shared.items() if scans(df)}
    assert set(found) <= {"high_pnl_traders_real", "login_trade_lot_real", "login_trade_lot_p2", "exposure_combined"}
    assert sum(found.values()) + sum(map(scans, checks)) + 1 + 2 <= 8, found
    assert len(REPORTS) == 29
