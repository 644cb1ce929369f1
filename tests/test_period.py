"""Stored days merged to periods against the same reports over the trades of all days."""

import pytest
from pyspark.sql import functions as F

from helpers import epoch, rows, trades
from lotwise.functions.clock import normalize_times
from lotwise.operators.extract import enrich
from lotwise.operators.shared import GRAINS, PARTS, grain, grains, holders, merged_grains, merged_holders, parted_grains, whole_grains
from lotwise.plans.catalog import REPORTS, TRADELESS, build_reports
from lotwise.plans.period import period_builders, read_days, store_days
from lotwise.sources.sample import sample_tables

DAYS = ["2024-08-20", "2024-08-21", "2024-08-22"]


@pytest.fixture(scope="module")
def stored_days(spark, tmp_path_factory):
    """Accounts whose balance, equity, type and country change between days, with ids in another order than the days."""
    base = []
    for number in range(400):
        day = DAYS[number * 7 % 3]
        opened = epoch(f"{day} {number % 24:02}:10:00")
        base.append({
            "id": 1000 - number, "login": (50000001, 50000002, 50000003, None)[number % 4], "symbol": ("EURUSD", "US30", None)[number % 3],
            "open_time": opened, "close_time": (opened + number % 5, opened + 86400, None)[number % 3], "open_time_str": f"{day} {number % 24:02}:10:00",
            "equity": (number, None)[number % 11 == 0], "starting_balance": (900, 800, None)[number % 5 % 3],
            "type_account": ("Real 100K", "demo", "Real P2")[number % 13 % 3], "email": ("a@x", None)[number % 17 == 0],
            "country_name": ("Norland", "Sudland", None)[number % 19 % 3], "breachedby": (None, "daily")[number % 6 == 0],
            "profit": (number % 23 - 8, None)[number % 29 == 0], "final_lot": (number % 7, None)[number % 31 == 0],
        })
    base.append({"id": 5, "open_time": None, "close_time": epoch("2024-08-21 10:00:00"), "profit": 10**6})
    root = str(tmp_path_factory.mktemp("days"))
    trades(spark, base).write.parquet(f"{root}/trades")
    t = spark.read.parquet(f"{root}/trades")
    store_days(t, f"{root}/sums")
    return t, f"{root}/sums"


def test_merged_days_equal_one_run(spark, stored_days):
    t, root = stored_days
    t = t.where("open_time IS NOT NULL")
    summed, accounts = read_days(spark, root)
    for got, expected in ((summed, grains(t)), (accounts, holders(t))):
        got = got.select(*expected.columns)
        assert got.dtypes == expected.dtypes
        assert rows(got) == rows(expected)
    assert {r.grain for r in summed.select("grain").distinct().collect()} == set(GRAINS)
    # merging what is merged changes nothing
    assert rows(merged_grains(summed)) == rows(summed) and rows(merged_holders(accounts)) == rows(accounts)


@pytest.mark.parametrize("period", [(None, None), ("2024-08-21", "2024-08-22"), ("2024-08-20", "2024-08-20"), ("2024-09-01", None)])
def test_reports_of_a_period(spark, stored_days, period):
    t, root = stored_days
    first, last = period
    inside = F.to_date("open_time").between(F.lit(first or "0001-01-01").cast("date"), F.lit(last or "9999-12-31").cast("date"))
    direct = build_reports(t.where(inside))
    got = period_builders(spark, root, first, last)
    assert set(got) == set(TRADELESS) < set(REPORTS) and len(got) == 25
    for name in ("positive_pnl_traders", "arbitrage_traders", "hft_summary", "symbol_summary", "open_hour_summary_real", "pairwise_summary_demo"):
        assert rows(got[name]()) == rows(direct[name]), name


def test_a_day_is_stored_again_alone(spark, stored_days, tmp_path):
    t, _ = stored_days
    root = str(tmp_path / "sums")
    store_days(t.where("date(open_time) <> date'2024-08-21'"), root)
    store_days(t.where("date(open_time) = date'2024-08-21' AND profit > 0"), root)
    store_days(t.where("date(open_time) = date'2024-08-21'"), root)
    summed, accounts = read_days(spark, root)
    known = t.where("open_time IS NOT NULL")
    assert rows(grain(summed, "balance").select("real", "login", "starting_balance", "profit", "last_id", "last_equity")) == rows(
        grain(grains(known), "balance").select("real", "login", "starting_balance", "profit", "last_id", "last_equity"))
    assert rows(accounts.select("login", "forward_id", "forward_equity")) == rows(holders(known).select("login", "forward_id", "forward_equity"))


def test_a_period_opens_its_own_days(spark, stored_days):
    _, root = stored_days
    summed, _ = read_days(spark, root, "2024-08-21", "2024-08-21")
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "open_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_days_of_the_sample(spark, tmp_path):
    t = normalize_times(enrich(sample_tables(spark, "/root/testdata/sf0.001")))
    store_days(t, str(tmp_path / "sums"))
    got, direct = period_builders(spark, str(tmp_path / "sums")), build_reports(t)
    for name in ("positive_pnl_traders", "swap_summary", "top_lots_per_trade_real"):
        assert rows(got[name]()) == rows(direct[name]), name


def test_parts_of_sums_are_exact(spark, tmp_path):
    day, most = epoch("2024-08-20 10:00:00"), 999999999999.999999
    amounts = [(f"{sign}{units}", lot) for sign in ("", "-") for units in ("999999999999.999999", "0.000001", "1073.741824", "0") for lot in ("0.01", None)]
    base = [{"id": n, "login": 50000001 + n % 2, "symbol": "EURUSD", "open_time": day + n * 86400 % 200000, "close_time": day} for n in range(40 * len(amounts))]
    plain = trades(spark, base)
    picked = F.element_at(F.array(*[F.lit(profit).cast("decimal(18,6)") for profit, _ in amounts], F.lit(None).cast("decimal(18,6)")), (F.col("id") % 17 + 1).cast("int"))
    t = plain.withColumns({"profit": picked, "swap": -picked, "final_lot": F.when(F.col("id") % 3 > 0, picked)})
    whole, expected = whole_grains(parted_grains(t)), grains(t)
    assert whole.dtypes == expected.dtypes and rows(whole) == rows(expected)
    assert max(r.positive_profit for r in expected.collect()) > 20 * int(most)
    store_days(t, str(tmp_path / "sums"))
    stored = spark.read.parquet(str(tmp_path / "sums/grains"))
    assert set(PARTS) <= set(stored.columns) and "profit" not in stored.columns
    assert rows(read_days(spark, str(tmp_path / "sums"))[0].select(*expected.columns)) == rows(expected)


def test_days_are_stored_without_a_sample_of_their_sums(spark, stored_days, tmp_path):
    t, _ = stored_days
    groups, tracker = "store-days", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(groups, "")
    try:
        store_days(t, str(tmp_path / "sums"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # a pass: its sums, their exchange, and the files; ranges took a job more to sample the sums
    assert len(tracker.getJobIdsForGroup(groups)) == 6
