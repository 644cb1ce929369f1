"""Exposure against a direct reading of its definition."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from helpers import epoch, rows, trades
from lotwise.operators.exposure import exposure_breaches, max_exposure
from lotwise.operators.lineage import stored
from lotwise.plans.exposure_days import exposure_of_segments, store_segment
from lotwise.plans.exposures import class_exposure, exposure_combined

ANY = {"Forex": (0, None)}


def peak(legs):
    """Largest sum of |net lots| over the trades live whenever one opens."""
    legs = sorted(legs, key=lambda t: (t["open_time"], t["id"]))
    best = Decimal(0)
    for i, new in enumerate(legs):
        nets = defaultdict(Decimal)
        for j in range(i + 1):
            old = legs[j]
            if j == i or (old["close_time"] or 0) >= new["open_time"]:
                lot = Decimal(str(old["final_lot"]))
                nets[old["symbol"]] += lot if (old["type_str"] or "").lower() == "buy" else -lot
        best = max(best, sum(abs(n) for n in nets.values()))
    return best


def random_legs(login, seed, start_id):
    rng = random.Random(seed)
    span = rng.choice([3, 10, 200, 200_000])
    base = 1724284000
    out = []
    for n in range(rng.randint(1, 40)):
        opened = base + rng.randint(0, span)
        kind = rng.random()
        if kind < 0.15:
            closed = rng.choice([None, 0, 10800])
        elif kind < 0.3:
            closed = opened
        else:
            closed = opened + rng.randint(0, span)
        out.append({
            "id": start_id + n, "login": login, "open_time": opened, "close_time": closed,
            "symbol": rng.choice(["EURUSD", "GBPUSD", "USDJPY"]),
            "type_str": rng.choice(["Buy", "buy", "SELL", "balance", None]),
            "final_lot": rng.choice(["0.01", "0.1", "1", "2.5", "7.125"]),
        })
    return out


@pytest.fixture(scope="module")
def random_case(spark):
    # a long tail and a burst within a second or two in one login
    burst = random_legs(500, 7, 900_000) + [
        dict(leg, login=500, open_time=1724284000 + n % 2, close_time=1724284000 + n % 5)
        for n, leg in enumerate(leg for seed in range(6) for leg in random_legs(500, seed, 910_000 + seed * 100))
    ]
    legs = [leg for login in range(1, 121) for leg in random_legs(login, login, login * 1000)] + burst
    by_login = defaultdict(list)
    for leg in legs:
        by_login[leg["login"]].append(leg)
    return trades(spark, legs).cache(), {login: peak(items) for login, items in by_login.items()}


@pytest.mark.parametrize("options", [
    {},  # every login in one window
    {"hot_trades": 0},  # every login sliced, but in one slice
    {"hot_trades": 0, "slice_trades": 3, "block_bits": 2},  # a few trades per slice
    {"hot_trades": 0, "slice_trades": 1, "block_bits": 0},  # dense slices cut down to single ids
    {"hot_trades": 20, "slice_trades": 5, "block_bits": 1},  # whole and sliced logins side by side
])
def test_matches_the_definition(random_case, options):
    df, expected = random_case
    got = {r.login: r.max_total_lots for r in max_exposure(df, ANY, **options).collect()}
    assert got == expected


def one(spark, legs, **options):
    return max_exposure(trades(spark, legs), ANY, **options).first().max_total_lots


@pytest.mark.parametrize("hot", [10, 0])
def test_hand_made_cases(spark, hot):
    t = 1724284000
    hedge = [
        {"open_time": t, "close_time": t + 10, "type_str": "Buy", "final_lot": 5},
        {"open_time": t + 1, "close_time": t + 100, "type_str": "SELL", "final_lot": 5},
    ]
    assert one(spark, hedge, hot_trades=hot) == 5
    # the buy leg closes; the next open sees the uncovered sell
    later = {"open_time": t + 50, "close_time": t + 60, "symbol": "GBPUSD", "final_lot": 1}
    assert one(spark, hedge + [later], hot_trades=hot) == 6
    # a close in the second of the next open still counts
    touching = [
        {"open_time": t, "close_time": t + 5, "final_lot": 2},
        {"open_time": t + 5, "close_time": t + 9, "final_lot": 2},
    ]
    assert one(spark, touching, hot_trades=hot) == 4
    # an unclosed trade counts at its own open only
    unclosed = [
        {"open_time": t, "close_time": None, "final_lot": 3},
        {"open_time": t, "close_time": t + 9, "final_lot": 2},
    ]
    assert one(spark, unclosed, hot_trades=hot) == 3
    # any side but buy is short
    other = [
        {"open_time": t, "close_time": t + 9, "type_str": "balance", "final_lot": 2},
        {"open_time": t, "close_time": t + 9, "type_str": None, "final_lot": 2},
    ]
    assert one(spark, other, hot_trades=hot) == 4


def test_first_trade_gives_the_account_columns(spark):
    df = trades(spark, [
        {"id": 5, "equity": None, "type_account": None, "final_lot": 80, "breachedby": None, "open_time": 1724284009},
        {"id": 6, "equity": 7, "type_account": "Real", "final_lot": 80, "breachedby": "x", "open_time": 1724284000},
    ])
    for hot in (10, 0):
        row = exposure_breaches(df, hot_trades=hot).first()
        assert (row.equity, row.package_type, row.breachedby, row.pnl) == (None, None, None, None)


def test_only_watched_symbols_and_thresholds(spark):
    df = trades(spark, [
        {"login": 1, "symbol": "XAUUSD", "final_lot": 18}, {"login": 2, "symbol": "XAUUSD", "final_lot": "17.999"},
        {"login": 3, "symbol": "XAGUSD", "final_lot": 500}, {"login": 4, "symbol": "US30", "final_lot": 7},
        {"login": 5, "symbol": "AUDUSD", "final_lot": 500}, {"login": 6, "symbol": "EURUSD", "final_lot": 70},
        {"login": 7, "symbol": "BTCUSD", "final_lot": 3}, {"login": 8, "symbol": "ETHUSD", "final_lot": 500},
        {"login": 9, "symbol": "ABC", "final_lot": 500},
    ])
    found = {(r.asset_class, r.login) for r in exposure_breaches(df).collect()}
    assert found == {("Commodities", 1), ("Indices", 4), ("Forex", 6), ("Crypto", 7)}
    assert [r.login for r in class_exposure(df, "Crypto").collect()] == [7]


def test_combined_aligns_by_position(spark):
    df = trades(spark, [
        {"login": 9, "symbol": "XAUUSD", "final_lot": 20}, {"login": 3, "symbol": "XAUUSD", "final_lot": 30},
        {"login": 5, "symbol": "BTCUSD", "final_lot": 4},
    ])
    got = {r.position: r for r in exposure_combined(df).collect()}
    assert (got[1].commodities_login, got[1].crypto_login, got[1].forex_login) == (3, 5, None)
    assert (got[2].commodities_login, got[2].crypto_login) == (9, None)
    assert got[2].commodities_max_total_lots == 20.0
    assert len(got) == 2 and len(got[1]) == 25


@pytest.mark.parametrize("options", [{}, {"hot_trades": 20, "slice_trades": 5, "block_bits": 1}])
def test_chained_segments_equal_one_run(spark, random_case, tmp_path, options):
    df, expected = random_case
    # cuts within the bursts, within a second's neighbours, and at a time without trades
    cuts = ["2024-08-21 00:00:00", "2024-08-21 23:46:42", "2024-08-21 23:46:43", "2024-08-22 12:00:00", "2024-08-30 00:00:00"]
    for number, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        store_segment(df, str(tmp_path), start, end, opening=number == 0, limits=ANY, **options)
    got = exposure_of_segments(spark, str(tmp_path), cuts[:-1], ANY)
    assert {r.login: Decimal(str(r.max_total_lots)) for r in got.collect()} == expected
    assert rows(got) == rows(exposure_breaches(df, ANY))
    # a segment stored again changes nothing, and no segment starts without the nets of the one before
    store_segment(df, str(tmp_path), cuts[1], cuts[2], limits=ANY, **options)
    assert rows(exposure_of_segments(spark, str(tmp_path), cuts[:-1], ANY)) == rows(got)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store_segment(df, str(tmp_path), "2024-09-09", "2024-09-10", limits=ANY)


def test_a_segment_reads_only_its_own_trades(spark, tmp_path):
    t = epoch("2024-08-21 12:00:00")
    held = {"id": 1, "open_time": t, "close_time": t + 5 * 86400, "final_lot": 4}
    over = {"id": 2, "open_time": t + 86400, "close_time": t + 86500, "final_lot": 3}
    root = str(tmp_path)
    store_segment(trades(spark, [held]), root, "2024-08-21", "2024-08-22", opening=True, limits=ANY)
    store_segment(trades(spark, [over]), root, "2024-08-22", "2024-08-23", limits=ANY)
    assert [r.max_total_lots for r in exposure_of_segments(spark, root, ["2024-08-22"], ANY).collect()] == [7.0]


def test_without_a_hot_login_the_legs_are_read_three_times(spark, random_case, tmp_path):
    df, _ = random_case
    plan = max_exposure(df, ANY, stage=stored)._jdf.queryExecution().optimizedPlan().toString()
    # the walk and the account data; the third is the search for hot logins, done by now
    assert plan.count("Relation [") == 2
    assert plan.count("Window [") == 2
    walked = plan[plan.index("Window ["):]
    assert "breachedby" not in walked[:walked.index("Relation [")]
