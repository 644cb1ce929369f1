import random

import pytest

from helpers import rows
from lotwise.functions.clock import day_bounds, in_window
from lotwise.operators.extract import enrich
from lotwise.schemas import TRADES
from lotwise.sources.history import day_number, read_history, read_history_tables, write_history
from lotwise.sources.sample import sample_tables
from lotwise.sources.tables import BrokerTables, TABLE_SCHEMAS

DAY = 86400


def trades(spark, times):
    """Trades with these open and close times."""
    full = [tuple({"id": i, "open_time": o, "close_time": c, "login": i % 3, "symbol": "EURUSD"}.get(n) for n in TRADES.names)
            for i, (o, c) in enumerate(times)]
    return spark.createDataFrame(full, TRADES)


def scans(df):
    """Metrics of the file scans of a plan that has been run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = []
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        found.append({name: metrics.get(name).get().value() for name in ("numFiles", "numPartitions")})
    return found


@pytest.fixture(scope="module")
def year(spark, tmp_path_factory):
    """A year of trades, some of them open for months, still open, without times, or far outside the year."""
    rng = random.Random(7)
    times = []
    for _ in range(3000):
        opened = rng.randrange(365 * DAY)
        times.append((opened, opened + rng.choice([0, 60, 3600, 2 * DAY, 90 * DAY])))
    times += [(40 * DAY + k, 0) for k in range(5)] + [(40 * DAY, None), (None, 40 * DAY), (None, None), (41 * DAY, 40 * DAY)]
    times += [(-1, 40 * DAY + 1), (-DAY, -1), (-DAY - 1, -DAY), (40 * DAY + 5, 10**12), (10**12, 40 * DAY + 5)]
    times += [(40 * DAY - 1, 40 * DAY), (40 * DAY - 1, 41 * DAY), (40 * DAY, 41 * DAY - 1), (40 * DAY, 40 * DAY)] * 2
    df = trades(spark, times)
    root = str(tmp_path_factory.mktemp("year"))
    write_history(df, root)
    return df, root


@pytest.mark.parametrize("window", [
    (40 * DAY, 41 * DAY - 1), (40 * DAY + 100, 40 * DAY + 40_000), (39 * DAY + 5, 43 * DAY + 7), (0, 0), (-2 * DAY, -1),
    (40 * DAY, 40 * DAY), (0, 400 * DAY), (500 * DAY, 501 * DAY), (10**12, 10**12),
])
def test_a_window_of_the_history_equals_the_filter(spark, year, window):
    df, root = year
    got = read_history(spark, root, window)
    assert got.columns == TRADES.names
    assert rows(got) == rows(df.where(in_window(*window)))


def test_a_day_opens_its_own_files_only(spark, year):
    _, root = year
    got = read_history(spark, root, (40 * DAY, 41 * DAY - 1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "open_day" in plan.split("PartitionFilters")[1] and "close_day" in plan.split("PartitionFilters")[2]
    found = scans(got)
    assert [s["numPartitions"] for s in found] == [1, 1]
    assert all(s["numFiles"] <= 2 for s in found)


def test_the_history_is_replaced_and_may_be_empty(spark, tmp_path):
    root = str(tmp_path / "history")
    write_history(trades(spark, [(5, 10), (5, 2 * DAY)]), root)
    write_history(trades(spark, [(7, 8)]), root)
    assert [(r.open_time, r.close_time) for r in read_history(spark, root, (0, 9 * DAY)).collect()] == [(7, 8)]
    write_history(trades(spark, []), root)
    assert read_history(spark, root, (0, 9 * DAY)).count() == 0


def test_a_hot_day_is_written_by_many_tasks(spark, tmp_path):
    root = tmp_path / "history"
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_history(trades(spark, [(40 * DAY + k % 50, 40 * DAY + 60) for k in range(2000)]), str(root))
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert len(list((root / "opened" / "open_day=40").glob("*.parquet"))) == 8


def test_days_are_exact(spark):
    seconds = [0, -1, -DAY, -DAY - 1, DAY - 1, DAY, 2**60 + 1, -(2**60) - 1]
    got = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(day_number("s").alias("day")).collect()
    assert [r.day for r in got] == [s // DAY for s in seconds]


def test_enriched_trades_of_the_history(spark, tmp_path):
    tables, root, window = sample_tables(spark, "/root/testdata/sf0.001"), str(tmp_path), day_bounds("2024-01-15")
    for name in TABLE_SCHEMAS:
        if name != "trades":
            getattr(tables, name).write.parquet(f"{root}/{name}")
    write_history(tables.trades, f"{root}/history")
    got = read_history_tables(spark, root, window)
    assert isinstance(got, BrokerTables)
    expected = rows(enrich(tables, window))
    assert rows(enrich(got, window)) == rows(enrich(got, window, 10)) == expected and expected
