"""Shape of the physical plans: what must hold at any size of the data."""

import re

import pytest

import __spark_entry__ as registry
from lotwise.functions.clock import day_bounds, normalize_times
from lotwise.operators.cells import as_cells
from lotwise.operators.extract import enrich, extract_trades
from lotwise.operators.exposure import exposure_legs, max_exposure
from lotwise.plans import behaviour, hours, symbols
from lotwise.plans.catalog import REPORTS
from lotwise.sources.sample import sample_tables
from lotwise.sources.tables import TABLE_SCHEMAS, read_parquet_tables

SF = "/root/testdata/sf0.001"
QUERIES = registry.trade_queries()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("broker"))
    sample = sample_tables(spark, SF)
    for name in TABLE_SCHEMAS:
        getattr(sample, name).write.parquet(f"{root}/{name}")
    return read_parquet_tables(spark, root)


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("enriched"))
    normalize_times(enrich(tables)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_window_and_columns_reach_the_scan(tables):
    plan = physical(extract_trades(tables.trades, day_bounds("2024-01-15")).select("id", "login"))
    assert "Or(And(GreaterThanOrEqual(open_time," in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "profit" not in scan and "open_time_str" not in scan


def test_reports_read_their_columns_only(stored):
    plan = physical(symbols.swap_summary(as_cells(stored)))
    assert "ReadSchema: struct<login:bigint,symbol:string,swap:decimal(18,6)>" in plan


def final(df) -> str:
    """The plan that ran, after adaptive execution."""
    df.collect()
    return physical(df).partition("== Final Plan ==")[2].partition("== Initial Plan ==")[0]


def test_exposure_without_hot_logins_reads_the_trades_twice(stored):
    plan = final(max_exposure(stored))
    # the pass that found no hot login has left the plan, with all that depends on it
    assert plan.count("FileScan parquet") == 1
    # one exchange and two sorts for the windows
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Window [") == 2


def test_exposure_stores_its_legs_narrow(stored):
    assert "tp" not in exposure_legs(stored).columns and len(exposure_legs(stored).columns) == 11


def test_top_per_group_is_cut_before_its_shuffle(stored):
    plan = physical(symbols.top_logins(as_cells(stored)))
    assert plan.count("WindowGroupLimit") == 2


def aggregates_on_a_scan(plan: str) -> set[str]:
    """Names of the aggregates that read a scan with nothing but row-wise steps in between."""
    found, below = set(), None
    for line in reversed(plan.splitlines()):
        name = re.sub(r"^[\s:|+\-]*(\*\(\d+\) )?", "", line)
        kind = re.match(r"\w+", name)[0] if re.match(r"\w+", name) else ""
        if kind in ("FileScan", "Scan"):
            below = "scan"
        elif kind in ("HashAggregate", "SortAggregate", "ObjectHashAggregate"):
            if below == "scan":
                found.add(kind)
            below = kind
        elif kind not in ("ColumnarToRow", "Filter", "Project", "Sort", "Generate"):
            below = kind
    return found


# they describe trades of a few top logins, or carry the text of a first trade
SORTING = {"high_pnl_traders_real", "login_trade_lot_real", "login_trade_lot_p2", "exposure_combined"}


@pytest.mark.parametrize("name", sorted(set(REPORTS) - SORTING))
def test_whole_reports_aggregate_the_trades_by_hash(stored, name):
    assert "SortAggregate" not in aggregates_on_a_scan(physical(REPORTS[name](stored, as_cells(stored))))


def test_hour_report_reads_the_trades_twice(stored):
    plan = physical(hours.open_hour_summary(stored))
    assert plan.count("FileScan parquet") == 2


def test_global_top_n_needs_no_full_sort(stored):
    text = physical(behaviour.hft_summary(stored))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
