import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from helpers import epoch, raw_trades, rows
from lotwise.functions.clock import day_bounds, normalize_times
from lotwise.operators.extract import enrich, extract_accounts, extract_trades
from lotwise.operators.joins import are_small
from lotwise.plans.catalog import CHECKS, REPORTS, build_reports
from lotwise.plans.daily import run_csv_day, run_day
from lotwise.schemas import ENRICHED, MONEY
from lotwise.sources.enriched import (
    CSV_NAMES, CSV_OPTIONAL, read_enriched, read_enriched_csv, split_enriched_csv, write_enriched, write_enriched_csv,
)
from lotwise.sources.reports import read_report, report_names, write_reports
from lotwise.sources.sample import sample_tables
from lotwise.sources.tables import TABLE_SCHEMAS, conform, count_tables, read_jdbc_tables, read_parquet_tables

SF = "/root/testdata/sf0.001"


FULL_HEADER = [CSV_NAMES.get(f.name, f.name) for f in ENRICHED.fields]


def write_csv(path, names, *lines, drop=()):
    """A CSV file with the columns in ``names`` first and the others after them, empty."""
    rest = [n for n in FULL_HEADER if n not in names and n not in drop]
    body = "".join(line + "," * len(rest) + "\n" for line in lines)
    path.write_text(",".join([*names, *rest]) + "\n" + body)
    return str(path)


def test_csv_null_spellings_times_and_report_date(spark, tmp_path):
    names = "id,login,symbol,open_time,close_time,open_time_str,profit,FinalLot,type_account,email,breachedby,volume".split(",")
    path = write_csv(
        tmp_path / "trades_filtered_2024-08-22.csv", names,
        "1,70001,EURUSD,1724284700,1724284800.0,2024-08-22 03:00:00,1.50,0.010,Real,None,,100",
        "2,70002,NA,1724284700,x,2024-08-22 03:00:00,NA,2,null,a@example.com,N/A,5.0",
        '3,70003,"US30",1724284700,,2024-08-22 03:00:00,-2,2,"Real, 50K",a@example.com,daily,7',
    )
    df = read_enriched_csv(spark, path)
    got = df.orderBy("id").collect()
    assert [r.report_date for r in got] == ["2024-08-22"] * 3
    assert [r.email for r in got] == [None, "a@example.com", "a@example.com"]
    assert [r.symbol for r in got] == ["EURUSD", None, "US30"]
    assert [r.breachedby for r in got] == [None, None, "daily"]
    assert [r.type_account for r in got] == ["Real", None, "Real, 50K"]
    assert [r.volume for r in got] == [100, 5, 7]
    assert [r.holding_time for r in normalize_times(df).orderBy("id").collect()] == [100, -1724284700, -1724284700]


def test_csv_without_a_date_in_its_name(spark, tmp_path):
    row = read_enriched_csv(spark, write_csv(tmp_path / "trades with classes.csv", ["id", "login"], "1,2")).first()
    assert (row.report_date, row.id, row.login, row.profit) == (None, 1, 2, None)


def test_csv_columns_are_matched_by_name_in_every_file(spark, tmp_path):
    write_csv(tmp_path / "a_2024-08-21.csv", ["id", "login", "symbol"], "1,70001,EURUSD")
    write_csv(tmp_path / "b_2024-08-22.csv", ["login", "id", "symbol"], "70002,2,US30", drop=("tp",))
    got = {(r.id, r.login, r.symbol, r.report_date) for r in read_enriched_csv(spark, str(tmp_path)).collect()}
    assert got == {(1, 70001, "EURUSD", "2024-08-21"), (2, 70002, "US30", "2024-08-22")}


def test_csv_without_a_needed_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="FinalLot.*profit|profit.*FinalLot"):
        read_enriched_csv(spark, write_csv(tmp_path / "x.csv", ["id"], "1", drop=("profit", "FinalLot")))
    write_csv(tmp_path / "y.csv", ["id"], "1", drop=CSV_OPTIONAL)
    assert read_enriched_csv(spark, str(tmp_path / "y.csv")).first().volume is None


def test_csv_amounts_are_kept_or_refused(spark, tmp_path):
    row = read_enriched_csv(spark, write_csv(tmp_path / "a.csv", ["profit", "FinalLot"], "1.005,0.0004")).first()
    assert (row.profit, row.final_lot) == (Decimal("1.005"), Decimal("0.0004"))
    with pytest.raises(Exception, match="column profit"):
        read_enriched_csv(spark, write_csv(tmp_path / "b.csv", ["profit"], "1.00000049")).collect()


def test_csv_quotes_and_backslashes(spark, tmp_path):
    texts = ['a "b" c', 'x, y\\', '"', '\\"', "it's", ' a ']
    df = raw_trades(spark, [{"id": i, "email": t} for i, t in enumerate(texts)])
    write_enriched_csv(df, str(tmp_path / "out"))
    assert [r.email for r in read_enriched_csv(spark, str(tmp_path / "out")).orderBy("id").collect()] == texts
    line = '1,"a ""b"" c"'
    assert read_enriched_csv(spark, write_csv(tmp_path / "z.csv", ["id", "email"], line)).first().email == 'a "b" c'


def test_csv_round_trip(spark, tmp_path):
    df = enrich(sample_tables(spark, SF))
    path = str(tmp_path / "trades")
    write_enriched_csv(df, path)
    names = [f.name for f in ENRICHED.fields]
    back = read_enriched_csv(spark, path).select(*names)
    expected = df.select(*[F.col(c).cast("string") if c.endswith("_time") else F.col(c) for c in names])
    assert back.dtypes == expected.dtypes
    assert back.exceptAll(expected).count() == 0 and back.count() == df.count()


def test_headers_of_many_files_are_found_by_one_job(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    for n in range(30):
        first = ["id", "login", "symbol"] if n % 3 else ["symbol", "login", "id"]
        cells = f"{n},7,EURUSD" if n % 3 else f"EURUSD,7,{n}"
        write_csv(folder / f"part {n} 100%25_2024-08-{n % 28 + 1:02}.csv", first, cells, cells)
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n\n")
    quoted = ",".join(f'"{name}"' for name in FULL_HEADER)
    (folder / "quoted_2024-08-30.csv").write_text(f"\n{quoted}\n" + "99" + "," * (len(FULL_HEADER) - 1) + "\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    df = read_enriched_csv(spark, str(folder))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("rows", "rows")
    got = df.select("id", "login", "symbol", "report_date").collect()
    assert sorted(r.id for r in got) == sorted([*range(30)] * 2 + [99])
    assert {r.symbol for r in got if r.id < 99} == {"EURUSD"}
    assert {r.report_date for r in got if r.id == 29} == {"2024-08-02"}
    # the listing of the files, the headers, the files without one
    assert jobs <= 6


def test_a_column_that_comes_twice_is_refused(spark, tmp_path):
    path = tmp_path / "a_2024-08-21.csv"
    path.write_text(",".join([*FULL_HEADER, "Login"]) + "\n")
    with pytest.raises(ValueError, match="login.*a_2024-08-21"):
        read_enriched_csv(spark, str(tmp_path))


def test_enriched_table_replaces_one_date_only(spark, tmp_path):
    path = str(tmp_path / "enriched")
    first, second = raw_trades(spark, [{"id": 1}]), raw_trades(spark, [{"id": 2}])
    write_enriched(first, path, "2024-08-21")
    write_enriched(first, path, "2024-08-22")
    write_enriched(second, path, "2024-08-22")
    write_enriched(first, path, "2024-08-23")
    write_enriched(first.limit(0), path, "2024-08-23")
    assert [r.id for r in read_enriched(spark, path, "2024-08-21").collect()] == [1]
    assert [r.id for r in read_enriched(spark, path, "2024-08-22").collect()] == [2]
    assert read_enriched(spark, path).count() == 2


@pytest.fixture(scope="module")
def broker_root(spark, tmp_path_factory):
    """The sample stored the way a broker's tables are."""
    root = str(tmp_path_factory.mktemp("broker"))
    tables = sample_tables(spark, SF)
    for name in TABLE_SCHEMAS:
        getattr(tables, name).write.parquet(f"{root}/{name}")
    return root


def test_the_daily_job_writes_every_report(spark, broker_root, tmp_path):
    tables = read_parquet_tables(spark, broker_root)
    root = str(tmp_path / "out")
    run_day(spark, tables, "2024-01-15", root)
    run_day(spark, tables, "2024-01-16", root)
    assert sorted(os.listdir(f"{root}/reports")) == ["report_date=2024-01-15", "report_date=2024-01-16"]
    assert report_names(spark, f"{root}/reports", "2024-01-16") == sorted(REPORTS)
    assert report_names(spark, f"{root}/checks", "2024-01-15") == sorted(CHECKS)
    t = read_enriched(spark, f"{root}/enriched", "2024-01-15")
    opened_or_closed = t.where(
        "date(open_time) = date'2024-01-15' OR date(close_time) = date'2024-01-15'"
    ).count()
    assert t.count() == opened_or_closed > 0
    for name, df in build_reports(t).items():
        stored = read_report(spark, f"{root}/reports", name, "2024-01-15")
        assert rows(stored.drop("report_date").select(*df.columns)) == rows(df), name


def test_a_report_set_is_published_as_a_whole(spark, tmp_path):
    root = str(tmp_path / "out")

    def numbers(n):
        return spark.range(n)

    def seen():
        names = report_names(spark, root, "2024-01-15")
        return {name: read_report(spark, root, name, "2024-01-15").count() for name in names}

    assert seen() == {}
    with pytest.raises(FileNotFoundError, match="2024-01-15"):
        read_report(spark, root, "a", "2024-01-15")
    write_reports(spark, {"a": numbers(1), "b": lambda: numbers(2)}, root, "2024-01-15")
    assert seen() == {"a": 1, "b": 2}

    def dies():
        # the other report of this run is there already
        assert any((p / "a" / "_SUCCESS").exists() for p in (tmp_path / "out" / "report_date=2024-01-15").glob("run-*"))
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError, match="killed"):
        write_reports(spark, {"a": numbers(10), "b": dies}, root, "2024-01-15", parallel=1)
    assert seen() == {"a": 1, "b": 2}
    old = read_report(spark, root, "a", "2024-01-15")
    write_reports(spark, {"a": numbers(5), "c": numbers(0)}, root, "2024-01-15")
    assert seen() == {"a": 5, "c": 0} and old.count() == 1
    # the new run and the one before, nothing of the one that failed
    assert len([n for n in os.listdir(f"{root}/report_date=2024-01-15") if n.startswith("run-")]) == 2


def test_an_empty_day_flows_through(spark, broker_root):
    tables = read_parquet_tables(spark, broker_root)
    none = enrich(tables, (10, 20))
    assert none.count() == 0
    assert extract_accounts(tables.accounts, extract_trades(tables.trades, (10, 20))).count() == 0


def test_one_matching_account(spark, broker_root):
    tables = read_parquet_tables(spark, broker_root)
    one = extract_trades(tables.trades).where("id = 1")
    assert extract_accounts(tables.accounts, one).count() == 1


def test_enriched_columns(spark, broker_root):
    df = enrich(read_parquet_tables(spark, broker_root))
    assert set(df.columns) == {f.name for f in ENRICHED.fields}
    assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in ENRICHED}


def test_broadcast_only_below_the_limit(spark, broker_root):
    tables = read_parquet_tables(spark, broker_root)
    assert are_small([tables.accounts]) and not are_small([tables.accounts], 10)
    window = day_bounds("2024-01-15")

    def plan(limit):
        return enrich(tables, window, limit)._jdf.queryExecution().analyzed().toString()

    # a large account side is cut down to the window's accounts instead
    assert "broadcast" in plan(10**9).lower() and "LeftSemi" not in plan(10**9)
    assert "broadcast" not in plan(10).lower() and "LeftSemi" in plan(10)
    assert rows(enrich(tables, window, 10)) == rows(enrich(tables, window))


class Recorder:
    """Stands for a session: records what readers are asked for."""

    def __init__(self, frames):
        self.frames, self.calls = frames, []

    @property
    def read(self):
        return RecordingReader(self)


class RecordingReader:
    def __init__(self, owner):
        self.owner, self.options_ = owner, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.options_.update(options)
        return self

    def load(self):
        return self._found(self.options_["dbtable"], {"options": self.options_})

    def jdbc(self, url, table, predicates, properties):
        return self._found(table, {"url": url, "predicates": predicates, "properties": properties})

    def _found(self, table, call):
        self.owner.calls.append((table, call))
        return self.owner.frames[table.split()[-1]]


def test_jdbc_reads_the_window_and_its_accounts(spark, broker_root):
    frames = {name: getattr(read_parquet_tables(spark, broker_root), name) for name in TABLE_SCHEMAS}
    first, last = day_bounds("2024-01-15")
    recorder = Recorder(frames)
    tables = read_jdbc_tables(recorder, "jdbc:mysql://db", {"user": "u"}, (first, last), partitions=8, balanced=False)
    calls = dict(recorder.calls)
    trades = calls.pop("trades")
    assert trades["url"] == "jdbc:mysql://db" and trades["properties"] == {"fetchsize": "10000", "user": "u"}
    for table, call in calls.items():
        assert call["options"] == {"url": "jdbc:mysql://db", "fetchsize": "10000", "user": "u", "dbtable": table}
        assert "WHERE" in table and str(first) in table
    # the parts hold every trade of the window once
    parts = [tables.trades.where(p).count() for p in trades["predicates"]]
    assert len(parts) == 8 and sum(parts) == extract_trades(tables.trades, (first, last)).count() > 0
    union = tables.trades.where("false")
    for p in trades["predicates"]:
        union = union.union(tables.trades.where(p))
    assert union.select("id").distinct().count() == sum(parts)


def test_jdbc_without_a_window_reads_whole_tables(spark, broker_root):
    recorder = Recorder({name: getattr(read_parquet_tables(spark, broker_root), name) for name in TABLE_SCHEMAS})
    read_jdbc_tables(recorder, "jdbc:mysql://db", {})
    assert [(t, c["options"]) for t, c in recorder.calls] == [
        (t, {"url": "jdbc:mysql://db", "fetchsize": "10000", "dbtable": t}) for t in TABLE_SCHEMAS]


def test_amounts_are_kept_or_refused(spark):
    schema = T.StructType([T.StructField("profit", MONEY)])

    def read(values, kind):
        return [r.profit for r in conform(spark.createDataFrame([(v,) for v in values], f"profit {kind}"), schema).collect()]

    assert read([1.005, 0.0004, 0.1 + 0.2, None], "double") == [Decimal("1.005"), Decimal("0.0004"), Decimal("0.3"), None]
    assert read(["1.005", "0.0004", None], "string") == [Decimal("1.005"), Decimal("0.0004"), None]
    assert read([Decimal("1.00500000")], "decimal(20,8)") == [Decimal("1.005")]
    exact = ["12345678901.123456", "-0.5000000000", " 2.5 ", "1e3", "15E-6", ".5", "7."]
    assert read(exact, "string") == [Decimal(v.strip()).quantize(Decimal("0.000001")) for v in exact]
    # a relative allowance would let the large ones through
    for text in ("12345678.00049951", "123456.1234567", "1e-7", "1234567890123.5", "1.000000000000000000000000001", ""):
        with pytest.raises(Exception, match="column profit"):
            read([text], "string")
    for value, kind in ((1.0000004, "double"), ("0.00000049", "string"), ("x", "string"), (Decimal("1.00000001"), "decimal(20,8)"), (1e15, "double")):
        with pytest.raises(Exception, match="column profit"):
            read([value], kind)


def test_jdbc_ranges_hold_about_equal_rows(spark, broker_root):
    frames = {name: getattr(read_parquet_tables(spark, broker_root), name) for name in TABLE_SCHEMAS}
    window = first, last = day_bounds("2024-01-15")
    # 90 % open in one hour, a tenth of all in one second of it; some only close in the window
    opened = (f"CASE WHEN id % 10 = 0 THEN {first} + id * 8 % 86400 WHEN id % 10 = 1 THEN {first} + 36000"
              f" ELSE {first} + 36000 + id % 3600 END")
    rows_ = spark.range(10_000).selectExpr(
        "id", f"CASE WHEN id % 50 = 0 THEN {first} - id WHEN id % 50 = 10 THEN NULL ELSE {opened} END AS open_time")
    rows_ = rows_.selectExpr("*", f"CASE WHEN id % 77 = 1 THEN NULL ELSE {first} + id % 7200 END AS close_time")
    frames["trades"] = conform(frames["trades"].limit(0).unionByName(rows_, allowMissingColumns=True), TABLE_SCHEMAS["trades"])
    frames["trades"].createOrReplaceTempView("trades")
    for time, query in count_tables(window).items():
        frames[f"{time}_counts"] = spark.sql(f"SELECT * FROM {query}")
    recorder = Recorder(frames)
    read_jdbc_tables(recorder, "jdbc:mysql://db", {}, window, partitions=16)
    predicates = dict(recorder.calls)["trades"]["predicates"]
    held = spark.sql("SELECT " + ", ".join(f"count_if({p}) AS p{i}" for i, p in enumerate(predicates)) + " FROM trades").first()
    assert sum(held) == extract_trades(frames["trades"], window).count()
    covered = spark.sql("SELECT max(" + " + ".join(f"int(coalesce({p}, false))" for p in predicates) + ") FROM trades").first()[0]
    assert covered == 1
    share = sum(held) / 16
    assert len(held) <= 24 and max(held) <= 1.05 * share
    # but for the rests in front of the full second and at the two ends, none is under half a share
    assert sum(h < share / 2 for h in held) <= 3


def test_csv_rows_that_cannot_be_read_are_listed(spark, tmp_path):
    names = "id,login,profit,open_time,open_time_str,volume".split(",")
    bad = [
        "2,70001,1.00000049,1724284700,2024-08-22 03:00:00,1", "3,70001,x,soon,2024-08-22 03:00:00,1",
        "4,70001,1,1724284700,yesterday,1", "5,70001,1,1724284700,2024-08-22 03:00:00,5.5", "99999999999999999999,70001,1,,,",
    ]
    good = ["1,70001,1.005,1724284700,2024-08-22 03:00:00,5.0", "6,70001,NA,,,", "7,70002,-3,1724284700.0,2024-08-22 03:00:00,2"]
    path = write_csv(tmp_path / "in_2024-08-22.csv", names, *good, *bad)
    with open(path, "a") as more:
        more.write("8,70001,1\n")
    rows_, rejected = split_enriched_csv(spark, path)
    assert [(r.id, r.profit, r.volume) for r in rows_.orderBy("id").collect()] == [
        (1, Decimal("1.005"), 5), (6, None, None), (7, Decimal("-3"), 2)]
    found = {r.text.split(",")[0]: r for r in rejected.collect()}
    assert {i: r.reason for i, r in found.items()} == {
        "2": "profit", "3": "open_time, profit", "4": "open_time_str", "5": "volume", "99999999999999999999": "id", "8": "number of cells"}
    assert found["2"].text.startswith(bad[0]) and found["8"].text == "8,70001,1"
    assert all(r.file.endswith("in_2024-08-22.csv") for r in found.values())
    # what both readers can read they read alike
    (tmp_path / "fine").mkdir()
    fine = write_csv(tmp_path / "fine" / "in_2024-08-22.csv", names, *good)
    assert rows_.schema == read_enriched_csv(spark, fine).schema
    assert rows(rows_) == rows(read_enriched_csv(spark, fine))
    assert split_enriched_csv(spark, fine)[1].count() == 0
    with pytest.raises(ValueError, match="6 rows"):
        run_csv_day(spark, path, "2024-08-22", str(tmp_path / "out"), max_rejected=5)
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).count() == 6
    assert not (tmp_path / "out" / "reports").exists()
