"""The daily job: extract, enrich, report.

Each stage is a table by report date in the output folder, so a lost executor
costs the running stage only, reports read just their columns, and a failed run
resumes with the stage that failed.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from lotwise.functions.clock import day_bounds, normalize_times
from lotwise.operators.extract import enrich
from lotwise.operators.lineage import shared_dir
from lotwise.operators.shared import grains, holders
from lotwise.plans.catalog import CHECKS, shared_builders
from lotwise.session import tune
from lotwise.sources.enriched import read_enriched, split_enriched_csv, write_enriched
from lotwise.sources.reports import write_reports
from lotwise.sources.tables import BrokerTables


def extract_day(tables: BrokerTables, report_date: str, path: str, utc_offset_hours: int = 0) -> None:
    """Enrich the trades opened or closed on the day and store them."""
    enriched = enrich(tables, day_bounds(report_date, utc_offset_hours))
    write_enriched(normalize_times(enriched), path, report_date)


def previous_day(today: date | None = None, utc_offset_hours: int = 0) -> str:
    """The day before ``today``, by default on the clock of the given offset."""
    if today is None:
        today = datetime.now(timezone(timedelta(hours=utc_offset_hours))).date()
    return (today - timedelta(days=1)).isoformat()


def report_day(trades: DataFrame, root: str, report_date: str, parallel: int = 4) -> None:
    """Write the report set over normalised trades to ``<root>/reports`` and the
    data-quality checks to ``<root>/checks``.

    The two shared passes come first, into ``<root>/shared``; most reports read only these.
    """
    spark = trades.sparkSession
    place = f"{root}/shared/{{}}/report_date={report_date}"
    grains(trades).write.mode("overwrite").partitionBy("grain").parquet(place.format("grains"))
    holders(trades).write.mode("overwrite").parquet(place.format("holders"))
    summed, accounts = (spark.read.parquet(place.format(name)) for name in ("grains", "holders"))
    write_reports(spark, shared_builders(trades, summed, accounts), f"{root}/reports", report_date, parallel)
    checks = {name: partial(check, trades) for name, check in CHECKS.items()}
    write_reports(spark, checks, f"{root}/checks", report_date, parallel)


def run_day(
    spark: SparkSession, tables: BrokerTables, report_date: str | None, root: str,
    utc_offset_hours: int = 0, parallel: int = 4,
) -> None:
    """Both stages; trades go to ``<root>/enriched``, reports to ``<root>/reports``, to be read with ``read_report``.

    Without a date, the report is on the previous day.
    """
    shared_dir(spark)  # a missing setting is an error before anything is written
    tune(spark)
    report_date = report_date or previous_day(utc_offset_hours=utc_offset_hours)
    path = f"{root.rstrip('/')}/enriched"
    extract_day(tables, report_date, path, utc_offset_hours)
    report_day(read_enriched(spark, path, report_date), root.rstrip("/"), report_date, parallel)


def run_csv_day(
    spark: SparkSession, path: str, report_date: str, root: str, max_rejected: int = 1000, parallel: int = 4,
) -> None:
    """The reports of a date from CSV files; rows that cannot be read go to ``<root>/rejected`` by report date.

    With more than ``max_rejected`` such rows nothing is reported: the job fails after it has listed them.
    """
    shared_dir(spark)  # a missing setting is an error before anything is written
    tune(spark)
    root = root.rstrip("/")
    trades, rejected = split_enriched_csv(spark, path)
    listed = f"{root}/rejected/report_date={report_date}"
    rejected.write.mode("overwrite").parquet(listed)
    if (count := spark.read.schema(rejected.schema).parquet(listed).count()) > max_rejected:
        raise ValueError(f"{count} rows of {path} cannot be read, more than {max_rejected}; they are listed in {listed}")
    write_enriched(normalize_times(trades.drop("report_date")), f"{root}/enriched", report_date)
    report_day(read_enriched(spark, f"{root}/enriched", report_date), root, report_date, parallel)
