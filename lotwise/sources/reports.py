"""Sink of the report set: one parquet dataset per report, published together.

A run writes its reports to a folder of its own. When all are there, one small file that
names the run is moved over the one before, which a file system does at once. Readers go
by that file, so they see the reports of one run: the last one that was complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F


class _Folder:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.path = self.hadoop.Path(path)
        self.files = self.path.getFileSystem(self.conf)

    def child(self, name: str):
        return self.hadoop.Path(self.path, name)

    def text(self, name: str) -> str | None:
        if not self.files.exists(self.child(name)):
            return None
        stream = self.files.open(self.child(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file, or replace it at once."""
        place = self.child(f".{name}-{uuid.uuid4().hex}")
        stream = self.files.create(place)
        try:
            stream.writeBytes(text)
        finally:
            stream.close()
        kind = getattr(self.hadoop, "Options$Rename")
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = self.hadoop.FileContext.getFileContext(self.files.getUri(), self.conf)
        context.rename(self.files.makeQualified(place), self.files.makeQualified(self.child(name)), options)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.files.listStatus(self.path)] if self.files.exists(self.path) else []

    def remove(self, name: str) -> None:
        self.files.delete(self.child(name), True)


_PUBLISHED = "published"


def _day(root: str, report_date: str) -> str:
    return f"{root.rstrip('/')}/report_date={report_date}"


def write_reports(
    spark: SparkSession,
    reports: dict[str, DataFrame | Callable[[], DataFrame]],
    root: str,
    report_date: str,
    parallel: int = 4,
) -> None:
    """Write the reports of a date and publish them together, see ``read_report``.

    ``parallel`` reports are built and run at a time, so that the short tail of
    one job does not leave the cluster idle. A report without rows is written
    too. If one fails, none is published. The run before stays for those who still
    read it; older ones and what failed or killed runs have left are deleted.
    """
    day = _Folder(spark, _day(root, report_date))
    before, run = day.text(_PUBLISHED), f"run-{uuid.uuid4().hex}"

    def write(name: str, report: DataFrame | Callable[[], DataFrame]) -> None:
        df = report() if callable(report) else report
        df.write.parquet(f"{_day(root, report_date)}/{run}/{name}")

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(write), *item) for item in reports.items()]
    for job in jobs:
        job.result()
    day.put(_PUBLISHED, run)
    for name in day.names():
        if name not in (_PUBLISHED, run, before):
            day.remove(name)


def report_names(spark: SparkSession, root: str, report_date: str) -> list[str]:
    """The published reports of a date, none if nothing has been published."""
    run = _Folder(spark, _day(root, report_date)).text(_PUBLISHED)
    return sorted(_Folder(spark, f"{_day(root, report_date)}/{run}").names()) if run else []


def read_report(spark: SparkSession, root: str, name: str, report_date: str) -> DataFrame:
    """A published report of a date, with ``report_date``."""
    run = _Folder(spark, _day(root, report_date)).text(_PUBLISHED)
    if run is None:
        raise FileNotFoundError(f"no reports of {report_date} are published in {root}")
    found = spark.read.parquet(f"{_day(root, report_date)}/{run}/{name}")
    return found.withColumn("report_date", F.lit(report_date).cast("date"))
