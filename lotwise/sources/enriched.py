"""Source and sink of the enriched trades, the hand-off between the extract and
the reports: a CSV file with a header, or a parquet table by report date."""

from __future__ import annotations

import csv
from collections import Counter
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lotwise import constants as K
from lotwise.functions.clock import LAST_EPOCH_SECOND
from lotwise.schemas import ENRICHED
from lotwise.sources.tables import unrounded, exact, fitting

CSV_NAMES = {"final_lot": "FinalLot"}
# Kept as text by the CSV reader: `normalize_times` decides what is an error.
CSV_TEXT_TIMES = ("open_time", "close_time")
# Part of the hand-off, but read by no report; a file may lack them.
CSV_OPTIONAL = (
    "open_price", "close_price", "close_time_str", "commission", "digits", "reason", "sl", "ticket", "tp", "volume",
)
# Quotes are doubled inside quotes, a backslash is an ordinary character, and blanks belong to their cell.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def _place(path: str) -> str:
    """A path in one spelling: ``file:///a`` and ``file:/a`` are the same place."""
    scheme, colon, rest = path.rpartition(":/")
    return f"{scheme}{colon}{rest.lstrip('/')}"


def _header_names(line: str) -> list[str]:
    """Column names of a header line; names that occur twice get their place as a suffix, so none of them is taken for the column."""
    names = next(csv.reader([line]))
    count = Counter(name.lower() for name in names)
    return [f"{name}{place}" if count[name.lower()] > 1 else name for place, name in enumerate(names)]


def _csv_files(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV folder by their header, found by one job over all files.

    A header is the first line of a file that holds the name of every column that some report reads; lines of data are
    dropped where they are read. A file without such a line is described on its own, for the error, unless it is empty.
    """
    text = spark.read.text(path)
    files = {_place(unquote(file)): unquote(file) for file in text.inputFiles()}
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
                        F.monotonically_increasing_id().alias("line"))
    for name in _wanted():
        lines = lines.where(F.contains("value", F.lit(name)))
    heads = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header")).collect()
    found: dict[tuple[str, ...], list[str]] = {}
    for head in heads:
        place = _place(head.file) if _place(head.file) in files else _place(unquote(head.file))
        found.setdefault(tuple(_header_names(head.header)), []).append(files.pop(place))
    if files:
        rest = sorted(files.values())
        first = spark.read.text(rest).where("trim(value) <> ''").select(F.min("_metadata.file_path")).first()[0]
        if first is not None:
            file = files.get(_place(first)) or files[_place(unquote(first))]
            found = {tuple(spark.read.options(**CSV_OPTIONS, inferSchema=False).csv(file).columns): [file], **found}
    return {names: sorted(group) for names, group in found.items()}


def _wanted() -> list[str]:
    """Names of the columns that every file must have."""
    return [CSV_NAMES.get(f.name, f.name) for f in ENRICHED.fields if f.name not in CSV_OPTIONAL]


def read_enriched_csv(spark: SparkSession, path: str, nulls=K.CSV_NULLS) -> DataFrame:
    """Enriched trades from CSV, with ``report_date`` taken from the file name.

    Columns are matched by name in every file, as their order is free. A file
    without a column that some report reads is an error that names it. Cells in
    ``nulls`` are null in every column. A number that is no number, or too fine for
    its column, is an error, except in the two epoch columns.
    """
    parts = [_read_one_header(spark, list(names), files, nulls) for names, files in _csv_files(spark, path).items()]
    if not parts:
        return spark.createDataFrame([], T.StructType([*[
            T.StructField(f.name, T.StringType()) if f.name in CSV_TEXT_TIMES else f for f in ENRICHED.fields
        ], T.StructField("report_date", T.StringType())]))
    return reduce(DataFrame.unionByName, parts)


def split_enriched_csv(spark: SparkSession, path: str, nulls=K.CSV_NULLS) -> tuple[DataFrame, DataFrame]:
    """``read_enriched_csv`` that goes on over rows it cannot read: (rows, rejected).

    Rejected rows have ``file``, ``reason`` and ``text``. The reason names every column whose cell is no number, no time,
    too fine or too large for its type; or says that the row has not as many cells as the header. Nothing is rounded
    or filled in. Close times are no reason, as ``normalize_times`` takes any. Both results read the files.
    """
    groups = _csv_files(spark, path)
    if not groups:
        return read_enriched_csv(spark, path, nulls), spark.createDataFrame([], "file string, reason string, text string")
    checked = reduce(DataFrame.unionByName, [_check_one_header(spark, list(n), f, nulls) for n, f in groups.items()])
    return (checked.where("rejected IS NULL").drop("rejected"), checked.where("rejected IS NOT NULL").select("rejected.*"))


_CORRUPT = "corrupt"


def _cells(spark: SparkSession, names: list[str], files: list[str], nulls, checked: bool = False):
    """The cells of the files as text, and the SQL of a field's cell, None where the files have no such column."""
    if missing := [name for name in _wanted() if name not in names]:
        raise ValueError(f"columns {missing} are missing in {files[0]}")
    # Text first: the null spellings have to go before any cast.
    layout = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    reader = spark.read.options(**CSV_OPTIONS, enforceSchema=True)
    if checked:
        # cells are counted only where none are pruned
        layout = T.StructType([*layout.fields, T.StructField(_CORRUPT, T.StringType())])
        reader = reader.options(columnNameOfCorruptRecord=_CORRUPT, columnPruning=False)
    place = {name: f"c{i}" for i, name in enumerate(names)}

    def text(field: T.StructField) -> str | None:
        cell = place.get(CSV_NAMES.get(field.name, field.name))
        return cell and f"(CASE WHEN {cell} NOT IN ({', '.join(repr(n) for n in nulls)}) THEN {cell} END)"

    return reader.schema(layout).csv(files), text


def _report_date():
    date = F.regexp_extract(F.col("_metadata.file_name"), DATE_IN_NAME, 1)
    return F.when(date != "", date).alias("report_date")


def _read_one_header(spark: SparkSession, names: list[str], files: list[str], nulls) -> DataFrame:
    raw, text = _cells(spark, names, files, nulls)

    def column(field: T.StructField):
        cell = text(field)
        if cell is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if field.name in CSV_TEXT_TIMES or isinstance(field.dataType, T.StringType):
            return F.expr(cell).alias(field.name)
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            # whole numbers may be spelled "5.0" where the column has nulls
            return F.expr(cell).cast("decimal(38,4)").cast(field.dataType).alias(field.name)
        return F.expr(exact(cell, field.name, T.StringType(), field.dataType)).alias(field.name)

    return raw.select(*[column(f) for f in ENRICHED.fields], _report_date())


def _check_one_header(spark: SparkSession, names: list[str], files: list[str], nulls) -> DataFrame:
    raw, text = _cells(spark, names, files, nulls, checked=True)
    columns, reasons = [], [f"CASE WHEN {_CORRUPT} IS NOT NULL THEN 'number of cells' END"]

    def refuse_unless(fits: str, cell: str, field: T.StructField) -> None:
        reasons.append(f"CASE WHEN {cell} IS NOT NULL AND NOT coalesce({fits}, false) THEN '{field.name}' END")

    for field in ENRICHED.fields:
        cell, kind = text(field), field.dataType
        value = cell
        if cell is None:
            value = "NULL"
        elif field.name == "open_time":
            refuse_unless(f"try_cast(try_cast({cell} AS double) AS bigint) BETWEEN {-LAST_EPOCH_SECOND} AND {LAST_EPOCH_SECOND}", cell, field)
        elif field.name == "open_time_str":
            refuse_unless(f"try_cast({cell} AS timestamp_ntz) IS NOT NULL", cell, field)
        elif isinstance(kind, T.DecimalType):
            value, fits = fitting(cell, T.StringType(), kind)
            refuse_unless(fits, cell, field)
        elif isinstance(kind, (T.LongType, T.IntegerType)) and field.name not in CSV_TEXT_TIMES:
            # whole numbers may be spelled "5.0" where the column has nulls
            value = f"try_cast(try_cast({cell} AS decimal(38, 18)) AS {kind.simpleString()})"
            refuse_unless(f"{unrounded(cell, 0)} AND {value} IS NOT NULL", cell, field)
        kept = T.StringType() if field.name in CSV_TEXT_TIMES else kind
        columns.append(F.expr(value).cast(kept).alias(field.name))
    found = F.expr(f"concat_ws(', ', {', '.join(reasons)})")
    record = F.coalesce(F.col(_CORRUPT), F.to_csv(F.struct(*[f"c{i}" for i in range(len(names))])))
    return raw.select(
        *columns, _report_date(),
        F.when(found != "", F.struct(F.col("_metadata.file_path").alias("file"), found.alias("reason"), record.alias("text")))
        .alias("rejected"))


def write_enriched_csv(enriched: DataFrame, path: str) -> None:
    enriched.withColumnsRenamed(CSV_NAMES).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_enriched(enriched: DataFrame, path: str, report_date: str) -> None:
    """Write or replace one report date.

    The partition folder is written as such, so that a date without rows
    replaces the old rows as well and keeps its schema.
    """
    enriched.write.mode("overwrite").parquet(f"{path}/report_date={report_date}")


def read_enriched(spark: SparkSession, path: str, report_date: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if report_date is None:
        return df
    return df.where(F.col("report_date") == F.lit(report_date).cast("date"))
