"""Readers for the four source tables.

Every reader applies the declared schema and leaves filters and column choice
to the query, so that both reach the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from lotwise import schemas as S

TABLE_SCHEMAS = {
    "trades": S.TRADES,
    "accounts": S.ACCOUNTS,
    "customers": S.CUSTOMERS,
    "countries": S.COUNTRIES,
}


@dataclass(frozen=True)
class BrokerTables:
    trades: DataFrame
    accounts: DataFrame
    customers: DataFrame
    countries: DataFrame


# What binary floating point may leave behind a decimal amount, relative to it.
FLOAT_NOISE = 1e-9


def fitting(value: str, source: T.DataType, target: T.DecimalType) -> tuple[str, str]:
    """SQL of ``value`` as an amount, null where that cannot be, and of whether this is the same number."""
    tried = f"try_cast({value} AS {target.simpleString()})"
    if isinstance(source, T.DecimalType):
        return tried, f"{tried} = {value}"
    if isinstance(source, T.StringType):
        # as written: cut to the scale it must stay the same number, however large
        return tried, unrounded(value, target.scale) + f" AND {tried} IS NOT NULL"
    number = f"try_cast({value} AS double)"
    return tried, f"abs({tried} - {number}) <= {FLOAT_NOISE} * greatest(1, abs({number}))"


def exact(value: str, name: str, source: T.DataType, target: T.DataType) -> str:
    """SQL that casts ``value``; an amount the decimal type cannot hold is an error that names the column."""
    if not isinstance(target, T.DecimalType) or source == target or isinstance(source, (T.IntegralType, T.NullType)):
        return f"cast({value} AS {target.simpleString()})"
    tried, fits = fitting(value, source, target)
    error = f"raise_error(concat('column {name}: no exact {target.simpleString()}: ', {value}))"
    return f"CASE WHEN {value} IS NULL OR {fits} THEN {tried} ELSE cast({error} AS {target.simpleString()}) END"


# A number as text: sign, digits before and after the point, exponent.
_PLAIN_NUMBER = r"^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$"


def unrounded(value: str, scale: int) -> str:
    """SQL that is true if a number written as text has no digit but zeros after ``scale`` decimal places.

    Text with an exponent is compared as a decimal of 38 digits, 18 of them after the point.
    """
    text = f"trim({value})"
    places = f"regexp_replace({text}, '^[^.]*[.]?', '')"
    plain = f"rlike({text}, '{_PLAIN_NUMBER}') AND rtrim('0', substr({places}, {scale + 1})) = ''"
    wide = "decimal(38, 18)"
    other = (f"NOT rlike({text}, '{_PLAIN_NUMBER}') AND try_cast({value} AS {wide}) IS NOT NULL"
             f" AND try_cast({value} AS {wide}) = cast(try_cast({value} AS decimal(38, {scale})) AS {wide})")
    return f"(({plain}) OR ({other}))"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns and types, without rounding amounts."""
    return df.selectExpr(*[
        f"{exact(f.name, f.name, df.schema[f.name].dataType, f.dataType)} AS {f.name}" for f in schema.fields
    ])


def read_parquet_tables(spark: SparkSession, root: str) -> BrokerTables:
    """Tables stored as ``<root>/<name>`` parquet datasets."""
    return BrokerTables(**{
        name: conform(spark.read.parquet(f"{root.rstrip('/')}/{name}"), schema)
        for name, schema in TABLE_SCHEMAS.items()
    })


def window_predicates(window: tuple[int, int], partitions: int) -> list[str]:
    """SQL conditions that deal the trades of a window into ``partitions`` parts, each trade into one.

    Trades opened in the window are cut by open time, the others closed in it by
    close time, so every part is a range of an index whatever the history holds.
    """
    first, last = window
    parts = max(1, partitions // 2)
    edges = [first + (last + 1 - first) * i // parts for i in range(parts + 1)]
    ranges = [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if a < b]
    earlier = f"(open_time IS NULL OR open_time < {first} OR open_time > {last})"
    return [f"open_time >= {a} AND open_time < {b}" for a, b in ranges] + [
        f"close_time >= {a} AND close_time < {b} AND {earlier}" for a, b in ranges
    ]


# Buckets of a window in which the database counts its trades: seconds of a day, longer ones of a longer window.
COUNT_BUCKETS = 86_400
# Ids often come in steps; multiples of them by a prime modulus lie all over it.
ID_PRIME, ID_FACTOR = 65_537, 40_503


def count_tables(window: tuple[int, int]) -> dict[str, str]:
    """Queries for (bucket, trades) of what opens in a window, and of what only closes in it."""
    first, last = window
    step = bucket_seconds(window)
    inside = {
        "open_time": f"open_time BETWEEN {first} AND {last}",
        "close_time": f"close_time BETWEEN {first} AND {last} AND (open_time IS NULL OR open_time < {first} OR open_time > {last})",
    }
    return {
        time: f"(SELECT FLOOR(({time} - {first}) / {step}) AS bucket, COUNT(*) AS n FROM trades WHERE {where}"
              f" GROUP BY FLOOR(({time} - {first}) / {step})) AS {time}_counts"
        for time, where in inside.items()
    }


def bucket_seconds(window: tuple[int, int]) -> int:
    return -(-(window[1] + 1 - window[0]) // COUNT_BUCKETS)


def balanced_predicates(window: tuple[int, int], counts: dict[str, list[tuple[int, int]]], partitions: int) -> list[str]:
    """As ``window_predicates``, with parts of about equal rows.

    ``counts`` holds (bucket, trades) of ``count_tables``. A bucket that holds more than a part is cut by trade id.
    """
    first, last = window
    step, end = bucket_seconds(window), last + 1
    share = max(1, -(-sum(n for of_time in counts.values() for _, n in of_time) // partitions))
    earlier = f" AND (open_time IS NULL OR open_time < {first} OR open_time > {last})"
    found = []
    for time, of_time in counts.items():
        rest = earlier if time == "close_time" else ""

        def part(a: int, b: int, time=time, rest=rest) -> str:
            return f"{time} >= {a} AND {time} < {b}{rest}"

        start, held = first, 0
        for bucket, n in sorted((int(bucket), int(n)) for bucket, n in of_time):
            begin, after = first + bucket * step, min(end, first + (bucket + 1) * step)
            if held and held + n > share:
                found.append(part(start, begin))
                start, held = begin, 0
            if n <= share:
                held += n
                continue
            slices = min(ID_PRIME, -(-n // share))
            spread = f"ABS(MOD(MOD(id, {ID_PRIME}) * {ID_FACTOR}, {ID_PRIME}))"
            for i in range(slices):
                low, high = ID_PRIME * i // slices, ID_PRIME * (i + 1) // slices
                of_id = f"{spread} >= {low} AND {spread} < {high}"
                found.append(f"{part(start, after)} AND {f'(({of_id}) OR id IS NULL)' if i == 0 else of_id}")
            start = after
        if start < end:
            found.append(part(start, end))
    return found


def window_tables(window: tuple[int, int]) -> dict[str, str]:
    """What to read of each table: the account side only for the trades of the window."""
    first, last = window
    logins = (
        f"SELECT login FROM trades WHERE open_time BETWEEN {first} AND {last} OR close_time BETWEEN {first} AND {last}")
    holders = f"SELECT customer_id FROM accounts WHERE login IN ({logins})"
    homes = f"SELECT country_id FROM customers WHERE id IN ({holders})"
    return {
        "trades": "trades",
        "accounts": f"(SELECT * FROM accounts WHERE login IN ({logins})) AS accounts",
        "customers": f"(SELECT * FROM customers WHERE id IN ({holders})) AS customers",
        "countries": f"(SELECT * FROM countries WHERE id IN ({homes})) AS countries",
    }


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    window: tuple[int, int] | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
    balanced: bool = True,
) -> BrokerTables:
    """Tables of a relational database, e.g. ``jdbc:mysql://…``.

    With a window (epoch seconds, both included) the database returns its trades
    in about ``partitions`` parallel range queries, and only the accounts,
    customers and countries these trades need. The ranges hold about equal rows, by
    counts that the database makes first; if not ``balanced``, they are of equal time,
    without that query. Without a window, each table is read whole by one query.
    """
    tables = window_tables(window) if window else {name: name for name in TABLE_SCHEMAS}

    def loaded(query: str) -> DataFrame:
        return spark.read.format("jdbc").options(dbtable=query, url=url, fetchsize=str(fetch_size), **properties).load()

    def predicates() -> list[str]:
        if not balanced:
            return window_predicates(window, partitions)
        # at most COUNT_BUCKETS rows each, whatever the table holds
        counts = {time: [tuple(r) for r in loaded(query).select("bucket", "n").collect()] for time, query in count_tables(window).items()}
        return balanced_predicates(window, counts, partitions)

    def table(name: str) -> DataFrame:
        # a reader is changed by its options, so every table gets its own
        options = {"url": url, "fetchsize": str(fetch_size), **properties}
        if window and name == "trades":
            table_options = {k: v for k, v in options.items() if k != "url"}
            source = spark.read.jdbc(url, tables[name], predicates=predicates(), properties=table_options)
        else:
            source = spark.read.format("jdbc").options(dbtable=tables[name], **options).load()
        return conform(source, TABLE_SCHEMAS[name])

    return BrokerTables(**{name: table(name) for name in TABLE_SCHEMAS})
