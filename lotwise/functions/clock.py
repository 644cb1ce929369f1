"""Times: epoch parsing, holding time, sessions, hour ranges.

All clocks are TIMESTAMP_NTZ so that no result depends on the time zone of the
Spark session.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lotwise import constants as K

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# Fixed value: the largest epoch second a 64-bit nanosecond clock can hold.
LAST_EPOCH_SECOND = 9223372036


def day_bounds(day: str | date, utc_offset_hours: int = 0) -> tuple[int, int]:
    """First and last epoch second of a calendar day on the given clock."""
    if isinstance(day, str):
        day = date.fromisoformat(day)
    start = datetime(day.year, day.month, day.day, tzinfo=timezone(timedelta(hours=utc_offset_hours)))
    first = int(start.timestamp())
    return first, first + 86399


def in_window(first: int, last: int, open_time="open_time", close_time="close_time") -> Column:
    """Opened or closed inside the window, both bounds included."""
    return F.col(open_time).between(first, last) | F.col(close_time).between(first, last)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH))


def strict_epoch(column: Column, data_type: T.DataType) -> Column:
    """Epoch seconds; text that is no number is an error."""
    if isinstance(data_type, T.StringType):
        column = column.cast("double")
    return column.cast("bigint")


def lenient_epoch(column: Column, data_type: T.DataType) -> Column:
    """Epoch seconds; what cannot be a time becomes null."""
    if isinstance(data_type, T.StringType):
        # "1724284800.0" is valid text for a time, hence the step over double
        column = column.try_cast("double").try_cast("bigint")
    else:
        column = column.try_cast("bigint")
    return F.when(column.between(-LAST_EPOCH_SECOND, LAST_EPOCH_SECOND), column)


def time_of_day(clock: Column) -> Column:
    """Time since midnight, as an interval."""
    # not timestamp_diff, which would go through the session time zone
    return clock - clock.cast("date").cast("timestamp_ntz")


def _interval(hhmm: str) -> str:
    return f"INTERVAL '{hhmm}' HOUR TO MINUTE"


def session_of(time: str, sessions=K.SESSIONS) -> Column:
    """Trading session by the column ``time``, a broker-clock time of day.

    Bounds are exact: 02:44:00 is inside a session that ends at 02:44, one
    second later is not.
    """
    cases = " ".join(
        f"WHEN {time} BETWEEN {_interval(first)} AND {_interval(last)} THEN '{name}'" for name, first, last in sessions
    )
    return F.expr(f"CASE {cases} ELSE '{K.UNKNOWN_SESSION}' END")


def outside_hours(clock: Column, hours=K.MARKET_HOURS) -> Column:
    time = time_of_day(clock)
    return (time < F.expr(_interval(hours[0]))) | (time > F.expr(_interval(hours[1])))


def within_hours(first: int, last: int, open_time="open_time", close_time="close_time") -> Column:
    """Both hours of day in [first, last); the dates are not compared."""
    opened, closed = F.hour(open_time), F.hour(close_time)
    return (opened >= first) & (opened < last) & (closed >= first) & (closed < last)


def is_closed(close_time="close_time") -> Column:
    """False for the placeholder closes of a trade that is still open."""
    return ~F.col(close_time).isin([F.lit(t).cast("timestamp_ntz") for t in K.OPEN_TRADE_CLOSES])


def normalize_times(trades: DataFrame) -> DataFrame:
    """Epoch columns to timestamps, plus ``holding_time`` and ``session``.

    A close that is null or no time becomes 1970-01-01 00:00:00.
    """
    types = {f.name: f.dataType for f in trades.schema.fields}
    opened = strict_epoch(F.col("open_time"), types["open_time"])
    closed = F.coalesce(lenient_epoch(F.col("close_time"), types["close_time"]), F.lit(0).cast("bigint"))
    # The intermediate values are columns of their own: as parts of the final
    # expressions they would be computed once per use, the broker clock 24 times.
    epochs = trades.withColumns({
        "_opened": opened,
        "_closed": closed,
        "_time": time_of_day(F.col("open_time_str").cast("timestamp_ntz")),
    })
    return epochs.withColumns({
        "open_time": from_epoch(F.col("_opened")),
        "close_time": from_epoch(F.col("_closed")),
        "holding_time": F.col("_closed") - F.col("_opened"),
        "session": session_of("_time"),
    }).drop("_opened", "_closed", "_time")
