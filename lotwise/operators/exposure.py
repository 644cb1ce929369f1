"""Largest live net exposure per login and asset class.

Whenever a trade opens, the lots still live are netted per symbol (buys minus
all other sides) and the absolute nets added up; the result is the largest such
sum. A trade is live from its open until its close, that second included; one
that closes before it opens counts at its own open only.

Instead of joining each trade to all trades live at its open, every trade
becomes an opening and a closing event. The net of a symbol is a running sum
over its events, an event moves the exposure by the change of that symbol's
|net|, and the exposure is the running sum of these moves: two windows over one
sort key and a single exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from lotwise import constants as K
from lotwise.functions.trades import signed_lot
from lotwise.schemas import LOTS

# Lots are summed as whole thousandths, the scale of the lots column: running
# sums of bigint are several times cheaper than those of wide decimals.
LOT_UNITS = 10**LOTS.scale

OWNER = ["login", "asset_class"]
ORDER = ["at", "phase", "id", "closing"]
SLOT = ["slice", "slot_at", "slot_phase", "slot_block"]
HOLDER = ["equity", "type_account", "breachedby", "starting_balance"]

# A login with more trades than this in one class is cut into time slices; another
# one is a single slot, and so a single window partition (about 100 bytes per event).
HOT_TRADES = 2_000_000
# Trades a slice should hold. A slice with many times more is cut further.
SLICE_TRADES = 500_000
DENSE_FACTOR = 8
# Trade ids per slot within one second of a dense slice, as a power of two.
BLOCK_BITS = 20


def watched(trades: DataFrame, limits=K.EXPOSURE_LIMITS) -> DataFrame:
    """Trades in the watched symbols of the classes in ``limits``."""
    keep = F.lit(False)
    for name, (_, symbols) in limits.items():
        in_class = F.col("asset_class") == name
        keep = keep | (in_class if symbols is None else in_class & F.col("symbol").isin(symbols))
    return trades.where(keep & F.col("login").isNotNull() & F.col("open_time").isNotNull())


def _events(legs: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """Opening and closing event of each trade; with a window, those at or after its start and before its end."""
    zero = F.lit(0)
    early = F.col("close_time") < F.col("open_time")
    opening = F.struct(
        F.col("open_time").alias("at"), zero.alias("phase"), zero.alias("closing"), F.col("lot").alias("change"))
    # closings come after all openings of their second, as a trade is live up
    # to and including it
    closing = F.struct(
        F.when(early, F.col("open_time")).otherwise(F.col("close_time")).alias("at"),
        F.when(early, 0).otherwise(1).alias("phase"), F.lit(1).alias("closing"),
        (-F.col("lot")).alias("change"),
    )
    events = legs.select(*OWNER, "symbol", "id", F.inline(F.array(opening, closing)))
    if window is None:
        return events
    return events.where((F.col("at") >= _instant(window[0])) & (F.col("at") < _instant(window[1])))


def _instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _moves(legs: DataFrame, window: tuple[str, str] | None, before: DataFrame | None) -> DataFrame:
    """The events of a window, after one for each net of ``before`` at its start."""
    events = _events(legs, window)
    if before is None:
        return events
    carried = before.select(
        *OWNER, "symbol", F.lit(0).cast("bigint").alias("id"), _instant(window[0]).alias("at"),
        F.lit(-1).alias("phase"), F.lit(-1).alias("closing"), F.col("net").alias("change"))
    return events.unionByName(carried)


def _walk(events: DataFrame) -> DataFrame:
    """Exposure after each event, within a slot."""
    upto = (W.unboundedPreceding, W.currentRow)
    per_symbol = W.partitionBy(*OWNER, *SLOT, "symbol").orderBy(*ORDER).rowsBetween(*upto)
    per_slot = W.partitionBy(*OWNER, *SLOT).orderBy(*ORDER).rowsBetween(*upto)
    net = F.col("net")
    return (
        events.withColumn("net", F.sum("change").over(per_symbol))
        .withColumn("move", F.abs(net) - F.abs(net - F.col("change")))
        .withColumn("exposure", F.sum("move").over(per_slot))
    )


def _sum_before(df: DataFrame, owner: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all earlier slots of the owner, in two steps: whole
    runs of 1024 slices first, then the slots of the same run."""
    before = (W.unboundedPreceding, -1)
    df = df.withColumn("run", F.shiftright("slice", 10))
    runs = df.groupBy(*owner, "run").agg(F.sum(value).alias("v"))
    by_run = W.partitionBy(*owner).orderBy("run").rowsBetween(*before)
    in_run = W.partitionBy(*owner, "run").orderBy(*SLOT).rowsBetween(*before)
    zero = F.lit(0)
    earlier_runs = runs.select(*owner, "run", F.coalesce(F.sum("v").over(by_run), zero).alias("carry"))
    return (
        df.join(earlier_runs, [*owner, "run"])
        .withColumn(name, F.col("carry") + F.coalesce(F.sum(value).over(in_run), zero))
        .drop("carry", "run")
    )


def _seconds(interval):
    return interval.cast("interval second").cast("bigint")


def _one_slot(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "slice": F.lit(0).cast("bigint"), "slot_at": F.lit(None).cast("timestamp_ntz"),
        "slot_phase": F.lit(None).cast("int"), "slot_block": F.lit(None).cast("bigint"),
    })


def _slotted(sliced: DataFrame, dense: DataFrame, block_bits: int) -> DataFrame:
    """Events of hot logins with their slot.

    A slice is a slot, unless it is so dense that it is cut by second, phase and trade id: such a slot holds a
    bounded number of events however many trades the login has.
    """
    return sliced.join(dense, [*OWNER, "slice"], "left").withColumns({
        "slot_at": F.when(F.col("dense"), F.col("at")),
        "slot_phase": F.when(F.col("dense"), F.col("phase")),
        "slot_block": F.when(F.col("dense"), F.shiftright("id", block_bits)),
    }).drop("dense")


def _sliced(events: DataFrame, hot: DataFrame) -> DataFrame:
    slice_ = F.floor(_seconds(F.col("at") - F.col("first")) / F.col("width"))
    return events.join(hot, OWNER).withColumn("slice", slice_).drop("first", "width")


def _carried(events: DataFrame) -> DataFrame:
    """Opening rows of the slots of hot logins: the net of each symbol that trades in
    the slot, and the summed |net| of all others, as earlier slots left them."""
    symbol_slots = events.groupBy(*OWNER, "symbol", *SLOT).agg(F.sum("change").alias("change"))
    symbol_slots = _sum_before(symbol_slots, [*OWNER, "symbol"], "change", "start")
    slots = symbol_slots.groupBy(*OWNER, *SLOT).agg(
        F.sum(F.abs(F.col("start") + F.col("change")) - F.abs("start")).alias("move"),
        F.sum(F.abs("start")).alias("present"),
    )
    slots = _sum_before(slots, OWNER, "move", "level")

    def opening_rows(df, symbol, lots):
        # without a time, so they sort in front of the events of the slot
        return df.select(
            *OWNER, *SLOT, symbol.alias("symbol"), F.lit(None).cast("timestamp_ntz").alias("at"),
            F.lit(0).alias("phase"), F.lit(0).cast("bigint").alias("id"), F.lit(-1).alias("closing"),
            lots.alias("change"),
        )

    return opening_rows(symbol_slots, F.col("symbol"), F.col("start")).unionByName(
        opening_rows(slots, F.lit(None).cast("string"), F.col("level") - F.col("present")))


def exposure_legs(trades: DataFrame, limits=K.EXPOSURE_LIMITS) -> DataFrame:
    """What the exposure needs of the watched trades."""
    return watched(trades, limits).select(
        *OWNER, "symbol", "id", "open_time", "close_time", *HOLDER,
        (signed_lot() * LOT_UNITS).cast("bigint").alias("lot"),
    )


def peaks(
    legs: DataFrame, hot_trades: int = HOT_TRADES, slice_trades: int = SLICE_TRADES, block_bits: int = BLOCK_BITS,
    window: tuple[str, str] | None = None, before: DataFrame | None = None, stage=None,
) -> DataFrame:
    """(login, asset_class) with its largest live exposure ``peak`` in lot units and its first trade ``first_id``.

    With a window (times as text, the end left out), only trades that open in it are looked at. ``before`` holds the
    ``nets`` at its start, and ``legs`` then need only those that open or close in it.

    With ``stage``, the hot logins are found and stored first, and the branches that serve them are planned only if there
    are any. Without it, all is one plan and describing it runs no job. The frames that tell hot logins and dense
    slices apart are broadcast: they have at most (trades / ``hot_trades``) and (events / (``DENSE_FACTOR`` *
    ``slice_trades``)) rows.
    """
    keep = stage or (lambda df, name: df)
    seen = F.col("open_time") if window is None else F.greatest("open_time", _instant(window[0]))
    sizes = legs.groupBy(*OWNER).agg(F.count(F.lit(1)).alias("count"), F.min(seen).alias("first"), F.max(seen).alias("last"))
    width = F.greatest(F.lit(1), F.floor(_seconds(F.col("last") - F.col("first")) * slice_trades / F.col("count")))
    hot = keep(sizes.where(F.col("count") > hot_trades).select(*OWNER, "first", width.alias("width")), "exposure-hot")
    moves = _moves(legs, window, before)
    if stage and hot.isEmpty():
        slotted = _one_slot(moves)
    else:
        hot = F.broadcast(hot)
        sliced = keep(_sliced(moves, hot), "exposure-sliced")
        dense = F.broadcast(
            sliced.groupBy(*OWNER, "slice").count()
            .where(F.col("count") > DENSE_FACTOR * slice_trades).select(*OWNER, "slice", F.lit(True).alias("dense")))
        of_hot = _slotted(sliced, dense, block_bits)
        others = _one_slot(moves.join(hot.select(*OWNER), OWNER, "left_anti"))
        slotted = others.unionByName(of_hot).unionByName(_carried(of_hot))
    # one exchange that serves both windows
    walked = _walk(slotted.repartition(*OWNER, *SLOT))
    by_slot = walked.where("closing = 0").groupBy(*OWNER, *SLOT).agg(
        F.max("exposure").alias("peak"), F.min("id").alias("first_id"))
    return by_slot.groupBy(*OWNER).agg(F.max("peak").alias("peak"), F.min("first_id").alias("first_id"))


def nets(legs: DataFrame, window: tuple[str, str], before: DataFrame | None = None) -> DataFrame:
    """(login, asset_class, symbol) with the net lot units live at the end of a window, but for nets of 0.

    ``before`` holds the nets at its start; ``legs`` need only those that open or close in it.
    """
    changes = _events(legs, window).select(*OWNER, "symbol", "change")
    if before is not None:
        changes = changes.unionByName(before.select(*OWNER, "symbol", F.col("net").alias("change")))
    return changes.groupBy(*OWNER, "symbol").agg(F.sum("change").alias("net")).where("net <> 0")


def with_holders(found: DataFrame, legs: DataFrame) -> DataFrame:
    """``peaks`` with the account data of the first trade. The texts meet the result only, not the events."""
    first = found.withColumnRenamed("first_id", "id").join(legs.select(*OWNER, "id", *HOLDER), [*OWNER, "id"])
    # rows that repeat an id make one row, by the smaller values
    one = first.groupBy(*OWNER, "id", "peak").agg(F.min(F.struct(*HOLDER)).alias("holder"))
    return one.select(*OWNER, "peak", F.col("id").alias("first_id"), "holder.*")


def in_lots(found: DataFrame) -> DataFrame:
    lots = F.col("peak").cast("decimal(20,0)") / LOT_UNITS
    return found.select(*OWNER, lots.cast(f"decimal(26,{LOTS.scale})").alias("max_total_lots"), *HOLDER)


def max_exposure(trades: DataFrame, limits=K.EXPOSURE_LIMITS, stage=None, **options) -> DataFrame:
    """(login, asset_class) with its largest live exposure, in lots, see ``peaks``.

    ``stage`` may store the narrow legs, as ``lineage.stored`` does, so that the
    trades themselves are read once; without it, nothing runs yet.
    """
    legs = exposure_legs(trades, limits)
    if stage:
        legs = stage(legs, "exposure-legs")
    return in_lots(with_holders(peaks(legs, stage=stage, **options), legs))


def exposure_breaches(trades: DataFrame, limits=K.EXPOSURE_LIMITS, **options) -> DataFrame:
    """Logins whose largest live exposure reaches the threshold of the class."""
    return breaches(max_exposure(trades, limits, **options), limits)


def breaches(found: DataFrame, limits=K.EXPOSURE_LIMITS) -> DataFrame:
    """Rows of ``max_exposure`` that reach the threshold of their class."""
    threshold = F
    for name, (lots, _) in limits.items():
        threshold = threshold.when(F.col("asset_class") == name, F.lit(lots))
    return found.where(F.col("max_total_lots") >= threshold).select(
        "asset_class",
        "login",
        F.col("max_total_lots").cast("double").alias("max_total_lots"),
        F.col("equity").cast("double").alias("equity"),
        F.col("type_account").alias("package_type"),
        "breachedby",
        (F.col("equity") - F.col("starting_balance")).cast("double").alias("pnl"),
    )
