"""Fixed values against literals, as the SQL oracle takes them from the package."""

from lotwise import constants as K
from lotwise.functions.trades import asset_class


def test_sessions():
    assert K.SESSIONS == [
        ("Market-Open Session", "00:15", "02:44"), ("Prime Asia Session", "02:45", "08:59"),
        ("Pre London Session", "09:00", "09:59"), ("London Opening Session", "10:00", "10:04"),
        ("London Session", "10:05", "13:59"), ("Pre-NY Session", "14:00", "14:59"),
        ("NY-Open Session", "15:00", "15:04"), ("Pre-NYSE Session", "15:05", "16:29"),
        ("NYSE-Open Session", "16:30", "16:35"), ("NY Session", "16:36", "21:00"),
        ("Late Trading Hours Session", "21:01", "22:59"), ("Market-Closing Session", "23:00", "23:59"),
    ]
    assert K.MARKET_HOURS == ("00:15", "23:59") and K.UNKNOWN_SESSION == "Unknown Session"


def test_exposure_limits():
    assert {name: limit for name, (limit, _) in K.EXPOSURE_LIMITS.items()} == {
        "Commodities": 18, "Indices": 7, "Forex": 70, "Crypto": 3}
    watched = {name: symbols and set(symbols) for name, (_, symbols) in K.EXPOSURE_LIMITS.items()}
    assert watched["Commodities"] == {"XAUUSD"} and watched["Crypto"] == {"BTCUSD"} and watched["Forex"] is None
    assert watched["Indices"] == {"NDX100", "US30", "GER30", "FRA40", "EUSTX50", "US2000", "UK100", "SWI20"}


def test_asset_classes(spark):
    sizes = {name: len(symbols) for name, symbols in K.ASSET_CLASSES.items()}
    assert sizes == {"Crypto": 10, "Commodities": 5, "Indices": 14, "Forex": 52}
    assert len(K.LOW_LIQUIDITY_PAIRS) == 32
    symbols = ["BTCUSD", "UKOUSD", "AUDUSD", "EURUSD", "CADEUR", "nope", None]
    df = spark.createDataFrame([(s,) for s in symbols], "symbol string").select(asset_class().alias("c"))
    assert [r.c for r in df.collect()] == ["Crypto", "Commodities", "Indices", "Forex", "Forex", "Unknown", "Unknown"]


def test_segments_and_placeholders():
    assert K.LOT_BASED_LOGIN_PREFIXES == ["70", "30"] and K.REAL_MARK == "real"
    assert K.OPEN_TRADE_CLOSES == ["1970-01-01 00:00:00", "1970-01-01 03:00:00"]
