"""Business constants of the trade-risk reports.

Everything here is a parameter default: each operator that uses one takes it
as an argument.
"""

from __future__ import annotations

# --- Fixed values: which instrument belongs to which asset class -------------
# A symbol listed twice takes the first class in ASSET_CLASSES order, so
# AUDUSD is an index instrument.
CRYPTO = [
    "ADAUSD", "BCHUSD", "BTCUSD", "DOGUSD", "ETHUSD",
    "LNKUSD", "LTCUSD", "XLMUSD", "XMRUSD", "XRPUSD",
]
COMMODITIES = ["UKOUSD", "USOUSD", "XAUUSD", "XAGUSD", "XPTUSD"]
INDICES = [
    "AUS200", "HK50", "EUSTX50", "FRA40", "GER30", "NTH25", "SWI20",
    "AUDUSD", "SPX500", "UK100", "US30", "JP225", "US2000", "NDX100",
]
FOREX = [
    "AUDCAD", "AUDCHF", "AUDJPY", "AUDNZD", "AUDSGD", "AUDUSD", "CADCHF",
    "CADJPY", "CHFJPY", "EURAUD", "EURCAD", "EURCHF", "EURGBP", "EURHKD",
    "EURHUF", "EURJPY", "EURNOK", "EURNZD", "EURSGD", "EURTRY", "EURUSD",
    "GBPAUD", "GBPCAD", "GBPCHF", "GBPJPY", "GBPNZD", "GBPSGD", "GBPUSD",
    "MXNJPY", "NOKJPY", "NZDCAD", "NZDCHF", "NZDJPY", "NZDSGD", "NZDUSD",
    "SGDJPY", "USDCAD", "USDCHF", "USDCNH", "USDDKK", "USDHKD", "USDHUF",
    "USDJPY", "USDMXN", "USDNOK", "USDPLN", "USDSEK", "USDSGD", "USDTRY",
    "USDZAR", "ZARJPY", "CADEUR",
]
ASSET_CLASSES = {
    "Crypto": CRYPTO,
    "Commodities": COMMODITIES,
    "Indices": INDICES,
    "Forex": FOREX,
}
UNKNOWN_ASSET_CLASS = "Unknown"

# --- Fixed values: live-exposure limits --------------------------------------
# (lots threshold, symbols watched; None watches the whole class)
EXPOSURE_LIMITS = {
    "Commodities": (18, ["XAUUSD"]),
    "Indices": (7, ["NDX100", "US30", "GER30", "FRA40", "EUSTX50", "US2000", "UK100", "SWI20"]),
    "Forex": (70, None),
    "Crypto": (3, ["BTCUSD"]),
}

# --- Fixed values: trading sessions (broker clock, both ends included) -------
SESSIONS = [
    ("Market-Open Session", "00:15", "02:44"),
    ("Prime Asia Session", "02:45", "08:59"),
    ("Pre London Session", "09:00", "09:59"),
    ("London Opening Session", "10:00", "10:04"),
    ("London Session", "10:05", "13:59"),
    ("Pre-NY Session", "14:00", "14:59"),
    ("NY-Open Session", "15:00", "15:04"),
    ("Pre-NYSE Session", "15:05", "16:29"),
    ("NYSE-Open Session", "16:30", "16:35"),
    ("NY Session", "16:36", "21:00"),
    ("Late Trading Hours Session", "21:01", "22:59"),
    ("Market-Closing Session", "23:00", "23:59"),
]
UNKNOWN_SESSION = "Unknown Session"
MARKET_HOURS = ("00:15", "23:59")

# --- Fixed values: pairs watched in the low-liquidity hours ------------------
LOW_LIQUIDITY_PAIRS = [
    "AUDJPY", "AUDNZD", "AUDSGD", "CADCHF", "CADJPY", "CADSGD", "CHFJPY",
    "EURCHF", "EURGBP", "EURHKD", "EURHUF", "EURJPY", "EURNOK", "EURNZD",
    "EURSGD", "EURTRY", "GBPAUD", "GBPCAD", "GBPCHF", "GBPJPY", "GBPNZD",
    "GBPSGD", "MXNJPY", "NOKJPY", "NZDCAD", "NZDCHF", "NZDJPY", "NZDSGD",
    "SGDJPY", "ZARJPY", "AUDCHF", "CADEUR",
]

# --- Fixed values: account segments and login families -----------------------
LOT_BASED_LOGIN_PREFIXES = ["70", "30"]
REAL_MARK = "real"
P2_PROGRAM_PATTERN = r"(?i)P2|Stellar 1-Step Demo"
P2_SIZE_PATTERN = r"(?i)100K|200K"

# --- Fixed values: closes that mean "still open" -----------------------------
# The broker writes 0 on either a UTC or a UTC+3 clock.
OPEN_TRADE_CLOSES = ["1970-01-01 00:00:00", "1970-01-01 03:00:00"]

# --- Fixed values: texts a CSV cell may use for "no value" -------------------
CSV_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
