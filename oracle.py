"""The registered queries in plain SQL over the same parquet tables.

Written from the report definitions, not from the DataFrame code, and run by an
independent engine to check it.
"""

from __future__ import annotations

from lotwise import constants as K
from lotwise.sources import sample

WINDOW = "open_time BETWEEN 1705276800 AND 1705363199 OR close_time BETWEEN 1705276800 AND 1705363199"
REAL = "coalesce(type_account ILIKE '%real%', false)"
DEMO = f"NOT {REAL}"
UNBREACHED = f"{REAL} AND breachedby IS NULL"
P2 = "regexp_matches(type_account, '(?i)P2|Stellar 1-Step Demo') AND regexp_matches(type_account, '(?i)100K|200K')"
CLOSED = "close_epoch NOT IN (0, 10800)"


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(key: str, values) -> str:
    def sql(v):
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)

    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {sql(v)}" for i, v in enumerate(values)) + " END"


def _seconds(hhmm: str) -> int:
    return int(hhmm[:2]) * 3600 + int(hhmm[3:]) * 60


ASSET_CLASS = (
    "CASE "
    + " ".join(f"WHEN symbol IN {_list(symbols)} THEN '{name}'" for name, symbols in K.ASSET_CLASSES.items())
    + " ELSE 'Unknown' END"
)
SESSION = (
    "CASE "
    + " ".join(f"WHEN sod BETWEEN {_seconds(a)} AND {_seconds(b)} THEN '{n}'" for n, a, b in K.SESSIONS)
    + " ELSE 'Unknown Session' END"
)
CLOCK = "strftime(make_timestamp({} * 1000000), '%Y-%m-%d %H:%M:%S')"

SOURCES = f"""
ev AS (
  SELECT event_id AS id, event_type, CAST(value AS DECIMAL(18,2)) AS v,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS ot,
         user_id + {_case('user_id % 4', sample.LOGIN_BASES)} AS login
  FROM events),
tr AS (
  SELECT id, login, ot AS open_time,
         CASE WHEN id % 10 = 0 THEN ot + 2 WHEN id % 10 = 1 THEN ot + 8 WHEN id % 10 = 2 THEN ot + 120
              WHEN id % 10 = 3 THEN CASE k % 3 WHEN 0 THEN 0 WHEN 2 THEN 10800 END
              WHEN id % 10 = 4 THEN ot + 172800 WHEN id % 10 = 5 THEN ot + 600 ELSE ot + k * 300 END AS close_time,
         {_case('k % 16', sample.SYMBOLS)} AS symbol,
         CASE WHEN id % 2 = 0 THEN 'Buy' ELSE 'SELL' END AS type_str,
         CAST(v * 100 AS BIGINT) AS volume,
         CAST(v * 0.5 AS DECIMAL(18,3)) AS lots,
         CASE WHEN k = 97 THEN NULL ELSE CAST(
              v * CASE WHEN (k + id) % 2 = 0 THEN 1 ELSE -1 END
              + CASE WHEN event_type = 'purchase' THEN 5 ELSE 0 END AS DECIMAL(18,2)) END AS profit,
         CAST(-(k % 7) * 0.1 AS DECIMAL(18,2)) AS swap,
         {CLOCK.format('(ot + 10800)')} AS open_time_str
  FROM ev),
trades AS (
  SELECT *, CASE WHEN CAST(login AS VARCHAR) LIKE '70%' OR CAST(login AS VARCHAR) LIKE '30%' THEN lots
                 ELSE CAST(volume * 0.01 AS DECIMAL(18,3)) END AS final_lot,
         {CLOCK.format('(coalesce(close_time, 0) + 10800)')} AS close_time_str,
         open_time_str AS created_at, {ASSET_CLASS} AS asset_class
  FROM tr),
accounts AS (
  SELECT c_custkey + 1 AS account_id, c_custkey + {_case('c_custkey % 4', sample.LOGIN_BASES)} AS login,
         {_case('c_custkey % 7', sample.ACCOUNT_TYPES)} AS type_account,
         CAST({_case('c_custkey % 3', sample.STARTING_BALANCES)} + CAST(c_acctbal AS DECIMAL(18,2)) - 3000
              AS DECIMAL(18,2)) AS equity,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'daily_loss' WHEN 'FURNITURE' THEN 'max_loss' END AS breachedby,
         c_custkey AS customer_id,
         CAST({_case('c_custkey % 3', sample.STARTING_BALANCES)} AS DECIMAL(18,2)) AS starting_balance
  FROM customer),
customers AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_custkey % 11 <> 10 THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
         CAST(c_nationkey AS BIGINT) AS country_id
  FROM customer),
countries AS (SELECT CAST(n_nationkey AS BIGINT) AS country_id, n_name AS country_name FROM nation),
t AS (
  SELECT trades.*, type_account, equity, breachedby, starting_balance, email, country_name,
         open_time AS open_epoch, coalesce(close_time, 0) AS close_epoch,
         coalesce(close_time, 0) - open_time AS holding_time,
         CAST(floor(open_time % 86400 / 3600) AS BIGINT) AS open_hour,
         CAST(floor(coalesce(close_time, 0) % 86400 / 3600) AS BIGINT) AS close_hour,
         (open_time + 10800) % 86400 AS sod
  FROM trades JOIN accounts USING (login) JOIN customers USING (customer_id) JOIN countries USING (country_id)),
s AS (SELECT *, {SESSION} AS session FROM t)
"""


def _dbl(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def _first(column: str, name: str) -> str:
    """First non-null value by id."""
    return f"arg_min({column}, CASE WHEN {column} IS NOT NULL THEN id END) AS {name}"


def _sum(column: str, name: str) -> str:
    return _dbl(f"coalesce(sum({column}), 0)", name)


def _top(inner: str, order: str, n: int) -> str:
    return f"SELECT * FROM ({inner}) ORDER BY {order} LIMIT {n}"


def _extracts() -> dict[str, str]:
    window = f"w AS (SELECT * FROM trades WHERE {WINDOW})"
    acc = "a AS (SELECT * FROM accounts WHERE login IN (SELECT login FROM w))"
    cus = "c AS (SELECT * FROM customers WHERE customer_id IN (SELECT customer_id FROM a))"
    money = f"{_dbl('equity', 'equity')}, breachedby, customer_id, {_dbl('starting_balance', 'starting_balance')}"
    found = f"""{window}
        SELECT id, login, symbol, open_time, close_time, type_str, {_dbl('final_lot', 'final_lot')},
               {_dbl('profit', 'profit')} FROM w"""
    return {
        "extract_trades_window": found,
        "extract_trades_history": found,
        "extract_accounts": f"{window}, {acc} SELECT account_id, login, type_account, {money} FROM a",
        "extract_customers": f"{window}, {acc}, {cus} SELECT customer_id, email, country_id FROM c",
        "extract_countries": f"""{window}, {acc}, {cus} SELECT country_id, country_name FROM countries
            WHERE country_id IN (SELECT country_id FROM c)""",
        "enrich_trades": f"""SELECT id, login, symbol, asset_class, {_dbl('final_lot', 'final_lot')},
            {_dbl('profit', 'profit')}, {_dbl('swap', 'swap')}, volume, type_str, type_account,
            {_dbl('equity', 'equity')}, breachedby, {_dbl('starting_balance', 'starting_balance')}, email,
            country_name, open_time_str, close_time_str, created_at FROM s""",
        "enriched_csv_round_trip": f"""SELECT id, login, symbol, asset_class, {_dbl('final_lot', 'final_lot')},
            {_dbl('profit', 'profit')}, {_dbl('swap', 'swap')}, type_account, {_dbl('equity', 'equity')}, breachedby,
            {_dbl('starting_balance', 'starting_balance')}, email, country_name, open_time_str, created_at FROM s""",
        "final_lot": f"SELECT id, login, {_dbl('final_lot', 'final_lot')} FROM trades",
        "classify_asset_class": "SELECT id, symbol, asset_class FROM trades",
        "distinct_symbols": "SELECT DISTINCT symbol FROM s",
        "normalize_times": f"""SELECT id, {CLOCK.format('open_epoch')} AS open_time,
            {CLOCK.format('close_epoch')} AS close_time, holding_time FROM s""",
        "assign_session": "SELECT id, session FROM s",
        "segment_counts": f"""SELECT CASE WHEN {REAL} THEN 'Real' ELSE 'Demo' END AS segment,
            count(id) AS trade_count, count(DISTINCT login) AS unique_logins FROM s GROUP BY 1""",
    }


def _segment(name: str, where: str) -> dict[str, str]:
    real = name == "real"
    sessions = f"""q AS (SELECT symbol, session, coalesce(sum(profit), 0) AS p, coalesce(sum(final_lot), 0) AS l
        FROM s WHERE {where} AND symbol IS NOT NULL GROUP BY symbol, session)"""

    def best(by):
        return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {by} DESC, session) AS r
            FROM q) WHERE r = 1)"""

    def per_symbol(measures, by):
        return f"""SELECT * EXCLUDE (r) FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {by} DESC NULLS LAST, login) AS r FROM (
              SELECT symbol, login, {measures}, {_first('type_account', 'account_type')},
                     {_first('country_name', 'country_name')}
              FROM s WHERE {where} GROUP BY symbol, login)) WHERE r <= 3"""

    def hourly(hour):
        return f"""SELECT {hour}, count(id) AS trade_count, {_sum('final_lot', 'total_lots')},
            {_sum('profit', 'total_profit')}, count(DISTINCT login) AS unique_logins,
            max(country_name) FILTER (WHERE rl = 1 AND final_lot IS NOT NULL) AS highest_lot_country,
            {_dbl('max(final_lot)', 'highest_lot_country_lot')},
            max(country_name) FILTER (WHERE rp = 1 AND profit IS NOT NULL) AS highest_profit_country,
            {_dbl('max(profit)', 'highest_profit_country_profit')}
            FROM (SELECT *, row_number() OVER (PARTITION BY {hour} ORDER BY final_lot DESC NULLS LAST, id) AS rl,
                         row_number() OVER (PARTITION BY {hour} ORDER BY profit DESC NULLS LAST, id) AS rp
                  FROM s WHERE {where}) GROUP BY {hour}"""

    email = f", {_first('email', 'email')}" if real else ""
    countries = """SELECT country_name, count(id) AS trade_count, {}, {}, count(DISTINCT login) AS trader_count
        FROM s WHERE {} AND country_name IS NOT NULL GROUP BY country_name"""
    return {
        f"symbol_session_totals_{name}": f"""{sessions} SELECT symbol, session, {_dbl('p', 'session_profit')},
            {_dbl('l', 'session_lot')} FROM q""",
        f"max_profit_session_{name}": f"""{sessions} SELECT symbol, session AS max_profit_session,
            {_dbl('p', 'max_profit_session_profit')}, {_dbl('l', 'max_profit_session_lot')} FROM {best('p')}""",
        f"max_lot_session_{name}": f"""{sessions} SELECT symbol, session AS max_lot_session,
            {_dbl('l', 'final_lot')} FROM {best('l')}""",
        f"pairwise_summary_{name}": f"""{sessions},
            m AS (SELECT symbol, count(id) AS trade_count, {_sum('final_lot', 'total_lots')},
                         {_sum('profit', 'total_profit')}, count(DISTINCT login) AS unique_logins
                  FROM s WHERE {where} AND symbol IS NOT NULL GROUP BY symbol)
            SELECT m.*, bp.session AS max_profit_session, {_dbl('bp.p', 'max_profit_session_profit')},
                   {_dbl('bp.l', 'max_profit_session_lot')}, bl.session AS max_lot_session, {_dbl('bl.l', 'final_lot')}
            FROM m LEFT JOIN {best('p')} bp USING (symbol) LEFT JOIN {best('l')} bl USING (symbol)""",
        f"most_profitable_countries_{name}": _top(
            countries.format(_sum("final_lot", "total_lots"), _sum("profit", "total_profit"), where),
            "total_profit DESC, country_name", 10),
        f"most_profitable_logins_{name}": f"""top AS (SELECT country_name FROM s
              WHERE {REAL} AND country_name IS NOT NULL GROUP BY country_name
              ORDER BY coalesce(sum(profit), 0) DESC, country_name LIMIT 10)
            SELECT * EXCLUDE (r) FROM (
              SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY profit DESC, login) AS r FROM (
                SELECT country_name, login, {_sum('profit', 'profit')}, {_first('type_account', 'account_type')},
                       count(id) AS trade_count, {_sum('final_lot', 'total_lots')}{email}
                FROM s WHERE {where} AND country_name IN (SELECT country_name FROM top)
                GROUP BY country_name, login)) WHERE r <= 3""",
        f"top_logins_{name}": per_symbol(f"{_sum('profit', 'profit')}, {_sum('final_lot', 'current_pnl')}", "profit"),
        f"top_lots_per_trade_{name}": per_symbol(
            f"{_dbl('max(final_lot)', 'max_lot_per_trade')}, {_sum('profit', 'current_pnl')}", "max_lot_per_trade"),
        f"open_hour_summary_{name}": hourly("open_hour"),
        f"close_hour_summary_{name}": hourly("close_hour"),
    }


def _traders() -> dict[str, str]:
    login_lots = f"""SELECT login, count(id) AS trade_count, {_sum('final_lot', 'total_lots')},
        {_first('country_name', 'country_name')}, {_first('email', 'email')},
        {_first('type_account', 'account_type')}, {_first('created_at', 'created_at')}
        FROM s WHERE {{}} GROUP BY login"""
    pnl = f"""d AS (SELECT login, coalesce(sum(profit), 0) AS today,
          arg_max_null(equity, id) - arg_min_null(starting_balance, id) AS overall
        FROM s WHERE {REAL} GROUP BY login),
        good AS (SELECT * FROM d WHERE today > 0 AND overall > 0)"""
    symbol_pnl = f"""SELECT symbol, {_sum('profit', 'total_pnl')},
        {_sum('CASE WHEN profit > 0 THEN profit ELSE 0 END', 'positive_profit_total')}, count(id) AS trade_count
        FROM s WHERE {UNBREACHED} AND symbol IS NOT NULL GROUP BY symbol"""
    return {
        "high_pnl_traders_real": f"""
            r AS (SELECT * FROM s WHERE {REAL}),
            mode AS (SELECT login, country_name FROM (
              SELECT login, country_name, row_number() OVER (PARTITION BY login ORDER BY n DESC, country_name) AS k
              FROM (SELECT login, country_name, count(*) AS n FROM r WHERE country_name IS NOT NULL
                    GROUP BY login, country_name)) WHERE k = 1),
            best AS (SELECT login, symbol FROM (
              SELECT login, symbol, row_number() OVER (PARTITION BY login ORDER BY profit DESC, id) AS k
              FROM r WHERE profit IS NOT NULL) WHERE k = 1),
            a AS (SELECT login, {_sum('profit', 'profit')}, {_dbl('max(profit)', 'highest_profit_trade')},
                    {_dbl('max(final_lot)', 'highest_used_lot')}, {_sum('final_lot', 'total_used_lot')},
                    count(id) AS trade_count, {_first('email', 'email')} FROM r GROUP BY login)
            SELECT a.*, mode.country_name, best.symbol AS highest_profit_pair
            FROM a LEFT JOIN mode USING (login) LEFT JOIN best USING (login)
            ORDER BY profit DESC, login LIMIT 10""",
        "login_trade_lot_real": login_lots.format(REAL),
        "login_trade_lot_p2": login_lots.format(f"coalesce({P2}, false)"),
        "today_pnl_by_login": f"SELECT login, {_sum('profit', 'today_pnl')} FROM s WHERE {REAL} GROUP BY login",
        "overall_pnl_by_login": f"{pnl} SELECT login, {_dbl('overall', 'overall_pnl')} FROM d",
        "positive_pnl_traders": f"""{pnl}
            SELECT login, {_dbl('today', 'today_pnl')}, {_dbl('overall', 'overall_pnl')},
                   {_dbl('starting_balance', 'starting_balance')}
            FROM good JOIN (SELECT DISTINCT login, starting_balance FROM s WHERE {REAL}) USING (login)""",
        "positive_pnl_trades": f"""{pnl}
            SELECT id, login, symbol, {_dbl('final_lot', 'final_lot')}, {_dbl('profit', 'profit')}
            FROM s WHERE {UNBREACHED} AND login IN (SELECT login FROM good)""",
        "most_active_session_per_login": """SELECT login, session, trade_count FROM (
            SELECT *, row_number() OVER (PARTITION BY login ORDER BY trade_count DESC, session) AS r
            FROM (SELECT login, session, count(id) AS trade_count FROM s GROUP BY login, session)) WHERE r = 1""",
        "symbol_pnl_summary": symbol_pnl,
        "top_5_symbols_by_pnl": _top(symbol_pnl, "total_pnl DESC, symbol", 5),
        "top_5_symbols_by_trades": _top(symbol_pnl, "trade_count DESC, symbol", 5),
        "swap_summary": f"SELECT login, symbol, {_sum('swap', 'swap')} FROM s WHERE symbol IS NOT NULL GROUP BY 1, 2",
        "symbol_summary": f"""SELECT *, final_lot / trade_count AS final_lot_per_trade,
              final_lot / trader_count AS final_lot_per_trader FROM (
            SELECT symbol, count(id) AS trade_count, {_sum('profit', 'total_profit')},
                   count(DISTINCT login) AS trader_count,
                   {_sum('CASE WHEN profit > 0 THEN profit END', 'positive_trades_sum')},
                   {_sum('CASE WHEN profit < 0 THEN profit END', 'negative_trades_sum')},
                   {_sum('final_lot', 'final_lot')}
            FROM s WHERE symbol IS NOT NULL GROUP BY symbol)""",
    }


def _behaviour() -> dict[str, str]:
    def in_hours(where, first, last, least):
        hours = " AND ".join(f"{h} >= {first} AND {h} < {last}" for h in ("open_hour", "close_hour"))
        return f"""SELECT login, count(*) AS trade_count FROM s WHERE {where} AND {CLOSED} AND {hours}
            GROUP BY login HAVING count(*) >= {least}"""

    pairs = f"symbol IN {_list(K.LOW_LIQUIDITY_PAIRS)} AND asset_class <> 'Unknown'"
    ranges = " ".join(f"WHEN '{n}' THEN '{a} - {b}'" for n, a, b in K.SESSIONS)
    check = "login, symbol, {} AS open_time, " + _dbl("final_lot", "final_lot") + ", " + _dbl("profit", "profit")
    return {
        "hft_summary": _top(f"""
            SELECT login, count(*) FILTER (WHERE holding_time <= 9) AS trades_le_9s,
                   count(*) FILTER (WHERE holding_time <= 3) AS trades_le_3s, count(*) AS total_trades,
                   {_dbl('arg_min_null(equity, id)', 'equity')}, arg_min_null(type_account, id) AS type_account,
                   count(*) FILTER (WHERE holding_time <= 3) / CAST(count(*) AS DOUBLE) AS ratio_le_3s
            FROM s WHERE close_epoch > open_epoch GROUP BY login
            HAVING count(*) FILTER (WHERE holding_time <= 9) > 0""", "trades_le_9s DESC, login", 20),
        "settlement_forex": in_hours("asset_class = 'Forex'", 0, 1, 2),
        "settlement_indices": in_hours("asset_class = 'Indices'", 1, 2, 2),
        "ll_hour": in_hours(pairs, 22, 24, 2),
        "arbitrage_traders": f"""
            r AS (SELECT * FROM s WHERE {REAL}),
            quick AS (SELECT login, count(*) AS n FROM r WHERE holding_time <= 180 GROUP BY login),
            mode AS (SELECT login, email, type_account, country_name FROM (
              SELECT *, row_number() OVER (PARTITION BY login, email, type_account ORDER BY n DESC, country_name) AS k
              FROM (SELECT login, email, type_account, country_name, count(*) AS n FROM r
                    WHERE country_name IS NOT NULL GROUP BY 1, 2, 3, 4)) WHERE k = 1),
            g AS (SELECT login, email, type_account,
                    CAST(sum(holding_time) AS DOUBLE) / count(holding_time) / 60 AS average_holding_time,
                    max(holding_time) / CAST(60 AS DOUBLE) AS max_holding_time,
                    min(holding_time) / CAST(60 AS DOUBLE) AS min_holding_time,
                    count(id) AS trade_count, {_sum('final_lot', 'total_used_lot')}, {_sum('profit', 'total_profit')}
                  FROM r WHERE email IS NOT NULL AND type_account IS NOT NULL GROUP BY 1, 2, 3)
            SELECT g.*, coalesce(n, 0) AS trades_within_3_min,
                   coalesce(n, 0) / CAST(trade_count AS DOUBLE) * 100 AS trades_within_3_min_pct,
                   mode.country_name AS country
            FROM g LEFT JOIN quick USING (login) LEFT JOIN mode USING (login, email, type_account)""",
        "session_summary": f"""SELECT session, CASE session {ranges} END AS session_time_range, lot_used,
              number_of_trades, total_pnl, total_pnl / np AS average_pnl, lot_used / nl AS average_lot FROM (
            SELECT session, {_sum('final_lot', 'lot_used')}, count(id) AS number_of_trades,
                   {_sum('profit', 'total_pnl')}, count(profit) AS np, count(final_lot) AS nl
            FROM s WHERE {UNBREACHED} AND session <> 'Unknown Session' GROUP BY session)""",
        "missing_open_time": f"""SELECT {check.format('CAST(NULL AS VARCHAR)')}
            FROM s WHERE {UNBREACHED} AND id % 97 = 0""",
        "outlier_open_time": f"""SELECT {check.format(CLOCK.format('open_epoch'))}
            FROM s WHERE {UNBREACHED} AND (open_epoch % 86400 < 900 OR open_epoch % 86400 > 86340)""",
    }


def _exposure() -> dict[str, str]:
    # Live lots per trade pair: j is live when i opens. Grouped per opening
    # trade and symbol, then summed in absolute terms.
    def watch(name):
        symbols = K.EXPOSURE_LIMITS[name][1]
        return f"(asset_class = '{name}'" + (f" AND symbol IN {_list(symbols)})" if symbols else ")")

    def breaches(*names):
        limit = " ".join(f"WHEN '{n}' THEN {K.EXPOSURE_LIMITS[n][0]}" for n in names)
        return f"""
        x AS (SELECT *, CASE WHEN lower(type_str) = 'buy' THEN final_lot ELSE -final_lot END AS q
              FROM s WHERE {' OR '.join(watch(n) for n in names)}),
        net AS (SELECT i.login, i.asset_class, i.id, j.symbol, abs(sum(j.q)) AS n
              FROM x i JOIN x j ON i.login = j.login AND i.asset_class = j.asset_class
               AND (j.id = i.id OR ((j.open_epoch < i.open_epoch OR (j.open_epoch = i.open_epoch AND j.id < i.id))
                                    AND j.close_epoch >= i.open_epoch))
              GROUP BY 1, 2, 3, 4),
        peak AS (SELECT login, asset_class, max(e) AS e FROM (
              SELECT login, asset_class, id, sum(n) AS e FROM net GROUP BY 1, 2, 3) GROUP BY 1, 2),
        b AS (SELECT asset_class, login, {_dbl('e', 'max_total_lots')}, {_dbl('h.equity', 'equity')}, h.package_type,
                     h.breachedby, {_dbl('h.equity - h.starting_balance', 'pnl')}
              FROM peak JOIN (SELECT login, asset_class, arg_min_null(equity, id) AS equity,
                     arg_min_null(type_account, id) AS package_type, arg_min_null(breachedby, id) AS breachedby,
                     arg_min_null(starting_balance, id) AS starting_balance FROM x GROUP BY 1, 2) h
              USING (login, asset_class)
              WHERE e >= CASE asset_class {limit} END)"""

    columns = ["login", "max_total_lots", "equity", "package_type", "breachedby", "pnl"]
    cells = ", ".join(
        f"max({c}) FILTER (WHERE asset_class = '{n}') AS {n.lower()}_{c}" for n in K.EXPOSURE_LIMITS for c in columns
    )
    out = {f"exposure_{n.lower()}": f"{breaches(n)} SELECT {', '.join(columns)} FROM b" for n in K.EXPOSURE_LIMITS}
    out["exposure_sliced"] = f"{breaches(*K.EXPOSURE_LIMITS)} SELECT asset_class, {', '.join(columns)} FROM b"
    out["exposure_of_segments"] = out["exposure_sliced"]
    out["exposure_combined"] = f"""{breaches(*K.EXPOSURE_LIMITS)},
        p AS (SELECT *, row_number() OVER (PARTITION BY asset_class ORDER BY login) AS position FROM b)
        SELECT position, {cells} FROM p GROUP BY position"""
    return out


def statements() -> dict[str, str]:
    tails = {
        **_extracts(),
        **_segment("real", REAL),
        **_segment("demo", DEMO),
        **_traders(),
        **_behaviour(),
        **_exposure(),
    }
    # the same trades, summed by day and merged
    for name in ("positive_pnl_traders", "arbitrage_traders", "hft_summary"):
        tails[f"{name}_of_days"] = tails[name]
    return {
        name: f"WITH {SOURCES}{', ' if not tail.lstrip().startswith('SELECT') else ''}{tail}"
        for name, tail in tails.items()
    }
