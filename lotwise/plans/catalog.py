"""The report set: 29 named tables over one set of enriched trades."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from lotwise.operators.cells import as_cells
from lotwise.operators.shared import GRAINS, grain
from lotwise.plans import behaviour, countries, exposures, hours, quality, sessions, symbols, traders
from lotwise.plans.segments import demo, p2, real, real_unbreached

Report = Callable[[DataFrame, DataFrame], DataFrame]

# Each report takes (trades, cells) and uses one of them.
REPORTS: dict[str, Report] = {
    "pairwise_summary_real": lambda t, c: symbols.pairwise_summary(real(c)),
    "pairwise_summary_demo": lambda t, c: symbols.pairwise_summary(demo(c)),
    "hft_summary": lambda t, c: behaviour.hft_summary(t),
    "high_pnl_traders_real": lambda t, c: traders.high_pnl_traders(real(t)),
    "login_trade_lot_real": lambda t, c: traders.login_trade_lot(real(t)),
    "login_trade_lot_p2": lambda t, c: traders.login_trade_lot(p2(t)),
    "exposure_combined": lambda t, c: exposures.exposure_combined(t),
    "most_profitable_countries_real": lambda t, c: countries.most_profitable_countries(real(c)),
    "most_profitable_countries_demo": lambda t, c: countries.most_profitable_countries(demo(c)),
    "most_profitable_logins_real": lambda t, c: countries.most_profitable_logins(real(c), ranked_on=real(c)),
    "most_profitable_logins_demo": lambda t, c: countries.most_profitable_logins(
        demo(c), ranked_on=real(c), with_email=False
    ),
    "top_logins_real": lambda t, c: symbols.top_logins(real(c)),
    "top_logins_demo": lambda t, c: symbols.top_logins(demo(c)),
    "top_lots_per_trade_real": lambda t, c: symbols.top_lots_per_trade(real(c)),
    "top_lots_per_trade_demo": lambda t, c: symbols.top_lots_per_trade(demo(c)),
    "swap_summary": lambda t, c: symbols.swap_summary(c),
    "open_hour_summary_real": lambda t, c: hours.open_hour_summary(real(t)),
    "open_hour_summary_demo": lambda t, c: hours.open_hour_summary(demo(t)),
    "close_hour_summary_real": lambda t, c: hours.close_hour_summary(real(t)),
    "close_hour_summary_demo": lambda t, c: hours.close_hour_summary(demo(t)),
    "symbol_summary": lambda t, c: symbols.symbol_summary(c),
    "settlement_forex": lambda t, c: behaviour.settlement_forex(t),
    "settlement_indices": lambda t, c: behaviour.settlement_indices(t),
    "ll_hour": lambda t, c: behaviour.ll_hour(t),
    "arbitrage_traders": lambda t, c: behaviour.arbitrage_traders(real(t)),
    "positive_pnl_traders": lambda t, c: traders.positive_pnl_traders(real(t)),
    "top_5_symbols_by_pnl": lambda t, c: symbols.top_symbols(real_unbreached(c), "total_pnl"),
    "top_5_symbols_by_trades": lambda t, c: symbols.top_symbols(real_unbreached(c), "trade_count"),
    "session_summary": lambda t, c: sessions.session_summary(real_unbreached(c)),
}

# The same reports from the shared passes (operators.shared): g has the cells of each key set, h the accounts. A report
# that is not here needs single trades.
Shared = Callable[[DataFrame, dict[str, DataFrame], DataFrame], DataFrame]
SHARED: dict[str, Shared] = {
    "pairwise_summary_real": lambda t, g, h: symbols.pairwise_summary(real(g["session"]), real(g["pair"])),
    "pairwise_summary_demo": lambda t, g, h: symbols.pairwise_summary(demo(g["session"]), demo(g["pair"])),
    "hft_summary": lambda t, g, h: behaviour.hft_of(h),
    "high_pnl_traders_real": lambda t, g, h: traders.high_pnl_traders(real(t), ranked_on=real(g["account"])),
    "most_profitable_countries_real": lambda t, g, h: countries.most_profitable_countries(real(g["account"])),
    "most_profitable_countries_demo": lambda t, g, h: countries.most_profitable_countries(demo(g["account"])),
    "most_profitable_logins_real": lambda t, g, h: countries.most_profitable_logins(
        real(g["account"]), ranked_on=real(g["account"])),
    "most_profitable_logins_demo": lambda t, g, h: countries.most_profitable_logins(
        demo(g["account"]), ranked_on=real(g["account"]), with_email=False),
    "top_logins_real": lambda t, g, h: symbols.top_logins(real(g["pair"])),
    "top_logins_demo": lambda t, g, h: symbols.top_logins(demo(g["pair"])),
    "top_lots_per_trade_real": lambda t, g, h: symbols.top_lots_per_trade(real(g["pair"])),
    "top_lots_per_trade_demo": lambda t, g, h: symbols.top_lots_per_trade(demo(g["pair"])),
    "swap_summary": lambda t, g, h: symbols.swap_summary(g["pair"]),
    "open_hour_summary_real": lambda t, g, h: hours.hour_summary(real(g["open_hour"]), "open_hour", real(g["open_login"])),
    "open_hour_summary_demo": lambda t, g, h: hours.hour_summary(demo(g["open_hour"]), "open_hour", demo(g["open_login"])),
    "close_hour_summary_real": lambda t, g, h: hours.hour_summary(real(g["close_hour"]), "close_hour", real(g["close_login"])),
    "close_hour_summary_demo": lambda t, g, h: hours.hour_summary(demo(g["close_hour"]), "close_hour", demo(g["close_login"])),
    "symbol_summary": lambda t, g, h: symbols.symbol_summary(g["pair"]),
    "settlement_forex": lambda t, g, h: behaviour.often(h, "forex_settlement"),
    "settlement_indices": lambda t, g, h: behaviour.often(h, "indices_settlement"),
    "ll_hour": lambda t, g, h: behaviour.often(h, "illiquid"),
    "arbitrage_traders": lambda t, g, h: behaviour.arbitrage_of(real(h)),
    "positive_pnl_traders": lambda t, g, h: traders.positive_pnl_of(real(g["balance"])),
    "top_5_symbols_by_pnl": lambda t, g, h: symbols.top_symbols(real_unbreached(g["session"]), "total_pnl"),
    "top_5_symbols_by_trades": lambda t, g, h: symbols.top_symbols(real_unbreached(g["session"]), "trade_count"),
    "session_summary": lambda t, g, h: sessions.session_summary(real_unbreached(g["session"])),
}

# Reports that the shared passes serve without the trades.
TRADELESS = [name for name in SHARED if name != "high_pnl_traders_real"]

# Data-quality checks over trades; they use the real accounts in good standing.
CHECKS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "missing_open_time": lambda t: quality.missing_open_time(real_unbreached(t)),
    "outlier_open_time": lambda t: quality.outlier_open_time(real_unbreached(t)),
}


def report_builders(trades: DataFrame, cells: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Builders of all reports over normalised trades.

    ``cells`` may be a rolled-up table of the same trades; by default each
    report aggregates the trades itself. Building the exposure report runs
    jobs, the others only describe a plan.
    """
    cells = as_cells(trades) if cells is None else cells
    return {name: partial(report, trades, cells) for name, report in REPORTS.items()}


def shared_builders(trades: DataFrame, grains: DataFrame, holders: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Builders of all reports, those in ``SHARED`` over stored tables of the shared passes."""
    cells = {name: grain(grains, name) for name in GRAINS}
    return report_builders(trades) | {name: partial(report, trades, cells, holders) for name, report in SHARED.items()}


def build_reports(trades: DataFrame, cells: DataFrame | None = None) -> dict[str, DataFrame]:
    """All reports, see ``report_builders``."""
    return {name: build() for name, build in report_builders(trades, cells).items()}
