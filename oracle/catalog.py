"""DuckDB statement per registered query (same names as the Spark side).

Decimal results leave DuckDB through text (``cast(cast(c as varchar) as
double)``): its own wide-decimal to double conversion is not correctly
rounded (10000486632.2 came out as 10000486632.199999), text parsing is.
"""

from __future__ import annotations

from oracle.duckdb_sql import PANELS, model, panel_sql, quality_sql, statement

# Decimal-typed output columns of each query (exact values on both sides).
DECIMAL_COLUMNS: dict[str, tuple[str, ...]] = {
    'candles_1h': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'quote_asset_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume'),
    'tickers_24h': ('price_change', 'price_change_pct', 'weighted_avg_price', 'prev_close_price', 'last_price', 'open_price', 'high_price', 'low_price', 'volume', 'quote_volume'),
    'normalize_klines': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'quote_asset_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume'),
    'normalize_trades': ('price', 'quantity', 'quote_qty'),
    'normalize_tickers': ('price_change', 'price_change_pct', 'weighted_avg_price', 'prev_close_price', 'last_price', 'open_price', 'high_price', 'low_price', 'volume', 'quote_volume'),
    'idempotent_append': ('price', 'quantity', 'quote_qty'),
    'api_snapshot_trades': ('price', 'quantity', 'quote_qty', 'trade_value_usdt'),
    'api_snapshot_klines': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'quote_asset_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume', 'price_range'),
    'stg_klines': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'quote_asset_volume', 'taker_buy_base_volume', 'taker_buy_quote_volume', 'price_range'),
    'stg_trades': ('price', 'quantity', 'quote_qty', 'trade_value_usdt'),
    'stg_tickers': ('price_change', 'price_change_pct', 'weighted_avg_price', 'prev_close_price', 'last_price', 'open_price', 'high_price', 'low_price', 'volume', 'quote_volume'),
    'latest_ticker': ('price_change', 'price_change_pct', 'weighted_avg_price', 'prev_close_price', 'last_price', 'open_price', 'high_price', 'low_price', 'volume', 'quote_volume'),
    'dedupe_latest': ('price', 'quantity', 'quote_qty', 'trade_value_usdt'),
    'price_metrics': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'price_range', 'prev_close_price'),
    'price_metrics_scaled': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'price_range', 'prev_close_price'),
    'symbol_volume': ('total_volume_usdt', 'min_trade_price', 'max_trade_price', 'buy_volume_usdt', 'sell_volume_usdt', 'last_price', 'price_change', 'price_change_pct', 'daily_high', 'daily_low', 'daily_volume', 'daily_quote_volume'),
    'symbol_volume_all_snapshots': ('total_volume_usdt', 'min_trade_price', 'max_trade_price', 'buy_volume_usdt', 'sell_volume_usdt', 'last_price', 'price_change', 'price_change_pct', 'daily_high', 'daily_low', 'daily_volume', 'daily_quote_volume'),
    'fct_candles': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'price_range', 'prev_close_price'),
    'fct_trades': ('quantity', 'quote_qty', 'trade_value_usdt', 'cumulative_volume_usdt'),
    'fct_trades_scaled': ('quantity', 'quote_qty', 'trade_value_usdt', 'cumulative_volume_usdt'),
    'fct_trades_tape': ('quantity', 'quote_qty', 'trade_value_usdt', 'cumulative_volume_usdt'),
    'fct_trades_tape_scaled': ('quantity', 'quote_qty', 'trade_value_usdt', 'cumulative_volume_usdt'),
    'dim_symbols': ('current_price', 'price_change', 'price_change_pct', 'daily_high', 'daily_low', 'daily_volume', 'daily_quote_volume', 'historical_low', 'historical_high'),
    'daily_summary': ('daily_low', 'daily_high', 'daily_open', 'daily_close', 'daily_volume'),
    'daily_summary_candle_grain': ('daily_low', 'daily_high', 'daily_open', 'daily_close', 'daily_volume'),
    'fct_candles_incremental': ('open_price', 'high_price', 'low_price', 'close_price', 'volume', 'price_range', 'prev_close_price'),
    'daily_summary_incremental': ('daily_low', 'daily_high', 'daily_open', 'daily_close', 'daily_volume'),
    'quality_checks': (),
    'panel_data_freshness': (),
    'panel_rolling_trend': (),
    'panel_volatility': (),
    'panel_volume_by_symbol': ('total_volume_usdt',),
    'panel_moving_averages': ('close_price',),
    'panel_price_history': ('close_price',),
    'panel_sentiment': ('current_price', 'price_change_pct'),
    'panel_daily_moves': (),
    'panel_volume_spikes': ('volume',),
    'panel_buy_sell_pressure': ('buy_volume_usdt', 'sell_volume_usdt'),
}


for _name, _same in (("landing_round_trip", "normalize_trades"), ("landing_arrays", "normalize_trades"), ("append_klines", "normalize_klines"),
                     ("append_trades", "idempotent_append"), ("append_tickers", "normalize_tickers"), ("tickers_sliding", "normalize_tickers"),
                     ("dim_symbols_all_snapshots", "dim_symbols"), ("fct_trades_incremental", "fct_trades"),
                     ("symbol_volume_incremental", "symbol_volume"), ("dim_symbols_incremental", "dim_symbols"),
                     ("daily_summary_candle_grain_incremental", "daily_summary_candle_grain")):
    DECIMAL_COLUMNS[_name] = DECIMAL_COLUMNS[_same]


def exact(sql: str, cols: tuple[str, ...]) -> str:
    if not cols:
        return sql
    repl = ", ".join(f"cast(cast({c} as varchar) as double) as {c}" for c in cols)
    return f"select * replace ({repl}) from ({sql}) q"


_SQL: dict[str, str] = {
    "candles_1h": model("raw_klines"),
    "tickers_24h": model("raw_tickers"),
    "tickers_sliding": model("tickers_sliding"),
    "stg_klines": model("stg_klines"),
    "stg_trades": model("stg_trades"),
    "stg_tickers": model("stg_tickers"),
    "latest_ticker": model("latest_ticker"),
    "dedupe_latest": model("tape_stg"),
    "price_metrics": model("price_metrics"),
    "symbol_volume": model("symbol_volume"),
    "symbol_volume_all_snapshots": model("symbol_volume_all_snapshots"),
    "fct_candles": model("fct_candles"),
    "fct_trades": model("fct_trades"),
    "fct_trades_tape": model("tape_fct"),
    "dim_symbols": model("dim_symbols"),
    "daily_summary": model("daily_summary"),
    "daily_summary_candle_grain": model("daily_summary_candle_grain"),
    "normalize_klines": model("norm_klines"),
    "normalize_trades": model("norm_trades"),
    "normalize_tickers": model("raw_tickers"),
    "payload_klines": model("payload_klines"),
    "payload_trades": model("payload_trades"),
    "payload_tickers": model("payload_tickers"),
    "normalize_quarantine": statement(
        "select symbol, regexp_replace(reason, 'JSON .*', 'JSON') as reason, cast(sum(records) as bigint) as records "
        "from normalize_quarantine group by 1, 2", "normalize_quarantine"),
    "landing_round_trip": model("raw_trades"),
    "landing_arrays": model("raw_trades"),
    "landing_quarantine": model("landing_quarantine"),
    "append_klines": model("raw_klines"),
    "append_trades": model("appended"),
    "append_tickers": model("raw_tickers"),
    "dim_symbols_all_snapshots": model("dim_symbols_all_snapshots"),
    "idempotent_append": model("appended"),
    "api_snapshot_trades": model("api_snapshot_trades"),
    "api_snapshot_klines": model("api_snapshot_klines"),
    "price_metrics_scaled": model("price_metrics"),
    "fct_trades_scaled": model("fct_trades"),
    "fct_trades_tape_scaled": model("tape_fct"),
    "fct_candles_incremental": statement(
        "select * from fct_candles where opened_at >= timestamp '2024-01-20 00:00:00'", "fct_candles"),
    "daily_summary_incremental": statement(
        "select * from daily_summary where trade_date >= date '2024-01-20'", "daily_summary"),
    "fct_trades_incremental": model("fct_trades"),
    "symbol_volume_incremental": model("symbol_volume"),
    "dim_symbols_incremental": model("dim_symbols"),
    "daily_summary_candle_grain_incremental": model("daily_summary_candle_grain"),
    "quality_checks": quality_sql(),
    **{name: panel_sql(name) for name in PANELS},
}

ORACLE: dict[str, str] = {k: exact(v, DECIMAL_COLUMNS.get(k, ())) for k, v in _SQL.items()}
