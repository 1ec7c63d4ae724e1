"""DuckDB statements that compute every registered query independently.

Each model is one CTE over the driver's pre-registered views (``events``,
``lineitem``, ...).  ``statement(name)`` returns ``WITH <needed CTEs> SELECT
... FROM <name>``; dependencies are pulled in automatically.

Engine differences handled here (probed against the Spark side):

* ``epoch_ms(timestamp)`` rounds microseconds, Spark floors: use
  ``epoch_us(ts) // 1000``.
* ``decimal(18,8) * decimal(18,8)`` overflows in DuckDB: widen to
  ``decimal(38,8)`` first.
* ``avg`` and ``/`` on decimals return DOUBLE; every ratio and average is
  therefore computed in double on both sides and rounded through
  ``decimal(38,10)`` (macro ``r(x, n)``).
* ``rank``/``row_number``/``hour`` return BIGINT here and INT in Spark, and
  ``sum(int)`` returns HUGEINT: cast to the Spark types.
"""

from __future__ import annotations


def r(expr: str, scale: int = 4) -> str:
    return f"cast(round(cast(({expr}) as decimal(38,10)), {scale}) as double)"


def pct(num: str, den: str) -> str:
    return f"cast(({num}) as double) / nullif(cast(({den}) as double), 0) * 100"


def ratio(num: str, den: str) -> str:
    return f"cast(({num}) as double) / nullif(cast(({den}) as double), 0)"


def wide_mul(a: str, b: str) -> str:
    return f"(cast({a} as decimal(38,8)) * cast({b} as decimal(38,8)))"


def ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def bars(source: str, bucket_ms: int, copies: int = 1) -> str:
    """Aggregates of tumbling buckets, or of windows of ``copies`` buckets that slide by one."""
    notional = wide_mul("price", "quantity")
    taker = "not coalesce(is_buyer_maker, false)"
    return f"""
    select symbol, trade_time - ((trade_time % {bucket_ms}) + {bucket_ms}) % {bucket_ms} - step * {bucket_ms} as open_time,
           first(price order by trade_time, trade_id) as open_price,
           max(price) as high_price,
           min(price) as low_price,
           last(price order by trade_time, trade_id) as close_price,
           sum(quantity) as volume,
           sum({notional}) as quote_volume,
           count(*) as trade_count,
           sum(case when {taker} then quantity else 0 end) as taker_base,
           sum(case when {taker} then {notional} else 0 end) as taker_quote
    from {source}, range({copies}) steps(step)
    where trade_time is not null
    group by all"""


def stg_trades_sql(raw: str) -> str:
    return f"""
    select * from (
      select *, cast(row_number() over (
                partition by trade_key
                order by extracted_at desc nulls first, symbol asc nulls last, trade_id asc nulls last,
                         traded_at asc nulls last, price asc nulls last, quantity asc nulls last,
                         quote_qty asc nulls last, trade_direction asc nulls last) as integer) as row_num
      from (
        select symbol || '_' || cast(trade_id as varchar) as trade_key,
               symbol, trade_id,
               epoch_ms(trade_time) as traded_at,
               price, quantity, quote_qty,
               {wide_mul('price', 'quantity')} as trade_value_usdt,
               case when is_buyer_maker = true then 'sell' else 'buy' end as trade_direction,
               extracted_at
        from {raw}
      ) cleaned
    ) d where row_num = 1"""


def fct_trades_sql(stg: str) -> str:
    w = "partition by symbol order by traded_at, trade_id"
    return f"""
    select trade_key, symbol, trade_id, traded_at,
           cast(traded_at as date) as trade_date,
           cast(hour(traded_at) as integer) as trade_hour,
           quantity, quote_qty, trade_value_usdt, trade_direction,
           case when trade_value_usdt >= 100000 then 'whale'
                when trade_value_usdt >= 10000 then 'large'
                when trade_value_usdt >= 1000 then 'medium'
                else 'small' end as trade_size_category,
           {r(ratio('trade_value_usdt', f'avg(trade_value_usdt) over ({w} rows between 9 preceding and current row)'))} as relative_size,
           sum(trade_value_usdt) over ({w} rows between unbounded preceding and current row) as cumulative_volume_usdt
    from {stg}"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------- raw layer
cte("raw_trades", (), f"""
    select upper(event_type) || 'USDT' as symbol,
           event_id as trade_id,
           cast(value as decimal(18,8)) as price,
           cast(json_extract_string(props, '$.k') as decimal(18,8)) as quantity,
           cast({wide_mul('cast(value as decimal(18,8))', "cast(json_extract_string(props, '$.k') as decimal(18,8))")} as decimal(28,8)) as quote_qty,
           {ms('ts')} as trade_time,
           (user_id % 2 = 0) as is_buyer_maker,
           ts as extracted_at
    from events""")

cte("hour_bars", ("raw_trades",), bars("raw_trades", 3_600_000))
cte("raw_klines", ("hour_bars",), """
    select symbol, open_time, open_price, high_price, low_price, close_price,
           cast(volume as decimal(28,8)) as volume,
           open_time + 3599999 as close_time,
           cast(quote_volume as decimal(28,8)) as quote_asset_volume,
           cast(trade_count as integer) as number_of_trades,
           cast(taker_base as decimal(28,8)) as taker_buy_base_volume,
           cast(taker_quote as decimal(28,8)) as taker_buy_quote_volume,
           epoch_ms(open_time + 3600000) as extracted_at
    from hour_bars""")

cte("day_bars", ("raw_trades",), bars("raw_trades", 86_400_000))


def tickers_sql(source: str, prev: str) -> str:
    return f"""
    select symbol,
           cast(close_price - open_price as decimal(18,8)) as price_change,
           cast(round(cast({pct('close_price - open_price', 'open_price')} as decimal(38,10)), 3) as decimal(18,8)) as price_change_pct,
           cast(round(cast({ratio('quote_volume', 'volume')} as decimal(38,10)), 8) as decimal(18,8)) as weighted_avg_price,
           lag(close_price) over (partition by {prev} order by open_time) as prev_close_price,
           close_price as last_price, open_price, high_price, low_price,
           cast(volume as decimal(28,8)) as volume,
           cast(quote_volume as decimal(28,8)) as quote_volume,
           open_time,
           open_time + 86400000 as close_time,
           cast(trade_count as integer) as count,
           epoch_ms(open_time + 86400000) as extracted_at
    from {source}"""


cte("raw_tickers", ("day_bars",), tickers_sql("day_bars", "symbol"))
cte("sliding_bars", ("raw_trades",), bars("raw_trades", 3_600_000, copies=24))
cte("tickers_sliding", ("sliding_bars",), tickers_sql("sliding_bars", "symbol, open_time % 86400000"))

cte("tape_raw", (), f"""
    select l_returnflag || l_linestatus || 'USDT' as symbol,
           l_orderkey * 10 + l_linenumber as trade_id,
           cast(l_extendedprice as decimal(18,8)) as price,
           cast(l_quantity as decimal(18,8)) as quantity,
           cast({wide_mul('cast(l_extendedprice as decimal(18,8))', 'cast(l_quantity as decimal(18,8))')} as decimal(28,8)) as quote_qty,
           {ms('l_shipdate')} as trade_time,
           (l_partkey % 2 = 0) as is_buyer_maker,
           l_shipdate + to_seconds(l_partkey % 86400) as extracted_at
    from lineitem""")

# ------------------------------------------------------------------ staging
cte("stg_klines", ("raw_klines",), """
    select * from (
      select *, cast(row_number() over (
                partition by kline_id
                order by extracted_at desc nulls first, symbol asc nulls last, opened_at asc nulls last,
                         closed_at asc nulls last, open_price asc nulls last, high_price asc nulls last,
                         low_price asc nulls last, close_price asc nulls last, volume asc nulls last,
                         quote_asset_volume asc nulls last, number_of_trades asc nulls last,
                         taker_buy_base_volume asc nulls last, taker_buy_quote_volume asc nulls last
                ) as integer) as row_num
      from (
        select symbol || '_' || cast(open_time as varchar) as kline_id,
               symbol,
               epoch_ms(open_time) as opened_at,
               epoch_ms(close_time) as closed_at,
               open_price, high_price, low_price, close_price, volume, quote_asset_volume,
               cast(number_of_trades as integer) as number_of_trades,
               taker_buy_base_volume, taker_buy_quote_volume,
               high_price - low_price as price_range,
               case when close_price >= open_price then 'bullish' else 'bearish' end as candle_direction,
               extracted_at
        from raw_klines
      ) cleaned
    ) d where row_num = 1""")

cte("stg_trades", ("raw_trades",), stg_trades_sql("raw_trades"))
cte("tape_stg", ("tape_raw",), stg_trades_sql("tape_raw"))

cte("stg_tickers", ("raw_tickers",), f"""
    select symbol, price_change, price_change_pct, weighted_avg_price, prev_close_price,
           last_price, open_price, high_price, low_price, volume, quote_volume,
           count as trade_count,
           epoch_ms(open_time) as period_start,
           epoch_ms(close_time) as period_end,
           {r(pct('high_price - low_price', 'open_price'))} as price_spread_pct,
           extracted_at
    from raw_tickers""")

cte("latest_ticker", ("stg_tickers",), """
    select * exclude (rn) from (
      select *, row_number() over (partition by symbol
                                   order by extracted_at desc nulls first, period_start desc nulls first) as rn
      from stg_tickers) x
    where rn = 1""")

# ------------------------------------------------------------- intermediate
_W = "partition by symbol order by opened_at"


def _trail(rows: int) -> str:
    return f"({_W} rows between {rows - 1} preceding and current row)"


cte("price_metrics", ("stg_klines",), f"""
    select kline_id, symbol, opened_at, closed_at, open_price, high_price, low_price, close_price,
           volume, number_of_trades, candle_direction, price_range,
           lag(close_price) over ({_W}) as prev_close_price,
           {r(pct(f'close_price - lag(close_price) over ({_W})', f'lag(close_price) over ({_W})'))} as pct_return,
           {r(f'avg(close_price) over {_trail(7)}')} as ma_7,
           {r(f'avg(close_price) over {_trail(14)}')} as ma_14,
           {r(f'avg(close_price) over {_trail(30)}')} as ma_30,
           {r(f'stddev_samp(close_price) over {_trail(7)}')} as volatility_7,
           {r(f'avg(volume) over {_trail(7)}')} as avg_volume_7,
           {r(ratio('volume', f'avg(volume) over {_trail(7)}'))} as volume_ratio,
           {r(pct('abs(close_price - open_price)', 'price_range'))} as body_pct_of_range,
           cast(rank() over (partition by opened_at order by close_price desc nulls first) as integer) as price_rank
    from stg_klines""")


def trade_summary_sql(stg: str) -> str:
    tv = "trade_value_usdt"
    return f"""
    select symbol,
           count(*) as total_trades,
           round(sum({tv}), 2) as total_volume_usdt,
           {r(f'avg({tv})')} as avg_trade_value_usdt,
           round(min(price), 4) as min_trade_price,
           round(max(price), 4) as max_trade_price,
           count_if(trade_direction = 'buy') as buy_trades,
           count_if(trade_direction = 'sell') as sell_trades,
           {r(pct("count_if(trade_direction = 'buy')", 'count(*)'), 2)} as buy_pressure_pct,
           sum(case when trade_direction = 'buy' then {tv} else 0 end) as buy_volume_usdt,
           sum(case when trade_direction = 'sell' then {tv} else 0 end) as sell_volume_usdt
    from {stg}
    group by symbol"""


cte("trade_summary", ("stg_trades",), trade_summary_sql("stg_trades"))


def symbol_volume_sql(tickers: str) -> str:
    return f"""
    select ts.*,
           tk.last_price, tk.price_change, tk.price_change_pct,
           tk.high_price as daily_high, tk.low_price as daily_low,
           tk.volume as daily_volume, tk.quote_volume as daily_quote_volume,
           tk.trade_count as daily_trade_count, tk.price_spread_pct,
           {r(pct('ts.total_volume_usdt', 'sum(ts.total_volume_usdt) over ()'), 2)} as volume_dominance_pct,
           cast(rank() over (order by ts.total_volume_usdt desc nulls first) as integer) as volume_rank,
           cast(rank() over (order by tk.price_change_pct desc nulls first) as integer) as momentum_rank
    from trade_summary ts left join {tickers} tk using (symbol)"""


cte("symbol_volume", ("trade_summary", "latest_ticker"), symbol_volume_sql("latest_ticker"))
cte("symbol_volume_all_snapshots", ("trade_summary", "stg_tickers"), symbol_volume_sql("stg_tickers"))

# -------------------------------------------------------------------- marts
cte("fct_candles", ("price_metrics",), """
    select kline_id, symbol, opened_at, closed_at,
           cast(opened_at as date) as trade_date,
           cast(hour(opened_at) as integer) as trade_hour,
           rpad(dayname(opened_at), 9, ' ') as day_of_week,
           open_price, high_price, low_price, close_price, volume, number_of_trades,
           price_range, candle_direction, body_pct_of_range, prev_close_price, pct_return,
           case when abs(pct_return) >= 3 then 'high_move'
                when abs(pct_return) >= 1 then 'medium_move'
                when abs(pct_return) >= 0.1 then 'small_move'
                else 'flat' end as move_category,
           ma_7, ma_14, ma_30,
           case when ma_7 > ma_14 then 'golden_cross'
                when ma_7 < ma_14 then 'death_cross'
                else 'neutral' end as ma_signal,
           avg_volume_7, volume_ratio,
           case when volume_ratio >= 2.0 then 'high_volume_spike'
                when volume_ratio >= 1.5 then 'elevated_volume'
                else 'normal_volume' end as volume_signal,
           price_rank, volatility_7
    from price_metrics""")

cte("fct_trades", ("stg_trades",), fct_trades_sql("stg_trades"))
cte("tape_fct", ("tape_stg",), fct_trades_sql("tape_stg"))

cte("kline_stats", ("stg_klines",), f"""
    select symbol,
           min(opened_at) as first_seen_at,
           max(opened_at) as last_seen_at,
           count(*) as total_candles,
           round(min(close_price), 4) as historical_low,
           round(max(close_price), 4) as historical_high,
           {r('avg(close_price)')} as avg_close_price
    from stg_klines group by symbol""")


def dim_symbols_sql(tickers: str) -> str:
    return f"""
    select t.symbol,
           case when length(t.symbol) >= 4 then left(t.symbol, length(t.symbol) - 4)
                else left(t.symbol, greatest(2 * length(t.symbol) - 4, 0)) end as base_asset,
           right(t.symbol, 4) as quote_asset,
           t.last_price as current_price, t.price_change, t.price_change_pct,
           t.high_price as daily_high, t.low_price as daily_low,
           t.volume as daily_volume, t.quote_volume as daily_quote_volume,
           t.trade_count as daily_trade_count, t.price_spread_pct,
           case when t.price_change_pct > 5 then 'strongly_bullish'
                when t.price_change_pct > 1 then 'bullish'
                when t.price_change_pct > -1 then 'neutral'
                when t.price_change_pct > -5 then 'bearish'
                else 'strongly_bearish' end as market_sentiment,
           k.first_seen_at, k.last_seen_at, k.total_candles, k.historical_low, k.historical_high,
           k.avg_close_price,
           {r(pct('t.last_price - k.historical_high', 'k.historical_high'), 2)} as pct_from_high,
           timestamp '2024-02-01 00:00:00' as last_updated_at
    from {tickers} t left join kline_stats k using (symbol)"""


cte("dim_symbols", ("latest_ticker", "kline_stats"), dim_symbols_sql("latest_ticker"))


cte("dim_symbols_all_snapshots", ("stg_tickers", "kline_stats"), dim_symbols_sql("stg_tickers"))

# Payload texts, every place and field written out.
cte("payload_klines", ("raw_klines",), """
    select symbol, max(extracted_at) as extracted_at,
           '[' || string_agg(
               '["' || open_time || '","' || open_price || '","' || high_price || '","' || low_price || '","'
               || close_price || '","' || volume || '","' || close_time || '","' || quote_asset_volume || '","'
               || number_of_trades || '","' || taker_buy_base_volume || '","' || taker_buy_quote_volume || '"]',
               ',' order by open_time) || ']' as payload
    from raw_klines group by symbol, floor(open_time / 360000000)""")
cte("payload_trades", ("raw_trades",), """
    select symbol, max(extracted_at) as extracted_at,
           '[' || string_agg(
               '{"id":' || trade_id || ',"price":"' || price || '","qty":"' || quantity || '","quoteQty":"' || quote_qty
               || '","time":' || trade_time || coalesce(',"isBuyerMaker":' || is_buyer_maker, '') || '}',
               ',' order by trade_id) || ']' as payload
    from raw_trades group by symbol, trade_id // 100""")
cte("payload_tickers", ("raw_tickers",), """
    select extracted_at,
           '{"symbol":"' || symbol || '"'
           || coalesce(',"priceChange":"' || price_change || '"', '')
           || coalesce(',"priceChangePercent":"' || price_change_pct || '"', '')
           || coalesce(',"weightedAvgPrice":"' || weighted_avg_price || '"', '')
           || coalesce(',"prevClosePrice":"' || prev_close_price || '"', '')
           || ',"lastPrice":"' || last_price || '","openPrice":"' || open_price || '","highPrice":"' || high_price
           || '","lowPrice":"' || low_price || '","volume":"' || volume || '","quoteVolume":"' || quote_volume
           || '","openTime":' || open_time || ',"closeTime":' || close_time || ',"count":' || "count" || '}' as payload
    from raw_tickers""")
cte("landing_quarantine", ("raw_trades",), """
    select case trade_id % 50 when 7 then 'trade_id: missing' when 9 then 'price: not decimal(18,8)'
                when 11 then 'trade_time: not bigint' when 13 then 'record: not JSON' else 'none' end as reason,
           count(*) as records
    from raw_trades group by 1""")

cte("normalize_quarantine", ("raw_trades",), """
    select symbol, reason, count(*) as records from (
        select symbol,
               case when regexp_matches(cast(trade_id as varchar), '[05]7$') then 'trade_id: not bigint'
                    when regexp_matches(cast(trade_id as varchar), '[05]9$') then 'price: not decimal(18,8)' end as reason
        from raw_trades where (trade_id // 100) % 7 <> 3
        union all
        select distinct symbol, 'payload: not the expected JSON ' || (trade_id // 100) from raw_trades
        where (trade_id // 100) % 7 = 3
    ) where reason is not null
    group by symbol, reason""")


def _daily_aggs() -> str:
    return f"""
           round(min(low_price), 4) as daily_low,
           round(max(high_price), 4) as daily_high,
           {r('avg(close_price)')} as daily_avg_price,
           round(sum(volume), 4) as daily_volume,
           cast(sum(number_of_trades) as bigint) as daily_trades,
           count(*) as total_candles,
           {r(pct('max(high_price) - min(low_price)', 'min(low_price)'))} as daily_volatility_pct,
           {r('avg(volatility_7)')} as avg_intraday_volatility,
           count_if(candle_direction = 'bullish') as bullish_candles,
           count_if(candle_direction = 'bearish') as bearish_candles,
           count_if(volume_signal = 'high_volume_spike') as volume_spikes,
           count_if(volume_signal = 'elevated_volume') as elevated_volume_candles,
           count_if(ma_signal = 'golden_cross') as golden_cross_hours,
           count_if(ma_signal = 'death_cross') as death_cross_hours,
           {r('avg(ma_7)')} as avg_ma_7,
           {r('avg(ma_14)')} as avg_ma_14,
           {r('avg(ma_30)')} as avg_ma_30"""


_DAILY_OUT = """trade_date, symbol, daily_low, daily_high, daily_avg_price, daily_open, daily_close,
           daily_volume, daily_trades, total_candles, daily_volatility_pct, avg_intraday_volatility,
           bullish_candles, bearish_candles, volume_spikes, elevated_volume_candles,
           golden_cross_hours, death_cross_hours, avg_ma_7, avg_ma_14, avg_ma_30"""


def _trend(order: str) -> str:
    w = f"partition by symbol order by {order}"
    lagv = f"lag(daily_volume) over ({w})"
    return f"""
           {r(pct('daily_close - daily_open', 'daily_open'))} as daily_return_pct,
           {r(f'avg(daily_avg_price) over ({w} rows between 6 preceding and current row)')} as rolling_7d_avg_price,
           {r(pct(f'daily_volume - {lagv}', lagv), 2)} as volume_change_pct"""


cte("daily_day", ("fct_candles",), f"""
    select trade_date, symbol, {_daily_aggs()},
           arg_min(open_price, opened_at) as daily_open,
           arg_max(close_price, opened_at) as daily_close
    from fct_candles group by trade_date, symbol""")
cte("daily_summary", ("daily_day",), f"""
    select {_DAILY_OUT}, {_trend('trade_date')}
    from daily_day""")

cte("daily_candle_groups", ("fct_candles",), f"""
    select trade_date, symbol, opened_at, open_price, close_price, {_daily_aggs()}
    from fct_candles group by trade_date, symbol, opened_at, open_price, close_price""")
cte("daily_candle_windows", ("daily_candle_groups",), """
    select *,
           first_value(open_price) over d as daily_open,
           last_value(close_price) over d as daily_close
    from daily_candle_groups
    window d as (partition by trade_date, symbol order by opened_at
                 rows between unbounded preceding and unbounded following)""")
cte("daily_summary_candle_grain", ("daily_candle_windows",), f"""
    select distinct {_DAILY_OUT}, {_trend('trade_date, opened_at')}
    from daily_candle_windows""")


def _closure(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def statement(select: str, *needs: str) -> str:
    """``WITH`` every CTE that ``needs`` depends on, then ``select``."""
    parts = [f"{n} as ({CTES[n][1]}\n)" for n in _closure(list(needs))]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select


def model(name: str) -> str:
    return statement(f"select * from {name}", name)


# ------------------------------------------------------- payload round trips
cte("norm_klines", ("raw_klines",), """
    select * replace (max(extracted_at) over (partition by symbol, open_time // 360000000) as extracted_at)
    from raw_klines""")
cte("norm_trades", ("raw_trades",), """
    select * replace (max(extracted_at) over (partition by symbol, trade_id // 100) as extracted_at)
    from raw_trades""")

# ------------------------------------------------------- idempotent append
_TAPE_ORDER = ("extracted_at asc nulls last, price asc nulls last, quantity asc nulls last, "
               "quote_qty asc nulls last, trade_time asc nulls last, is_buyer_maker asc nulls last")


def first_wins_sql(src: str) -> str:
    return f"""
    select * exclude (rn) from (
      select *, row_number() over (partition by symbol, trade_id order by {_TAPE_ORDER}) as rn
      from {src} where symbol is not null and trade_id is not null) k
    where rn = 1
    union all
    select * from {src} where symbol is null or trade_id is null"""


cte("load1", ("tape_raw",), "select * from tape_raw where trade_time < 883612800000")
cte("load1_first", ("load1",), first_wins_sql("load1"))
cte("load2_first", ("tape_raw",), first_wins_sql("tape_raw"))
cte("appended", ("load1_first", "load2_first"), """
    select * from load1_first
    union all
    select * from load2_first n
    where not exists (select 1 from load1_first t where t.symbol = n.symbol and t.trade_id = n.trade_id)""")

# ----------------------------------------------------------- quality checks
STANDIN_SYMBOLS = ("CLICKUSDT", "ERRORUSDT", "PURCHASEUSDT", "SIGNUPUSDT", "VIEWUSDT")
SUITE = (
    ("stg_klines", "unique", "kline_id"), ("stg_klines", "not_null", "kline_id"),
    ("stg_klines", "not_null", "symbol"), ("stg_klines", "accepted_values", "symbol"),
    ("stg_klines", "not_null", "close_price"),
    ("stg_trades", "unique", "trade_key"), ("stg_trades", "not_null", "trade_key"),
    ("stg_trades", "not_null", "symbol"), ("stg_trades", "not_null", "price"),
    ("stg_tickers", "unique", "symbol"), ("stg_tickers", "not_null", "symbol"),
    ("price_metrics", "unique", "kline_id"), ("price_metrics", "not_null", "kline_id"),
    ("price_metrics", "not_null", "symbol"),
    ("symbol_volume", "unique", "symbol"), ("symbol_volume", "not_null", "symbol"),
    ("fct_candles", "unique", "kline_id"), ("fct_candles", "not_null", "kline_id"),
    ("fct_candles", "not_null", "symbol"), ("fct_candles", "not_null", "close_price"),
    ("fct_candles", "not_null", "trade_date"),
    ("fct_trades", "unique", "trade_key"), ("fct_trades", "not_null", "trade_key"),
    ("fct_trades", "not_null", "symbol"),
    ("dim_symbols", "unique", "symbol"), ("dim_symbols", "not_null", "symbol"),
    ("daily_summary", "not_null", "symbol"), ("daily_summary", "not_null", "trade_date"),
)


def _check_sql(model_name: str, test: str, col: str) -> str:
    head = f"select '{model_name}' as model, '{col}' as column_name, '{test}' as test"
    if test == "not_null":
        return f"{head}, cast(count_if({col} is null) as bigint) as failures from {model_name}"
    if test == "unique":
        return (f"{head}, cast(count(*) as bigint) as failures from (select {col} from {model_name} "
                f"where {col} is not null group by {col} having count(*) > 1) d")
    values = ", ".join(f"'{v}'" for v in STANDIN_SYMBOLS)
    return (f"{head}, cast(count(distinct case when {col} is not null and {col} not in ({values}) "
            f"then {col} end) as bigint) as failures from {model_name}")


def quality_sql() -> str:
    models = sorted({m for m, _, _ in SUITE})
    return statement("\nunion all\n".join(_check_sql(*t) for t in SUITE), *models)


# ------------------------------------------------------------------- panels
PANEL_SYMBOL = "CLICKUSDT"
PANELS = {
    "panel_data_freshness": (("raw_klines", "raw_trades", "raw_tickers"), """
        select 'raw_klines' as table_name, count(*) as row_count, max(extracted_at) as last_extracted_at from raw_klines
        union all
        select 'raw_trades', count(*), max(extracted_at) from raw_trades
        union all
        select 'raw_tickers', count(*), max(extracted_at) from raw_tickers"""),
    "panel_rolling_trend": (("daily_summary",),
                            "select trade_date, symbol, daily_avg_price, rolling_7d_avg_price from daily_summary"),
    "panel_volatility": (("daily_summary",), """
        select trade_date, symbol, daily_volatility_pct,
               rank() over (partition by trade_date order by daily_volatility_pct desc nulls last) = 1 as is_most_volatile
        from daily_summary"""),
    "panel_volume_by_symbol": (("symbol_volume",),
                               "select symbol, total_trades, total_volume_usdt, volume_dominance_pct, volume_rank from symbol_volume"),
    "panel_moving_averages": (("fct_candles",), f"""
        select opened_at, symbol, close_price, ma_7, ma_14, ma_30, ma_signal
        from fct_candles where symbol = '{PANEL_SYMBOL}'"""),
    "panel_price_history": (("fct_candles",), """
        select opened_at, trade_date, symbol, close_price from fct_candles
        where trade_date >= (select max(trade_date) from fct_candles) - 6
          and trade_date <= (select max(trade_date) from fct_candles)"""),
    "panel_sentiment": (("dim_symbols",),
                        "select symbol, current_price, price_change_pct, market_sentiment from dim_symbols"),
    "panel_daily_moves": (("daily_summary",), """
        select trade_date, symbol, daily_avg_price, daily_return_pct,
               rank() over (partition by trade_date order by abs(daily_return_pct) desc nulls last) = 1 as is_largest_move
        from daily_summary"""),
    "panel_volume_spikes": (("fct_candles",), """
        select opened_at, symbol, volume, avg_volume_7, volume_ratio, volume_signal
        from fct_candles where volume_signal <> 'normal_volume'"""),
    "panel_buy_sell_pressure": (("symbol_volume",), """
        select symbol, buy_trades, sell_trades, buy_pressure_pct, buy_volume_usdt, sell_volume_usdt
        from symbol_volume"""),
}


def panel_sql(name: str) -> str:
    needs, select = PANELS[name]
    return statement(select, *needs)


# ------------------------------------------------- newest N per tracked pair
TRACKED = ("CLICKUSDT", "ERRORUSDT", "PURCHASEUSDT")
_TRACKED_SQL = ", ".join(f"'{s}'" for s in TRACKED)
cte("api_snapshot_trades", ("stg_trades",), f"""
    select * exclude (rn) from (
      select *, row_number() over (partition by symbol order by traded_at desc nulls last, trade_id desc nulls last) as rn
      from stg_trades where symbol in ({_TRACKED_SQL})) x
    where rn <= 100""")
cte("api_snapshot_klines", ("stg_klines",), f"""
    select * exclude (rn) from (
      select *, row_number() over (partition by symbol order by opened_at desc nulls last) as rn
      from stg_klines where symbol in ({_TRACKED_SQL})) x
    where rn <= 100""")
