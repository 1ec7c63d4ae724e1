"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
model or operator.  Every query reads the driver's tables (through the
stand-in mappings) and runs over them whole."""

from __future__ import annotations


from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import bars, ingest, marts, metrics, panels, partials, quality, scaled, staging
from candlewick.plans import incremental, materialize
from candlewick.plans.models import DEFAULT_AS_OF, standin_models, standin_raw, tape_trades
from candlewick.schemas import RAW_KEYS, RAW_TRADES
from candlewick.session import scratch_path
from candlewick.sources import landing, payloads
from candlewick.streaming.bars import stream_tickers

Query = Callable[[SparkSession, str], DataFrame]

# fixed values: the five stand-in symbols (events.event_type + quote asset)
STANDIN_SYMBOLS = ("CLICKUSDT", "ERRORUSDT", "PURCHASEUSDT", "SIGNUPUSDT", "VIEWUSDT")
PANEL_SYMBOL = "CLICKUSDT"  # symbol shown on the moving-average panel
TRACKED = ("CLICKUSDT", "ERRORUSDT", "PURCHASEUSDT")  # pairs an extract run asks for
REQUEST_LIMIT = 100  # fixed value: newest records per symbol and request
# Second load of the tape re-sends everything; the first one held the trades
# that happened before this instant (UTC).
FIRST_LOAD_BEFORE_MS = 883_612_800_000


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(standin_models(spark, sf_dir), name)

    run.__name__ = name
    return run


def _candles_1h(spark, sf_dir):
    return standin_raw(spark, sf_dir).klines


def _tickers_24h(spark, sf_dir):
    return standin_raw(spark, sf_dir).tickers


def _tickers_sliding(spark, sf_dir):
    """The 24 hours up to each full hour, per symbol."""
    return bars.with_prev_close(stream_tickers(standin_raw(spark, sf_dir).trades))


def _dedupe_latest(spark, sf_dir):
    return staging.stg_trades(tape_trades(spark, sf_dir))


def _fct_trades_tape(spark, sf_dir):
    """The tape's trade fact (blocked windows of the default size)."""
    return marts.fct_trades(staging.stg_trades(tape_trades(spark, sf_dir)))


def _fct_trades_tape_scaled(spark, sf_dir):
    return scaled.fct_trades_scaled(staging.stg_trades(tape_trades(spark, sf_dir)), block_rows=10_000)


def _fct_trades_scaled(spark, sf_dir):
    return scaled.fct_trades_scaled(standin_models(spark, sf_dir).stg_trades, block_rows=1_000)


def _price_metrics_scaled(spark, sf_dir):
    return scaled.price_metrics_scaled(standin_models(spark, sf_dir).stg_klines, block_rows=200)


def _symbol_volume_all(spark, sf_dir):
    m = standin_models(spark, sf_dir)
    return metrics.symbol_volume(m.stg_trades, m.stg_tickers, all_snapshots=True)


def _normalize_klines(spark, sf_dir):
    return payloads.normalize_klines(payloads.pack_kline_payloads(standin_raw(spark, sf_dir).klines))


def _normalize_trades(spark, sf_dir):
    return payloads.normalize_trades(payloads.pack_trade_payloads(standin_raw(spark, sf_dir).trades))


def _normalize_tickers(spark, sf_dir):
    return payloads.normalize_tickers(payloads.pack_ticker_payloads(standin_raw(spark, sf_dir).tickers))


def _api_trades(spark, sf_dir):
    """What one extract run returns for the tracked pairs: the newest 100
    trades of each, out of the whole trade history."""
    stg = staging.restrict_symbols(standin_models(spark, sf_dir).stg_trades, TRACKED)
    return staging.newest_per_symbol(stg, REQUEST_LIMIT, "traded_at", tiebreak="trade_id")


def _api_klines(spark, sf_dir):
    stg = staging.restrict_symbols(standin_models(spark, sf_dir).stg_klines, TRACKED)
    return staging.newest_per_symbol(stg, REQUEST_LIMIT, "opened_at")


REFRESH_SINCE_MS = 1_705_708_800_000
REFRESH_SINCE = "2024-01-20 00:00:00"  # first day an incremental refresh rewrites


def _fct_candles_incremental(spark, sf_dir):
    """Candle-fact rows an incremental refresh from REFRESH_SINCE writes:
    computed from those days plus 29 earlier candles per symbol."""
    return incremental.candles_since(standin_models(spark, sf_dir).stg_klines, REFRESH_SINCE)


def _daily_summary_incremental(spark, sf_dir):
    """Daily rows from REFRESH_SINCE on, with the trend windows fed by the
    newest earlier days of the existing daily table."""
    m = standin_models(spark, sf_dir)
    return incremental.daily_since(m.fct_candles, marts.daily_summary(m.fct_candles, sort=False), REFRESH_SINCE)


def _refreshed(spark, sf_dir, dataset: str) -> dict[str, DataFrame]:
    """Written candle or trade tables after a build on the records before REFRESH_SINCE, an append of
    all records and a refresh from that day on."""
    raw = getattr(standin_raw(spark, sf_dir), dataset)
    time = "trade_time" if dataset == "trades" else "open_time"
    root, out = scratch_path(spark, "raw"), scratch_path(spark, "built")
    ingest.append_idempotent(spark, raw.where(F.col(time) < REFRESH_SINCE_MS), root, dataset)
    first = ingest.read_raw_table(spark, root, dataset)
    if dataset == "trades":
        paths, run = materialize.build_trades(spark, first, out), incremental.refresh_trades
    else:
        paths, run = materialize.build_candles(spark, first, out), incremental.refresh
    ingest.append_idempotent(spark, raw, root, dataset)
    run(spark, root, paths, REFRESH_SINCE)
    return {t: spark.read.parquet(path) for t, path in paths.items()}


def _fct_trades_incremental(spark, sf_dir):
    done = _refreshed(spark, sf_dir, "trades")
    return done["fct_trades"].select(*marts.FCT_TRADE_COLUMNS)


def _symbol_volume_incremental(spark, sf_dir):
    done = _refreshed(spark, sf_dir, "trades")
    summary = partials.merged_trade_summary(done["trade_partials"])
    return metrics.volume_of_summary(summary, standin_models(spark, sf_dir).stg_tickers)


def _dim_symbols_incremental(spark, sf_dir):
    done = _refreshed(spark, sf_dir, "klines")
    stats = partials.merged_candle_stats(done["candle_partials"])
    return marts.dim_of_stats(standin_models(spark, sf_dir).stg_tickers, stats, as_of=DEFAULT_AS_OF)


def _candle_grain_incremental(spark, sf_dir):
    done = _refreshed(spark, sf_dir, "klines")
    return done["daily_summary_candle_grain"].select(*marts.DAILY_COLUMNS)


TAPE_ORDER = ("extracted_at", "price", "quantity", "quote_qty", "trade_time", "is_buyer_maker")


def _idempotent_append(spark, sf_dir):
    """Table state after two loads of the tape: first the trades before
    1998, then the whole tape again (first write wins throughout)."""
    keys = RAW_KEYS["trades"]
    part = ingest.PARTITION_COLUMN["trades"]
    tape = tape_trades(spark, sf_dir).withColumn(part, ingest.partition_value("trades"))
    first = ingest.first_wins(tape.where(F.col("trade_time") < FIRST_LOAD_BEFORE_MS), keys, TAPE_ORDER)
    second = ingest.new_rows(tape, first, keys, TAPE_ORDER, partition_col=part)
    return first.unionByName(second).select(*RAW_TRADES.names)


def _append(dataset: str, batches, order=None) -> Query:
    """State of the raw table after loads of growing batches: the first part, then
    everything again (first write wins throughout)."""

    def run(spark, sf_dir):
        root = scratch_path(spark, "appended")
        for batch in batches(spark, sf_dir):
            ingest.append_idempotent(spark, batch, root, dataset, order)
        return ingest.read_raw_table(spark, root, dataset)

    return run


def _tape_batches(spark, sf_dir):
    tape = tape_trades(spark, sf_dir)
    return tape.where(F.col("trade_time") < FIRST_LOAD_BEFORE_MS), tape


def _bar_batches(dataset: str):
    def run(spark, sf_dir):
        rows = getattr(standin_raw(spark, sf_dir), dataset)
        return rows.where(F.col("open_time") < REFRESH_SINCE_MS), rows

    return run


def _landing_round_trip(spark, sf_dir):
    """Raw trades written to a landing folder and read back."""
    path = scratch_path(spark, "landing")
    landing.write_landing(standin_raw(spark, sf_dir).trades, path)
    return landing.read_landing(spark, path, "trades").select(*RAW_TRADES.names)


def _landing_arrays(spark, sf_dir):
    """Raw trades landed as files of one JSON array of 1000 ids each, and read back."""
    trades = standin_raw(spark, sf_dir).trades
    texts = [F.col(c).cast("string").alias(c) if c in ("price", "quantity", "quote_qty", "extracted_at") else F.col(c) for c in RAW_TRADES.names]
    arrays = trades.groupBy(F.floor(F.col("trade_id") / 1000)).agg(F.to_json(F.collect_list(F.struct(*texts))).alias("value"))
    path = scratch_path(spark, "landing")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return landing.read_landing(spark, path, "trades", multiline=True).select(*RAW_TRADES.names)


def _landing_quarantine(spark, sf_dir):
    """Records by reason (good ones: none) of landed trades with planted faults: ids left
    out, prices of too many digits, times that are no number, lines cut short."""
    trades = standin_raw(spark, sf_dir).trades
    texts = [F.col(c).cast("string").alias(c) if c in ("price", "quantity", "quote_qty", "extracted_at") else F.col(c) for c in RAW_TRADES.names]
    text, last = F.to_json(F.struct(*texts)), F.col("trade_id") % 50
    faulty = (
        F.when(last == 7, F.regexp_replace(text, r'"trade_id":\d+,', ""))
        .when(last == 9, F.regexp_replace(text, r'"price":"[^"]*"', '"price":"0.0000012345"'))
        .when(last == 11, F.regexp_replace(text, r'"trade_time":(\d+)', '"trade_time":"$1?"'))
        .when(last == 13, F.expr("left(to_json(struct(*)), 20)"))
        .otherwise(text)
    )
    path = scratch_path(spark, "landing")
    trades.select(faulty.alias("value")).write.text(path)
    bad = landing.quarantined_landing(spark, path, "trades").select("reason")
    good = landing.read_landing(spark, path, "trades", on_bad="quarantine").select(F.lit("none").alias("reason"))
    return bad.unionByName(good).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def _normalize_quarantine(spark, sf_dir):
    """Bad records by symbol and reason, of trade payloads with planted faults: ids
    that are no number, prices of too many digits, payloads cut short."""
    trades = standin_raw(spark, sf_dir).trades
    packed = payloads.pack_trade_payloads(trades).withColumn("first", F.get_json_object("payload", "$[0].id").cast("long"))
    cut = F.floor(F.col("first") / payloads.REQUEST_LIMIT) % 7 == 3
    text = F.col("payload")
    text = F.regexp_replace(text, r'"id":(\d*[05]7),', r'"id":"x$1",')
    text = F.regexp_replace(text, r'"id":(\d*[05]9),"price":"[^"]*"', r'"id":$1,"price":"0.0000012345"')
    faulty = packed.withColumn("payload", F.when(cut, F.expr("left(payload, length(payload) - 5)")).otherwise(text))
    bad = payloads.quarantined(faulty, "trades")
    return bad.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("records"))


def _dim_symbols_all_snapshots(spark, sf_dir):
    m = standin_models(spark, sf_dir)
    return marts.dim_symbols(m.stg_tickers, m.stg_klines, as_of=DEFAULT_AS_OF, all_snapshots=True)


def _quality_checks(spark, sf_dir):
    """The suite over written tables, as the models are tested in operation."""
    root = scratch_path(spark, "built")
    paths = materialize.build(spark, standin_raw(spark, sf_dir), root, DEFAULT_AS_OF, skip=("daily_summary_candle_grain",))
    return quality.declared_suite({name: spark.read.parquet(path) for name, path in paths.items()}, STANDIN_SYMBOLS)


def _panel(fn) -> Query:
    def run(spark, sf_dir):
        return fn(standin_models(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "panel")
    return run


def _daily(m):
    return marts.daily_summary(m.fct_candles, sort=False)


QUERIES: dict[str, Query] = {
    "candles_1h": _candles_1h,
    "tickers_24h": _tickers_24h,
    "tickers_sliding": _tickers_sliding,
    "normalize_klines": _normalize_klines,
    "normalize_trades": _normalize_trades,
    "normalize_tickers": _normalize_tickers,
    "normalize_quarantine": _normalize_quarantine,
    "payload_klines": lambda spark, sf_dir: payloads.pack_kline_payloads(standin_raw(spark, sf_dir).klines),
    "payload_trades": lambda spark, sf_dir: payloads.pack_trade_payloads(standin_raw(spark, sf_dir).trades),
    "payload_tickers": lambda spark, sf_dir: payloads.pack_ticker_payloads(standin_raw(spark, sf_dir).tickers),
    "landing_round_trip": _landing_round_trip,
    "landing_arrays": _landing_arrays,
    "landing_quarantine": _landing_quarantine,
    "append_klines": _append("klines", _bar_batches("klines")),
    "append_trades": _append("trades", _tape_batches, TAPE_ORDER),
    "append_tickers": _append("tickers", _bar_batches("tickers")),
    "idempotent_append": _idempotent_append,
    "api_snapshot_trades": _api_trades,
    "api_snapshot_klines": _api_klines,
    "stg_klines": _model("stg_klines"),
    "stg_trades": _model("stg_trades"),
    "stg_tickers": _model("stg_tickers"),
    "latest_ticker": _model("latest_ticker"),
    "dedupe_latest": _dedupe_latest,
    "price_metrics": _model("price_metrics"),
    "price_metrics_scaled": _price_metrics_scaled,
    "symbol_volume": _model("symbol_volume"),
    "symbol_volume_all_snapshots": _symbol_volume_all,
    "fct_candles": _model("fct_candles"),
    "fct_trades": _model("fct_trades"),
    "fct_trades_scaled": _fct_trades_scaled,
    "fct_trades_tape": _fct_trades_tape,
    "fct_trades_tape_scaled": _fct_trades_tape_scaled,
    "dim_symbols": _model("dim_symbols"),
    "dim_symbols_all_snapshots": _dim_symbols_all_snapshots,
    "daily_summary": _model("daily_summary"),
    "daily_summary_candle_grain": _model("daily_summary_candle_grain"),
    "fct_candles_incremental": _fct_candles_incremental,
    "daily_summary_incremental": _daily_summary_incremental,
    "fct_trades_incremental": _fct_trades_incremental,
    "symbol_volume_incremental": _symbol_volume_incremental,
    "dim_symbols_incremental": _dim_symbols_incremental,
    "daily_summary_candle_grain_incremental": _candle_grain_incremental,
    "quality_checks": _quality_checks,
    "panel_data_freshness": _panel(lambda m: panels.data_freshness(m.raw.klines, m.raw.trades, m.raw.tickers)),
    "panel_rolling_trend": _panel(lambda m: panels.rolling_trend(_daily(m))),
    "panel_volatility": _panel(lambda m: panels.daily_volatility(_daily(m))),
    "panel_volume_by_symbol": _panel(lambda m: panels.volume_by_symbol(m.symbol_volume)),
    "panel_moving_averages": _panel(lambda m: panels.moving_averages(m.fct_candles, PANEL_SYMBOL)),
    "panel_price_history": _panel(lambda m: panels.price_history(m.fct_candles, days=7)),
    "panel_sentiment": _panel(lambda m: panels.sentiment(m.dim_symbols)),
    "panel_daily_moves": _panel(lambda m: panels.daily_moves(_daily(m))),
    "panel_volume_spikes": _panel(lambda m: panels.volume_spikes(m.fct_candles)),
    "panel_buy_sell_pressure": _panel(lambda m: panels.buy_sell_pressure(m.symbol_volume)),
}
