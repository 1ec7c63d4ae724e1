"""Exchange payloads (JSON text) -> typed raw records.

Each input row carries one payload as received (plus the symbol for candle
and trade payloads, and the extraction stamp).  Every value is read as text
first and then cast, so nothing is lost on the way: a payload that is not the
expected JSON, a key that is missing, or a value that its column cannot hold
exactly (not a number, too many digits before or after the point) makes a bad
record.  ``on_bad="fail"`` (the default) fails the run on the first one;
``on_bad="quarantine"`` gives the good records only, and ``quarantined``
gives the others with their text and the reason.  An empty payload array and
a missing payload (a failed request) give no rows; extra candle positions
are ignored.

``pack_*`` do the inverse on raw tables (bounded groups of at most ``per``
records per payload, like the exchange's request limit); they exist to feed
the normalisers from the test tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.schemas import KLINE_POSITIONS, RAW_SCHEMAS, TICKER_FIELDS, TRADE_FIELDS
from candlewick.sources.checked import good_or_fail, known_on_bad, reasons

# Payload shapes with every value as text, and (place in the payload, raw column).
TEXT_SHAPES = {
    "klines": ("array<array<string>>", tuple((place, name) for name, place in KLINE_POSITIONS)),
    "trades": (f"array<struct<{','.join(f'{src}:string' for src, _ in TRADE_FIELDS)}>>", TRADE_FIELDS),
    "tickers": (f"struct<{','.join(f'{src}:string' for src, _ in TICKER_FIELDS)}>", TICKER_FIELDS),
}
REQUEST_LIMIT = 100  # fixed value: records per candle / trade request


def _stamp(extracted_at: Column | str | None) -> Column:
    if extracted_at is None:
        return F.localtimestamp()
    return (F.col(extracted_at) if isinstance(extracted_at, str) else extracted_at).cast("timestamp_ntz")


def _records(payloads: DataFrame, dataset: str, payload: str, symbol: str, extracted_at) -> DataFrame:
    """One row per record: the raw columns, ``_reason`` (null: good), ``_payload``
    and ``_record`` (its values as JSON); a payload that cannot be read is one
    row without values."""
    shape, fields = TEXT_SHAPES[dataset]
    text = F.col(payload)
    one = F.from_json(text, shape)
    read = payloads.where(text.isNotNull()).select(
        F.lit(None).cast("string").alias("_symbol") if dataset == "tickers" else F.col(symbol).alias("_symbol"),
        _stamp(extracted_at).alias("extracted_at"),
        text.alias("_payload"),
        F.when(F.try_parse_json(text).isNotNull(), F.array(one) if dataset == "tickers" else one).alias("_all"),
    )
    rows = read.where(F.col("_all").isNull() | (F.size("_all") > 0)).select(
        "*", F.col("_all").isNull().alias("_broken"), F.explode_outer("_all").alias("_r")
    )
    value = {
        name: F.get("_r", F.lit(src)) if dataset == "klines" else F.col(f"_r.{src}") for src, name in fields
    }
    if "symbol" not in value:
        value["symbol"] = F.col("_symbol")
    schema = RAW_SCHEMAS[dataset]
    reason = F.coalesce(F.when(F.col("_broken"), "payload: not the expected JSON"), *reasons(value, dataset))
    typed = [
        (value[f.name].try_cast(f.dataType) if f.name in value else F.col(f.name)).alias(f.name) for f in schema.fields
    ]
    return rows.select(
        *typed, reason.alias("_reason"), "_payload", F.to_json(F.struct(F.col("_r").alias("r"))).alias("_record")
    )


def normalize(payloads: DataFrame, dataset: str, payload: str = "payload", symbol: str = "symbol",
              extracted_at: Column | str | None = "extracted_at", on_bad: str = "fail") -> DataFrame:
    """Typed raw records of ``dataset`` (``klines``, ``trades`` or ``tickers``)."""
    rows = _records(payloads, dataset, payload, symbol, extracted_at)
    good = F.col("_reason").isNull() if known_on_bad(on_bad) == "quarantine" else good_or_fail("_reason", "_record", "_payload")
    return rows.where(good).select(*RAW_SCHEMAS[dataset].names)


def quarantined(payloads: DataFrame, dataset: str, payload: str = "payload", symbol: str = "symbol",
                extracted_at: Column | str | None = "extracted_at") -> DataFrame:
    """The records that ``normalize`` does not give: symbol, extracted_at, reason,
    record (its values as JSON) and the payload's text."""
    rows = _records(payloads, dataset, payload, symbol, extracted_at).where(F.col("_reason").isNotNull())
    return rows.select(
        "symbol", "extracted_at", F.col("_reason").alias("reason"), F.col("_record").alias("record"),
        F.col("_payload").alias("payload"),
    )


def normalize_klines(payloads: DataFrame, **options) -> DataFrame:
    return normalize(payloads, "klines", **options)


def normalize_trades(payloads: DataFrame, **options) -> DataFrame:
    return normalize(payloads, "trades", **options)


def normalize_tickers(payloads: DataFrame, **options) -> DataFrame:
    """One ticker object per payload; the symbol comes from the payload."""
    return normalize(payloads, "tickers", **options)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def pack_kline_payloads(raw_klines: DataFrame, per: int = REQUEST_LIMIT,
                        interval_ms: int = 3_600_000) -> DataFrame:
    """Raw candles -> one positional-array payload per symbol and span of
    ``per`` candles (extraction stamp: the newest in the span)."""
    arr = F.array(*[_text(name) for name, _ in KLINE_POSITIONS])
    return (
        raw_klines.withColumn("_span", F.floor(F.col("open_time") / F.lit(per * interval_ms)))
        .groupBy("symbol", "_span")
        .agg(
            F.array_sort(F.collect_list(F.struct(F.col("open_time").alias("k"), arr.alias("v")))).alias("_c"),
            F.max("extracted_at").alias("extracted_at"),
        )
        .select("symbol", F.to_json(F.transform("_c", lambda x: x["v"])).alias("payload"), "extracted_at")
    )


def pack_trade_payloads(raw_trades: DataFrame, per: int = REQUEST_LIMIT) -> DataFrame:
    """Raw trades -> one object-array payload per symbol and block of ``per``
    consecutive trade ids."""
    obj = F.struct(
        F.col("trade_id").alias("id"),
        _text("price").alias("price"),
        _text("quantity").alias("qty"),
        _text("quote_qty").alias("quoteQty"),
        F.col("trade_time").alias("time"),
        F.col("is_buyer_maker").alias("isBuyerMaker"),
    )
    return (
        raw_trades.withColumn("_blk", F.floor(F.col("trade_id") / F.lit(per)))
        .groupBy("symbol", "_blk")
        .agg(
            F.array_sort(F.collect_list(F.struct(F.col("trade_id").alias("k"), obj.alias("v")))).alias("_t"),
            F.max("extracted_at").alias("extracted_at"),
        )
        .select("symbol", F.to_json(F.transform("_t", lambda x: x["v"])).alias("payload"), "extracted_at")
    )


def pack_ticker_payloads(raw_tickers: DataFrame) -> DataFrame:
    """Raw tickers -> one camelCase object payload per snapshot."""
    fields = []
    for src, dst in TICKER_FIELDS:
        c = F.col(dst)
        if dst not in ("symbol", "open_time", "close_time", "count"):
            c = c.cast("string")
        fields.append(c.alias(src))
    return raw_tickers.select(F.to_json(F.struct(*fields)).alias("payload"), "extracted_at")
