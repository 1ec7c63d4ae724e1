"""Raw market tables derived from the driver's generic tables.

No market data ships with the test tables, so two trade tapes are derived:

* ``trades_from_events``: ``events`` -> five symbols, unique trade ids,
  microsecond-distinct times.  Candles and tickers are then built from it
  (``operators.bars``).
* ``trades_from_lineitem``: ``lineitem`` -> six symbols, a ten times larger
  tape with whole-day times (heavy ties), whale-sized values and duplicate
  trade keys, for de-duplication and idempotent appends.

Both are narrow projections, so the parquet scan reads only the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.temporal import ts_to_ms
from candlewick.schemas import PRICE, RAW_TRADES


def _typed(cols: dict, schema) -> list:
    """Expressions of ``cols`` cast to the schema's types, in schema order."""
    return [cols[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]


def trades_from_events(events: DataFrame) -> DataFrame:
    price = F.col("value").cast(PRICE)
    qty = F.get_json_object("props", "$.k").cast(PRICE)
    return events.select(
        _typed(
            {
                "symbol": F.concat(F.upper("event_type"), F.lit("USDT")),
                "trade_id": F.col("event_id"),
                "price": price,
                "quantity": qty,
                "quote_qty": price * qty,
                "trade_time": ts_to_ms("ts"),
                "is_buyer_maker": (F.col("user_id") % 2) == 0,
                "extracted_at": F.col("ts"),
            },
            RAW_TRADES,
        )
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast(PRICE)
    qty = F.col("l_quantity").cast(PRICE)
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    return lineitem.select(
        _typed(
            {
                "symbol": F.concat("l_returnflag", "l_linestatus", F.lit("USDT")),
                "trade_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
                "price": price,
                "quantity": qty,
                "quote_qty": price * qty,
                "trade_time": ts_to_ms(shipped),
                "is_buyer_maker": (F.col("l_partkey") % 2) == 0,
                "extracted_at": F.timestamp_add("SECOND", F.col("l_partkey") % 86400, shipped),
            },
            RAW_TRADES,
        )
    )
