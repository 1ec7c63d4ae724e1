"""Time, key and symbol helpers (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTE_SUFFIX_LEN = 4  # fixed value: quote assets are the last four characters


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_ts(ms: Column | str) -> Column:
    """Unix milliseconds to a timestamp, exactly (no float step)."""
    return F.timestamp_millis(_col(ms))


def ms_to_ts_ntz(ms: Column | str) -> Column:
    """Unix milliseconds to a zone-less (UTC wall clock) timestamp."""
    return F.timestamp_millis(_col(ms)).cast("timestamp_ntz")


def ts_to_ms(ts: Column | str) -> Column:
    """Timestamp (with or without zone, read as UTC) to Unix milliseconds."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def trade_date(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def trade_hour(ts: Column | str) -> Column:
    return F.hour(_col(ts)).cast("int")


def day_name(ts: Column | str) -> Column:
    """English day name blank-padded to nine characters ('Monday   ')."""
    return F.rpad(F.date_format(_col(ts), "EEEE"), 9, " ")


def surrogate_key(symbol: Column | str, ident: Column | str) -> Column:
    """``symbol || '_' || id``: NULL when either part is NULL."""
    return F.concat(_col(symbol), F.lit("_"), _col(ident).cast("string"))


def base_asset(symbol: Column | str) -> Column:
    """``left(symbol, length(symbol) - 4)`` with negative-length semantics.

    A negative length keeps all but the last ``|n|`` characters, so a symbol
    shorter than four characters keeps ``2*len - 4`` characters (or none).
    """
    s = _col(symbol)
    n = F.length(s)
    keep = F.when(n >= QUOTE_SUFFIX_LEN, n - QUOTE_SUFFIX_LEN).otherwise(
        F.greatest(n * 2 - QUOTE_SUFFIX_LEN, F.lit(0))
    )
    return F.substring(s, F.lit(1), keep)


def quote_asset(symbol: Column | str) -> Column:
    """``right(symbol, 4)``: the whole symbol when it is shorter."""
    s = _col(symbol)
    n = F.length(s)
    return F.substring(s, F.greatest(n - (QUOTE_SUFFIX_LEN - 1), F.lit(1)), QUOTE_SUFFIX_LEN)
