"""Per-symbol row windows that do not put a whole symbol into one task.

The metric windows are partitioned by symbol.  A plain ``Window`` sends all
rows of a symbol to one task; with a handful of symbols over a long history
that caps parallelism at the number of symbols, and a symbol holding a third
of the data becomes a third of the job in a single task.  Adaptive execution
does not split a window partition.

Here each series is cut into blocks of a fixed number of rows instead:

1. **Position.**  The rows are range-partitioned and sorted on
   ``(series, order)``.  Range boundaries come from a sample of the keys, and
   the key is unique, so even a single hot series (or a single hot hour of
   it) is spread evenly over tasks.  Within a partition the rows of a series
   are contiguous; ``monotonically_increasing_id`` numbers them in order.
   The tagged rows are written once to the shared checkpoint folder; a
   small table (one row per partition and series) with a running count per
   series then turns the tags into the row's exact 0-based position.
2. **Blocks with a halo.**  ``block = position div block_rows``.  A row whose
   position is among the last ``halo`` of its block is also copied into the
   next block, flagged.  A trailing frame of up to ``halo`` preceding rows
   then finds all its rows inside (series, block); flagged copies are
   dropped after the window.  Results are exact for row frames.
3. **Running totals** (``cumulative_volume_usdt``) are the sum of all
   earlier blocks (a running total over per-block sums, one row per block)
   plus the running sum inside the block, in exact decimal.

Two full shuffles (the range sort and the block window) and one write of
the tagged rows, each with tasks of bounded size; the helper tables have one
row per partition or per block.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.numeric import pct, ratio, rounded
from candlewick.functions.temporal import surrogate_key
from candlewick.operators.marts import FCT_TRADE_COLUMNS, RELATIVE_SIZE_ROWS, trade_fact_columns
from candlewick.operators.metrics import MA_SLOW, price_metric_columns, with_price_rank
from candlewick.session import scratch_path

DEFAULT_BLOCK_ROWS = 50_000


def written_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The partition ordinals above are only meaningful for one computation of
    the range shuffle (its boundaries come from a sample of rows whose
    arrival order is not fixed), so both consumers of the tagged rows (the
    per-partition counts and the rows themselves) must read the same
    written copy.  Writing it also cuts the lineage: a lost executor
    re-reads the table instead of recomputing the upstream stages.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)  # deleted by session.release_scratch
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


_ID_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def range_tagged(df: DataFrame, keys: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """The rows range-partitioned and sorted by ``keys``, written once, each with its
    partition (``_pid``) and its place there (``_local``, from 0)."""
    # Without an explicit count AQE may merge adjacent ranges (small inputs
    # then write few files); merged ranges stay contiguous, so places hold.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    pid = F.spark_partition_id().cast("long")
    return written_table(
        ranged.sortWithinPartitions(*keys)
        .select(
            "*",
            pid.alias("_pid"),
            (F.monotonically_increasing_id() - F.shiftleft(pid, _ID_BITS)).alias("_local"),
        ),
        "positions",
    )


def positioned(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Add ``_pos``: the 0-based position of each row within its ``series``
    in ``order`` (ascending, NULLs last), without a per-series task.

    The counts (a row per partition and series) are written, so that their size is
    known when the join is planned: while they are small they are broadcast, and the
    tagged rows are not shuffled for it.
    """
    series = list(series)
    tagged = range_tagged(df, [F.col(c).asc_nulls_last() for c in [*series, *order]], partitions)
    stats = written_table(
        tagged.groupBy("_pid", *series).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first")), "counts"
    )
    before = Window.partitionBy(*series).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stats.select(
        F.col("_pid").alias("_spid"),
        *[F.col(c).alias(f"_s_{c}") for c in series],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    cond = (tagged["_pid"] == shifts["_spid"]) & functools.reduce(
        lambda a, b: a & b, [tagged[c].eqNullSafe(shifts[f"_s_{c}"]) for c in series]
    )
    joined = tagged.join(shifts, cond, "inner")
    return joined.select(
        *[c for c in df.columns],
        (F.col("_local") + F.col("_shift")).alias("_pos"),
    )


def with_rank(df: DataFrame, value: str, ties: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """Add ``name``: ``rank() over (order by value desc nulls first)`` over all rows,
    without putting them, or the rows of one value, into one task.

    The ranges come from the data.  ``ties`` tell equal values apart, so a value that
    many rows share is cut over several ranges.  A value's rank is one more than the
    place of its first row: the rows of earlier ranges plus its first place in its own;
    where a range begins with the value that ended the one before, the earlier place
    holds.  The helper table has one row per range and value and is joined by both, so
    no join key has more rows than a range.  NULL is a value; no rows give no rows.
    """
    keys = [F.col(value).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in ties]]
    tagged = range_tagged(df, keys, partitions)
    runs = tagged.groupBy("_pid", value).agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = runs.groupBy("_pid").agg(F.sum("_n").alias("_rows")).select(
        "_pid", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.min(F.col("_before") + F.col("_first")).over(Window.partitionBy(value))  # at most a row per range each
    ranks = runs.join(sizes, "_pid").select(
        F.col("_pid").alias("_of_pid"), F.col(value).alias("_of_value"), (place + 1).cast("int").alias(name))
    cond = (tagged["_pid"] == ranks["_of_pid"]) & tagged[value].eqNullSafe(ranks["_of_value"])
    return tagged.join(ranks, cond, "inner").select(*df.columns, name)


def with_halo(df: DataFrame, block_rows: int, halo: int) -> DataFrame:
    """Assign ``_blk`` from ``_pos`` and copy the last ``halo`` rows of each
    block into the next one (``_halo`` = true on the copies)."""
    if block_rows < halo:
        raise ValueError("block_rows must be at least the frame length")
    blk = F.floor(F.col("_pos") / F.lit(block_rows)).cast("long")
    in_tail = (F.col("_pos") % F.lit(block_rows)) >= F.lit(block_rows - halo)
    shifts = F.when(in_tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    exploded = df.select("*", F.explode(shifts).alias("_shift"))
    return exploded.select(
        *df.columns, (blk + F.col("_shift")).alias("_blk"), (F.col("_shift") == 1).alias("_halo")
    )


def _exact_add(before: Column, within: Column, dtype: T.DataType) -> Column:
    """``before + within`` for running sums, NULL only when both are NULL.

    ``sum(decimal(p,s))`` is ``decimal(p+10,s)``; adding two of those would
    widen past 38 digits and drop a digit of scale, so both sides are
    narrowed by one integer digit first (ANSI raises on overflow).
    """
    if isinstance(dtype, T.DecimalType):
        total = T.DecimalType(min(dtype.precision + 10, 38), dtype.scale)
        operand = T.DecimalType(total.precision - 1, dtype.scale)
        before, within = before.cast(operand), within.cast(operand)
    else:
        total = None
    zero = F.lit(0)
    out = F.when(before.isNull() & within.isNull(), F.lit(None)).otherwise(
        F.coalesce(before, zero) + F.coalesce(within, zero)
    )
    return out.cast(total) if total is not None else out


NULL_SERIES = "\u0000"  # series key of rows without a symbol (no real symbol holds NUL)


def fct_trades_scaled(
    stg_trades: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS, partitions: int | None = None
) -> DataFrame:
    """``marts.fct_trades`` computed in balanced blocks (same rows, same values).

    The series key is ``coalesce(symbol, NUL)``, never NULL, so every join
    is a plain equi-join; the offsets join is on ``(series, block)``, the
    block window's own partitioning, so the windowed rows are not shuffled
    again.  The rows are shuffled without the columns that follow from others;
    a ``trade_key`` is carried where it is not the one of symbol and id.
    """
    keyed = F.col("trade_key").eqNullSafe(surrogate_key("symbol", "trade_id"))
    base = stg_trades.select(
        "trade_id", "traded_at", "quantity", "quote_qty", "trade_value_usdt", "trade_direction",
        keyed.alias("_keyed"),
        F.when(~keyed, F.col("trade_key")).alias("_key"),
        F.coalesce("symbol", F.lit(NULL_SERIES)).alias("_series"),
    )
    pos = positioned(base, ["_series"], ["traded_at", "trade_id"], partitions)
    halo = RELATIVE_SIZE_ROWS - 1
    blocked = with_halo(pos, block_rows, halo)

    w = Window.partitionBy("_series", "_blk").orderBy("_pos")
    recent = F.avg(F.col("trade_value_usdt").cast("double")).over(w.rowsBetween(-halo, Window.currentRow))
    own = F.when(~F.col("_halo"), F.col("trade_value_usdt"))
    in_block = F.sum(own).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    windowed = blocked.select(
        "*",
        rounded(ratio("trade_value_usdt", recent), 4).alias("relative_size"),
        in_block.alias("_inrun"),
    ).where(~F.col("_halo"))

    totals = pos.groupBy("_series", F.floor(F.col("_pos") / F.lit(block_rows)).cast("long").alias("_blk")).agg(
        F.sum("trade_value_usdt").alias("_btot")
    )
    earlier = Window.partitionBy("_series").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_series", "_blk", F.sum("_btot").over(earlier).alias("_boff"))
    dtype = base.schema["trade_value_usdt"].dataType
    found = windowed.join(offsets, ["_series", "_blk"], "inner").withColumn("symbol", F.nullif("_series", F.lit(NULL_SERIES)))
    found = found.withColumn("trade_key", F.when(F.col("_keyed"), surrogate_key("symbol", "trade_id")).otherwise(F.col("_key")))
    return found.select(
        *trade_fact_columns(),
        "relative_size",
        _exact_add(F.col("_boff"), F.col("_inrun"), dtype).alias("cumulative_volume_usdt"),
    )


TAIL_ROWS = RELATIVE_SIZE_ROWS - 1


def _newest(df: DataFrame, *by: str) -> DataFrame:
    """The last ``TAIL_ROWS`` trades per ``by`` in the fact's order, numbered from the
    newest (``_rn``); cut inside the map tasks first, so no group is hot."""
    last = [F.col(c).desc_nulls_first() for c in ("traded_at", "trade_id")]
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*last)))
    return numbered.where(F.col("_rn") <= TAIL_ROWS)


def trade_tails(fct_trades: DataFrame) -> DataFrame:
    """State of the trade fact: the last trades of each symbol and day, with their
    running totals.  From it a refresh starts at any day without the trades before."""
    dated = fct_trades.where(F.col("trade_date").isNotNull())
    return _newest(dated, "symbol", "trade_date").select(
        "symbol", "traded_at", "trade_id", "trade_value_usdt", "cumulative_volume_usdt", "trade_date")


def fct_trades_from(
    stg_trades: DataFrame, tails: DataFrame, start_day: str, block_rows: int = DEFAULT_BLOCK_ROWS, partitions: int | None = None
) -> DataFrame:
    """Trade fact of the days from ``start_day`` on (and of trades without a time, which
    come last), from the staged trades of these days and the ``trade_tails`` before.

    The tail rows fill the frames of a symbol's first trades; what they do not show
    of the running total is one opening value per symbol.
    """
    day = F.lit(start_day).cast("date")
    before = _newest(tails.where(F.col("trade_date") < day), "symbol")
    dtype = stg_trades.schema["trade_value_usdt"].dataType
    opening = before.groupBy(F.coalesce("symbol", F.lit(NULL_SERIES)).alias("_of")).agg(
        _exact_add(F.max(F.when(F.col("_rn") == 1, F.col("cumulative_volume_usdt"))), -F.sum("trade_value_usdt"), dtype).alias("_open")
    )
    shown = before.select("symbol", "traded_at", "trade_id", "trade_value_usdt")
    facts = fct_trades_scaled(stg_trades.unionByName(shown, allowMissingColumns=True), block_rows, partitions)
    facts = facts.where(F.col("trade_date").isNull() | (F.col("trade_date") >= day))
    total = _exact_add(F.col("_open"), F.col("cumulative_volume_usdt"), dtype)
    return facts.join(opening, F.coalesce("symbol", F.lit(NULL_SERIES)) == F.col("_of"), "left").select(
        *[total.alias(c) if c == "cumulative_volume_usdt" else F.col(c) for c in FCT_TRADE_COLUMNS]
    )


def price_metrics_scaled(
    stg_klines: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS, partitions: int | None = None
) -> DataFrame:
    """``metrics.price_metrics`` computed in balanced blocks per symbol."""
    base = stg_klines.select(
        "kline_id", "symbol", "opened_at", "closed_at", "open_price", "high_price",
        "low_price", "close_price", "volume", "number_of_trades", "candle_direction",
        "price_range",
    )
    pos = positioned(base, ["symbol"], ["opened_at"], partitions)
    halo = MA_SLOW - 1
    blocked = with_halo(pos, block_rows, halo)
    w = Window.partitionBy("symbol", "_blk").orderBy("_pos")
    out = blocked.select(
        "*",
        *price_metric_columns(w),
        rounded(pct(F.abs(F.col("close_price") - F.col("open_price")), "price_range"), 4).alias("body_pct_of_range"),
    ).where(~F.col("_halo"))
    return with_price_rank(out)
