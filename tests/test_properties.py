"""Property tests on random trade tapes (ties, NULL values, duplicate keys)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlewick.operators import ingest, marts, scaled, staging
from candlewick.schemas import RAW_TRADES

T0 = dt.datetime(2024, 1, 1)

trade = st.tuples(
    st.sampled_from(["AUSDT", "BUSDT", "CUSDT"]),
    st.integers(min_value=0, max_value=40),                        # trade id (duplicates likely)
    st.one_of(st.none(), st.decimals(min_value=0, max_value=500, places=2)),
    st.decimals(min_value=0, max_value=50, places=0),
    st.integers(min_value=0, max_value=30).map(lambda s: 1_704_067_200_000 + s * 1000),  # many ties
    st.one_of(st.none(), st.booleans()),
    st.integers(min_value=0, max_value=3).map(lambda h: T0 + dt.timedelta(hours=h)),
)
tapes = st.lists(trade, min_size=1, max_size=120)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows):
    full = [(s, i, p, q, None if p is None else p * q, t, m, x) for s, i, p, q, t, m, x in rows]
    return spark.createDataFrame(full, RAW_TRADES)


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@SETTINGS
@given(rows=tapes, block=st.integers(min_value=9, max_value=25), parts=st.integers(min_value=1, max_value=6))
def test_blocked_trade_fact_equals_plain(spark, rows, block, parts):
    stg = staging.stg_trades(_df(spark, rows))
    plain = marts.fct_trades(stg, method="plain")
    assert _same(plain, scaled.fct_trades_scaled(stg, block_rows=block, partitions=parts))


@SETTINGS
@given(rows=tapes)
def test_staging_keeps_one_row_per_key(spark, rows):
    stg = staging.stg_trades(_df(spark, rows))
    keys = {(s, i) for s, i, *_ in rows}
    assert stg.count() == len(keys) == stg.select("trade_key").distinct().count()


@SETTINGS
@given(rows=tapes)
def test_first_wins_is_idempotent(spark, rows):
    batch = _df(spark, rows).withColumn("id_block", ingest.partition_value("trades"))
    keys, order = ("symbol", "trade_id"), ["extracted_at", "price"]
    once = ingest.first_wins(batch, keys, order)
    again = ingest.new_rows(batch, once, keys, order, "id_block")
    assert again.count() == 0
    assert once.count() == len({(s, i) for s, i, *_ in rows})
