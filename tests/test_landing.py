"""Landed records: nothing is rounded or lost on the way into the raw tables."""

from __future__ import annotations

import json
import os
from decimal import Decimal

import pytest

from candlewick.operators import ingest
from candlewick.sources.landing import quarantined_landing, read_landing
from candlewick.streaming.ingest import read_quarantine, start_landing_ingest

GOOD = {"symbol": "BTCUSDT", "trade_id": 1, "price": "12.5", "quantity": "1", "quote_qty": "12.5",
        "trade_time": 1704067200000, "is_buyer_maker": False, "extracted_at": "2024-01-01T00:00:00.000001"}
BAD = [
    ({"price": "0.0000012345"}, "price: not decimal(18,8)"),
    ({"price": 0.0000012345}, "price: not decimal(18,8)"),
    ({"price": "12000000000"}, "price: not decimal(18,8)"),
    ({"price": "0.1234567800000000000001"}, "price: not decimal(18,8)"),
    ({"quantity": "12x.5"}, "quantity: not decimal(18,8)"),
    ({"trade_id": None}, "trade_id: missing"),
    ({"trade_id": 1.5}, "trade_id: not bigint"),
    ({"symbol": None}, "symbol: missing"),
    ({"is_buyer_maker": "perhaps"}, "is_buyer_maker: not boolean"),
    ({"extracted_at": "soon"}, "extracted_at: not timestamp_ntz"),
    ({"trade_time": {"ms": 1}}, "trade_time: not bigint"),
]


def record(change: dict, **more) -> dict:
    return {k: v for k, v in {**GOOD, **change, **more}.items() if v is not None}


def put(path: str, records: list, lines: bool) -> str:
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    with open(path, "w") as f:
        f.write("\n".join(texts) if lines else "[" + ",\n ".join(texts) + "]")
    return path


@pytest.mark.parametrize("lines", [True, False])
@pytest.mark.parametrize(("change", "reason"), BAD)
def test_bad_record_fails_or_is_set_aside(spark, scratch, change, reason, lines):
    path = put(os.path.join(scratch, "a.json"), [record({}), record(change, unknown=1), record({"trade_id": 2})], lines)
    with pytest.raises(Exception, match="bad record, " + reason.split(":")[0]):
        read_landing(spark, path, "trades", multiline=not lines).collect()
    good = read_landing(spark, path, "trades", multiline=not lines, on_bad="quarantine").collect()
    assert sorted(r.trade_id for r in good) == [1, 2]
    bad = quarantined_landing(spark, path, "trades", multiline=not lines).collect()
    assert [r.reason for r in bad] == [reason] and bad[0].file.endswith("a.json")
    assert json.loads(bad[0].record).get("quantity") == record(change).get("quantity")


def test_exact_values_and_missing_ones(spark, scratch):
    fit = [record({"price": "0.00000123", "trade_id": 3}), record({"price": 1e-8, "trade_id": 4}), record({"price": "1.500000000000", "trade_id": 5}), record({"price": None, "trade_id": 6})]
    rows = {r.trade_id: r.price for r in read_landing(spark, put(os.path.join(scratch, "a"), fit, True), "trades").collect()}
    assert rows == {3: Decimal("0.00000123"), 4: Decimal("0.00000001"), 5: Decimal("1.5"), 6: None}


@pytest.mark.parametrize("lines", [True, False])
def test_text_that_is_no_json(spark, scratch, lines):
    path = put(os.path.join(scratch, "a.json"), [record({}), '{"symbol": "BTC', ""], lines)
    with pytest.raises(Exception, match="not JSON"):
        read_landing(spark, path, "trades", multiline=not lines).collect()
    bad = quarantined_landing(spark, path, "trades", multiline=not lines).collect()
    assert [r.reason for r in bad] == ["record: not JSON"] and '{"symbol": "BTC' in bad[0].record
    good = read_landing(spark, path, "trades", multiline=not lines, on_bad="quarantine").count()
    assert good == (1 if lines else 0)  # an array cut short is bad as a whole


@pytest.mark.parametrize("lines", [True, False])
def test_stream_sets_bad_records_aside_once(spark, scratch, lines):
    landing, root = os.path.join(scratch, "landing"), os.path.join(scratch, "raw")
    os.makedirs(landing)
    put(os.path.join(landing, "1.json"), [record({}), *(record(c) for c, _ in BAD)], lines)

    def run(checkpoint: str, on_bad: str) -> None:
        start_landing_ingest(spark, landing, "trades", root, os.path.join(scratch, checkpoint), multiline=not lines, on_bad=on_bad).awaitTermination()

    with pytest.raises(Exception, match="bad record"):
        run("c0", "fail")
    for _ in range(2):  # the second run finds nothing new
        run("c1", "quarantine")
    put(os.path.join(landing, "2.json"), [record({"trade_id": 7}), record({"symbol": None})], lines)
    run("c1", "quarantine")
    assert sorted(r.trade_id for r in ingest.read_raw_table(spark, root, "trades").collect()) == [1, 7]
    found = sorted(r.reason for r in read_quarantine(spark, root, "trades").collect())
    assert found == sorted([*(reason for _, reason in BAD), "symbol: missing"])


def test_no_quarantine_without_bad_records(spark, scratch):
    assert read_quarantine(spark, scratch, "trades").count() == 0
    with pytest.raises(ValueError, match="on_bad"):
        start_landing_ingest(spark, scratch, "trades", scratch, on_bad="ignore")
    with pytest.raises(ValueError, match="on_bad"):
        read_landing(spark, scratch, "trades", on_bad="ignore")


def test_array_files_are_read_once(spark, scratch):
    """One line a file: no read of its own for every number, which the array's bytes show."""
    records = [record({"price": 0.5, "trade_id": i}) for i in range(2000)]
    path = put(os.path.join(scratch, "a.json"), records, False)
    assert read_landing(spark, path, "trades", multiline=True).count() == len(records)
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem

    def read_bytes() -> int:
        return sum(s.getBytesRead() for s in stats.getAllStatistics())

    before = read_bytes()
    rows = read_landing(spark, path, "trades", multiline=True).collect()
    assert {r.price for r in rows} == {Decimal("0.5")} and sorted(r.trade_id for r in rows) == list(range(2000))
    assert read_bytes() - before < 5 * os.path.getsize(path)


def test_array_file_as_one_line(spark, scratch):
    """Indented arrays, an object, nothing, a byte order mark and digits of numbers as written."""
    texts = {
        "indented": json.dumps([record({}), record({"trade_id": 2})], indent=2), "object": json.dumps(record({"trade_id": 3})),
        "empty": "", "blank": " \n\t", "none": "[]", "mark": "﻿" + json.dumps([record({"trade_id": 4})]),
    }
    for name, text in texts.items():
        with open(os.path.join(scratch, name), "w", newline="") as f:
            f.write(text)
    assert sorted(r.trade_id for r in read_landing(spark, scratch, "trades", multiline=True).collect()) == [1, 2, 3, 4]
    long = '[{"symbol": "BTCUSDT", "trade_id": 5, "price": 0.1234567800000000000001}]'
    bad = quarantined_landing(spark, put(os.path.join(scratch, "long"), [long[1:-1]], False), "trades", multiline=True).collect()
    assert [r.reason for r in bad] == ["price: not decimal(18,8)"]
