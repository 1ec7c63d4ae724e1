"""Column tests count failures like schema tests do."""

from __future__ import annotations

from candlewick.operators import quality
from candlewick.plans.catalog import QUERIES

SF_SMALL = "/root/testdata/sf0.001"


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("x",), ("x",), ("y",)], "s string")
    rules = [quality.unique("s"), quality.not_null("s"), quality.accepted_values("s", ["a", "b"])]
    got = {r.test: r.failures for r in quality.check(df, "m", rules).collect()}
    assert got == {"unique": 2, "not_null": 1, "accepted_values": 2}


def test_declared_suite_has_28_tests_and_flags_snapshot_fanout(spark):
    res = {(r.model, r.column_name, r.test): r.failures for r in QUERIES["quality_checks"](spark, SF_SMALL).collect()}
    assert len(res) == 28
    assert res[("stg_tickers", "symbol", "unique")] == 5  # one snapshot per day, 5 symbols
    assert sum(v for k, v in res.items() if k != ("stg_tickers", "symbol", "unique")) == 0
