"""Structural checks on the physical plans (regression guard for the scale
properties described in the README)."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    text = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_bars_use_hash_aggregation(spark):
    text = _plan(entry.queries()["candles_1h"](spark, SF_SMALL))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_dedupe_limits_before_the_shuffle(spark):
    text = _plan(entry.queries()["dedupe_latest"](spark, SF_SMALL))
    partial = text.find("Partial")
    assert "WindowGroupLimit" in text and partial != -1
    # the partial limit sits below (after, in the printed tree) the exchange
    assert text.rfind("Exchange hashpartitioning") < text.rfind("WindowGroupLimit")


def test_scans_read_only_used_columns(spark):
    text = _plan(entry.queries()["panel_data_freshness"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all(len(s.split(",")) <= 6 for s in schemas)
    assert any(s.count(":") <= 2 for s in schemas)


def test_blocked_fact_does_not_reshuffle_windowed_rows(spark):
    from candlewick.session import release_scratch

    df = entry.queries()["fct_trades"](spark, SF_SMALL)
    text = _plan(df)
    release_scratch(spark)
    # one exchange on (series, block) for the window and at most one for the
    # small offsets side; never a second one on the windowed rows
    assert len(re.findall(r"Exchange hashpartitioning\(_series#\d+, _blk#\d+L?", text)) <= 2
    assert "rangepartitioning" not in text  # the range sort ran once, into the written table
