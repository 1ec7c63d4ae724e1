"""Token rollups: signed batches, idempotent commits, the registered query."""

from __future__ import annotations

import re
from collections import Counter

import duckdb

from candlewick.llm import token_rollup as r
from candlewick.llm.queries import ORACLE, op5_token_rollup

SCHEMA = "doc_id long, text string, lang string, source string, tokens int"


def plain(text, version):
    return len(re.findall(r.VERSIONS[version].replace(r"\x{80}", "\x80").replace(r"\x{10FFFF}", "\U0010ffff"), text or ""))


def rows_of(df):
    return {(x.source, x.lang, x.tokenizer): (x.docs, x.tokens, x.bytes) for x in df.collect()}


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(ORACLE["op5_token_rollup"]).fetchall()
    assert rows_of(op5_token_rollup(spark, sf)) == {x[:3]: x[3:] for x in want}


def test_batches(spark, tmp_path):
    docs = [(1, "one two", "en", "a", 9), (2, "Three, four! é\U0001f600x", "en", "a", 9), (3, None, None, "b", 9), (3, None, None, "b", 9), (4, "", "en", None, 9), (5, "x " * 50_000, "en", None, 9)]
    df = spark.createDataFrame(docs, SCHEMA)
    counts = r.counted(df, ["words-1", "signs-2"]).collect()
    assert [(c.tokens_0, c.tokens_1) for c in counts] == [(plain(t, "words-1"), plain(t, "signs-2")) for _, t, *_ in docs]
    counts = r.counted(df, ["words-1"]).withColumnRenamed("tokens_0", "tokens")
    roll = r.Rollup(spark, str(tmp_path / "rollup"))
    assert roll.totals().count() == 0 and roll.batches() == []
    load, gone = r.changes(counts, "words-1", 1), r.changes(counts.where("doc_id = 1"), "words-1", -1)
    assert roll.commit("b1", load) and not roll.commit("b1", load)
    want = Counter()
    assert rows_of(roll.totals())[("b", None, "words-1")] == (2, 0, 0)
    assert roll.commit("b2", gone) and not roll.commit("b2", load)
    assert rows_of(roll.totals())[("a", "en", "words-1")] == (1, plain(docs[1][1], "words-1"), len(docs[1][1].encode()))
    assert roll.commit("b3", r.changes(counts.where("doc_id <> 1"), "words-1", -1))
    assert rows_of(roll.totals()) == dict(want)
    assert roll.commit("b4", load.limit(0)) and roll.batches() == ["b1", "b2", "b3", "b4"]


def test_a_late_writer_changes_nothing(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "one two", "en", "a", 9)], SCHEMA)
    rows = r.changes(r.counted(df, ["words-1"]).withColumnRenamed("tokens_0", "tokens"), "words-1", 1)
    roll, late = (r.Rollup(spark, str(tmp_path / "rollup")) for _ in range(2))
    inner = r.summed

    def while_another_commits(x):
        monkeypatch.setattr(r, "summed", inner)
        assert late.commit("b1", rows)
        return inner(x)

    monkeypatch.setattr(r, "summed", while_another_commits)
    assert not roll.commit("b1", rows)
    assert rows_of(roll.totals()) == {("a", "en", "words-1"): (1, 2, 7)}


def test_query_with_null_ids(spark, tmp_path):
    docs = [(1, "one two", "en", "a"), (2, "one two", "en", "a"), (None, "one two", "en", "a"), (None, "alone", "de", "b"), (3, None, None, "b")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(ORACLE["op5_token_rollup"]).fetchall()
    assert rows_of(op5_token_rollup(spark, str(tmp_path))) == {x[:3]: x[3:] for x in want}
