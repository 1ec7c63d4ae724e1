"""Quality classifier: the fit itself, held-out accuracy, odd rows."""

from __future__ import annotations

import numpy as np

from candlewick.llm import quality_model as q
from candlewick.llm.common import held_out, labelled_sample
from candlewick.llm.queries import op2_quality

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = op2_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    out = got[got.held_out]
    assert ((out.predicted == 1) == (out.quality == 1)).mean() > 0.95
    assert out.score.between(0, 1).all()


def test_descent_reaches_the_least_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 80)
    rows = [np.unique(rng.integers(0, 12, 5) + 4 * own) for own in y]
    ratio = np.zeros(q.PLACES)
    ratio[:16] = rng.normal(size=16)
    w, b = q.dual_descent(rows, ratio, y, cost=0.5, rounds=400)
    x = np.zeros((80, 17))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r]
        x[i, 16] = 1
    sign = np.where(y == 1, 1, -1)
    weight = 0.5 * 80 / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    at = np.append(np.divide(w[:16], ratio[:16]), b)
    slack = np.maximum(0, 1 - sign * (x @ at))
    gradient = at - 2 * (weight * slack * sign) @ x
    assert np.abs(gradient).max() < 1e-3


def test_ratio_of_an_absent_gram_is_zero():
    r = q.log_ratios([np.array([1, 2]), np.array([2]), np.array([2, 3])], np.array([1, 0, 0]))
    assert abs(r[9]) < 1e-9 and r[1] > 0 > r[3]


def test_cases(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 5)))
    good = [" ".join(word() for _ in range(20)) + "." for _ in range(60)]
    bad = [" ".join(word() + "###" for _ in range(20)) for _ in range(60)]
    docs = [(i, t, "clash", 1) for i, t in enumerate(good + bad)]
    docs += [(200, None, "", None), (201, "", None, 2), (202, "a " * 60_000, "", 3), (202, "a " * 60_000, "", 3), (None, bad[0], "", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string, x int")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = q.score_texts(df, labels, held_out(4, 2))
    assert got.columns == ["doc_id", "text", "x", "score"] and got.count() == len(docs)
    rows = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert all((rows[(i, t)] > 0.7) == (i < 60) for i, t in enumerate(good + bad))
    assert rows[(200, None)] == rows[(201, "")] and rows[(None, bad[0])] < 0.5
    assert q.score_texts(df.limit(0), labels, held_out(4, 2)).count() == 0
    assert {r.score for r in q.score_texts(df, labels.where("quality = 1"), held_out(4, 2)).collect()} == {0.5}


def test_sample_has_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"copy {i % 7}") for i in range(300)] + [(i, "own") for i in range(2, 6)] + [(6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, quality int")
    rows = [tuple(r) for r in labelled_sample(docs, labels, "quality", held_out(1, 1), 100).collect()]
    assert len(rows) == 6 and sum(t is not None and t.startswith("copy") for t, _ in rows) == 1 and (None, 0) in rows
