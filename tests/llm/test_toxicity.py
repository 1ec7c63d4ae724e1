"""Toxicity: decoding of disguises, held-out accuracy, odd rows."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from candlewick.llm import toxicity
from candlewick.llm.common import held_out
from candlewick.llm.queries import op4_toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.character_model(spark.read.parquet(f"{SF}/documents.parquet"))


def test_model_is_a_distribution(model):
    assert np.allclose(np.exp(model).sum(axis=2), 1)


@pytest.mark.parametrize(
    ("raw", "want"),
    [("1d10t", "idiot"), ("l0s3r", "loser"), ("c1own", "clown"), ("$tup1d", "stupid"), ("mooooron", "moron"),
     ("tr@sh!!", "trash"), ("the", "the"), ("there,", "there"), ("s c u m", "scum"), ("p-a-t-h-e-t-i-c", "pathetic"),
     ("", ""), ("1234", "1234"), ("...", "")],
)
def test_restored(model, raw, want):
    assert toxicity.Restorer(model).restore(raw) == want


def test_decoding_is_the_best_of_all_paths(model):
    r = toxicity.Restorer(model)
    for raw in ("c1o!n", "b0o0k", "a.1", "ss5s"):
        before, choices = "", []
        for c in raw:
            choices.append(r.options(c, before))
            before = c
        best = -np.inf
        for path in itertools.product(*choices):
            s, p, q = sum(c for _, c in path), 0, 0
            for x, _ in path:
                if x:
                    s, p, q = s + model[p, q, toxicity.letter(x)], q, toxicity.letter(x)
            s += model[p, q, 0]
            if s > best:
                best, want = s, "".join(x for x, _ in path)
        assert r.decode(raw) == want


def test_held_out_accuracy(spark):
    got = op4_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    out = got[got.held_out]
    hit = ((out.predicted == 1) & (out.toxic == 1)).sum()
    assert hit / (out.toxic == 1).sum() > 0.8
    assert hit / (out.predicted == 1).sum() > 0.95
    assert out.score.between(0, 1).all()


def test_cases(spark):
    said = ["a kind word for the day", "you utter scoundrel of the north"]
    rng = np.random.default_rng(0)
    other = [" ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(40)) for _ in range(90)]
    docs = [(i, f"{other[i]} {said[i % 2]}", "clash", 1) for i in range(90)]
    docs += [(90, None, "", None), (91, "", None, 2), (92, "5coundre1", "", 3), (92, "5coundre1", "", 3), (None, "x " * 40_000, "", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string, y int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.score_texts(df, labels, held_out(3, 1), restored_col="restored")
    assert got.columns == ["doc_id", "text", "y", "score", "restored"]
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert rows[(90, None)].score == rows[(91, "")].score == 0
    assert rows[(92, "5coundre1")].restored == "scoundrel" and rows[(92, "5coundre1")].score > 0.7
    assert rows[(0, docs[0][1])].score < 0.5 and rows[(None, "x " * 40_000)].score < 0.5
    assert got.count() == len(docs)
    assert toxicity.score_texts(df.limit(0), labels, held_out(3, 1)).count() == 0
    assert {r.score for r in toxicity.score_texts(df, labels.limit(0), held_out(3, 1)).collect()} == {0.0}


def test_runs_of_any_length_and_with_signs(model, monkeypatch):
    r = toxicity.Restorer(model)
    assert [r.restore(raw) for raw in ("$ t u p i d", "1 d ! o t", "(s c u m)")] == ["stupid", "idiot", "scum"]
    long = "  ".join(["s t u p i d"] * 40)
    assert len(long) > 200 and r.restore(long).count("stupid") == 40
    whole = r.restore(" ".join("you are a stupid idiot"[i % 22] for i in range(900)))
    monkeypatch.setattr(toxicity, "STEP", 10_000)
    assert toxicity.Restorer(model).restore(" ".join("you are a stupid idiot"[i % 22] for i in range(900))) == whole


@pytest.mark.parametrize(
    ("raw", "want"),
    [("!diot", "idiot"), ("|oser", "loser"), ("(lown", "clown"), ("worthle$$", "worthless"), ("$tup!d!", "stupid"), ("@$", "as"),
     ("hello!", "hello"), ("good!!", "good"), ("(see", "see"), ("(the!)", "the"), ("!!!", ""), ("$$$", "")],
)
def test_signs_at_edges(model, raw, want):
    assert toxicity.Restorer(model).restore(raw) == want
