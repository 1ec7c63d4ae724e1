"""Quality classifier: a linear hinge-loss model on naive Bayes features.

A text's features are indicators of its n-grams: words, pairs of words, words
repeated on the spot, and 1 to 4 runs of like characters (small letters,
capitals, digits, white space, each sign by itself, drawn out or not). They are
hashed into ``1 << FEATURE_BITS`` places. Every indicator is scaled by the log
of the ratio of its shares among good and bad documents; the linear model on
them is fitted by dual coordinate descent, and its margin becomes a probability
by a logistic curve fitted to margins of rows left out.

The model is fitted on at most ``max_labelled`` labelled rows (those of
smallest id hash), so what one task fits and what the workers get is bounded.
The features cover the whole text; labels, language, source and id are not
among them.

Null and empty texts have no feature and get the score of a zero margin.
Repeated rows get a score each, other columns play no part, an empty table
gives an empty one. Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import labelled_sample, mixed, with_lists
from candlewick.llm.suffix_dedup import Hashes
from candlewick.llm.tokens import word_hashes

FEATURE_BITS = 17
PLACES = 1 << FEATURE_BITS
GRAMS = 4

# Kinds of bytes: white space, small letters (all letters outside ASCII), capitals, digits; other signs by themselves.
_KIND = np.arange(256, dtype=np.uint64) + np.uint64(8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[0x0A] = 1
_KIND[0x61:0x7B] = _KIND[0x80:0x100] = 2
_KIND[0x41:0x5B] = 3
_KIND[0x30:0x3A] = 4


def places(x: np.ndarray, kind: int) -> np.ndarray:
    """Places of hashed n-grams of a kind."""
    return (mixed(x + np.uint64(kind << 56)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


class Features:
    """Places of the n-grams that a text has."""

    def __init__(self) -> None:
        self.hashes, self.has = Hashes(1 << 16), np.zeros(PLACES, dtype=bool)

    def __call__(self, text: str | None) -> np.ndarray:
        data = (text or "").encode("utf-8")
        if not data:
            return np.zeros(0, dtype=np.int64)
        words, _ = word_hashes([(text or "").lower().encode("utf-8")], self.hashes)
        again = words[1:] == words[:-1]
        kind = _KIND[np.frombuffer(data, dtype=np.uint8)]
        first = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
        size = np.diff(np.append(first, len(kind)))
        runs = kind[first] * np.uint64(2) + ((size > 1) & (kind[first] > 4)).astype(np.uint64)
        found = [
            places(words, 1),
            places(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:], 2),
            places(np.flatnonzero([again.any(), (again[1:] & again[:-1]).any()]).astype(np.uint64), 3),
        ]
        gram = np.zeros(len(runs), dtype=np.uint64)
        for n in range(1, min(GRAMS, len(runs)) + 1):
            gram = gram[: len(runs) - n + 1] * np.uint64(1024) + runs[n - 1 :] + np.uint64(1)
            found.append(places(gram, 3 + n))
        where = np.concatenate(found)
        self.has[where] = True
        out = np.flatnonzero(self.has)
        self.has[out] = False
        return out


def log_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log of the ratio of an n-gram's shares among rows of y = 1 and the others."""
    good, bad = np.zeros(PLACES), np.zeros(PLACES)
    for x, own in zip(rows, y, strict=True):
        (good if own else bad)[x] += 1
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    share = (good + bad) / len(y)
    return np.log((good + smooth * share) / (n1 + smooth) + 1e-12) - np.log((bad + smooth * share) / (n0 + smooth) + 1e-12)


def dual_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 0.01, rounds: int = 15) -> tuple[np.ndarray, float]:
    """Weights of the indicators (the ratio multiplied in) and the intercept of the
    squared-hinge model, by dual coordinate descent; classes weigh alike."""
    w, intercept = np.zeros(PLACES), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    bound = cost * len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    alpha, diagonal = np.zeros(len(y)), 0.5 / bound
    square = np.array([(ratio[x] ** 2).sum() + 1 for x in rows]) + diagonal
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(y)).tolist():
            x, r = rows[i], ratio[rows[i]]
            g = sign[i] * (w[x] @ r + intercept) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - g / square[i], 0.0)
            step, alpha[i] = (new - alpha[i]) * sign[i], new
            if step:
                w[x] += step * r
                intercept += step
    return w * ratio, intercept


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the curve from margins to the share of y = 1 (Newton steps,
    targets a little inside 0 and 1)."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * at
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Weights, intercept, and the logistic curve of margins of rows left out."""
    fold = np.arange(len(y)) % 3 == 0
    split = [rows[i] for i in np.flatnonzero(~fold)], y[~fold]
    if len(set(split[1].tolist())) == 2 and len(set(y[fold].tolist())) == 2:
        w, b = dual_descent(split[0], log_ratios(*split), split[1])
        curve = logistic(np.array([w[rows[i]].sum() + b for i in np.flatnonzero(fold)]), y[fold])
    else:
        curve = (1.0, 0.0)
    w, b = dual_descent(rows, log_ratios(rows, y), y)
    return w, b, *curve


def fitted(sample: DataFrame) -> tuple[np.ndarray, float, float, float] | None:
    """The model of a bounded sample of (text, y), fitted in one task."""

    def grams() -> Callable[[list], tuple]:
        of = Features()
        return lambda texts: ([of(t).astype("<i4").tobytes() for t in texts],)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["x", "y"])
        y = group["y"].to_numpy()
        if len(set(y.tolist())) < 2:
            return pd.DataFrame({"place": [], "w": []}).astype({"place": "int64", "w": "float64"})
        w, *rest = fit([np.frombuffer(x, dtype="<i4").astype(np.int64) for x in group["x"]], y)
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": [*at, PLACES, PLACES + 1, PLACES + 2], "w": [*w[at], *rest]})

    rows = with_lists(sample, ["text"], {"x": T.BinaryType()}, grams).drop("text")
    found = rows.groupBy(F.lit(0).alias("all")).applyInPandas(run, "place long, w double").collect()
    if not found:
        return None
    w = np.zeros(PLACES + 3)
    for r in found:
        w[r.place] = r.w
    return w[:PLACES], *w[PLACES:].tolist()


def score_texts(docs: DataFrame, labels: DataFrame, out: Column, max_labelled: int = 6000, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with a score from 0 to 1 (higher: likelier
    good). ``out`` marks, by id, the labels that are held out."""
    rows = docs.select(F.col("doc_id"), F.col(text_col).alias("text"))
    model = fitted(labelled_sample(rows, labels, "quality", out, max_labelled))

    def made() -> Callable[[list], tuple]:
        of = Features()

        def score(text: str | None) -> float:
            if model is None:
                return 0.5
            w, b, slope, shift = model
            return float(1 / (1 + np.exp(-np.clip(slope * (w[of(text)].sum() + b) + shift, -30, 30))))

        return lambda texts: ([score(t) for t in texts],)

    return with_lists(docs, [text_col], {score_col: T.DoubleType()}, made)
