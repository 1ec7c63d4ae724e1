"""Toxicity of texts written in disguise: a noisy channel, then a lexicon.

Digits and signs that stand for letters, letters set apart and letters drawn
out make a lattice: each character may be itself, a letter that it looks like,
or nothing. Viterbi decoding picks the likeliest spelling under a character
trigram model of the whole corpus. The restored words are then looked up in a
lexicon of whole words and word beginnings, each with the lower Wilson bound of
the share of toxic documents among those that hold it; a document's words count
as independent evidence.

The lexicon is learned from at most ``max_labelled`` labelled rows (those of
smallest id hash), so its size is bounded; the character model has a fixed
size. Labels, language, source and id are not inputs of a score.

Null and empty texts score 0. Rows pass one by one: repeated rows get a score
each, other columns and their names play no part, an empty table gives an empty
one, and without labels every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.common import blocks, labelled_sample, ready_workers, stored, utf8, with_lists

# Letters that a sign is written for: fixed values.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Natural log of the channel: a sign for a letter, a sign for nothing, a repeated letter
#: for none, a gap for nothing, a gap between words.
AS_LETTER, AS_NOTHING, AS_REPEAT, AS_GAP, AS_SPLIT = -0.7, -8.0, -1.5, -0.5, -6.0
#: The same of a sign for nothing where it is punctuation: before a word, after it.
AS_OPENING, AS_CLOSING = {"(": -4.5, "|": -4.5}, {"!": -2.0, "|": -4.5, "$": -6.0}
LETTERS = 28  # the boundary of a word, a to z, any other letter
SIGNS = "".join(c for c in LOOKS if not c.isalnum())
_UNIT = rf"(?:[^\W_]|[{re.escape(SIGNS)}])"
SPACED = re.compile(rf"(?<![^\W_]){_UNIT}(?:[ .\-_*]{{1,2}}{_UNIT}){{2,}}(?![^\W_])")
DRAWN = re.compile(r"([^\W\d_])\1\1")
REPEATED = re.compile(r"([^\W\d_]|[^\w\s])\1\1")
EDGE = ".,;:?\"')[]{}<>*#%&~^`=-_/\\…„“”«»¿¡"  # none of the signs for letters
#: Longer runs are decoded each time, and in steps of so many characters.
STEP = 200
PREFIXES = range(3, 11)
#: Words of a lower bound under this are no evidence of toxicity together.
EVIDENT = 0.5


def letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123] = range(1, 27)
_CLASS[0xC3:0xF5] = 27  # first bytes of letters outside ASCII, nearly always
_FOLLOW = np.zeros(256, dtype=bool)
_FOLLOW[0x80:0xC0] = True


def trigram_counts(texts: list[bytes]) -> np.ndarray:
    """How often each three classes of characters follow each other."""
    flat = np.frombuffer(b"  ".join([b"", *texts, b""]).lower(), dtype=np.uint8)
    x = _CLASS[flat[~_FOLLOW[flat]]]
    return np.bincount((x[:-2] * LETTERS + x[1:-1]) * LETTERS + x[2:], minlength=LETTERS**3)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probability of a letter after two others, from all documents."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(LETTERS**3, dtype=np.int64)
        for part in parts:
            texts = utf8(part["text"])
            for a, b in blocks(texts):
                total += trigram_counts(texts[a:b])
        code = np.flatnonzero(total)
        yield pd.DataFrame({"code": code, "n": total[code]})

    ready_workers(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "code long, n long")
    counts = np.zeros(LETTERS**3)
    for r in rows.groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most 28^3 rows
        counts[r.code] = r.n
    counts = counts.reshape((LETTERS,) * 3)
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + LETTERS)
    two = (counts.sum(0) + 5 * one) / (counts.sum((0, 2))[:, None] + 5)
    return np.log((counts + 5 * two) / (counts.sum(2, keepdims=True) + 5))


class Restorer:
    """Viterbi decoding of disguised words."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.decode = lru_cache(maxsize=50_000)(self._decode)

    @staticmethod
    def options(c: str, before: str, nothing: float = AS_NOTHING) -> list[tuple[str, float]]:
        """What a character may stand for, with the log-probability of that."""
        if c.isalpha():
            found = [(c, 0.0)]
        elif c in LOOKS:
            found = [(x, AS_LETTER) for x in LOOKS[c]] + [("", nothing)]
        elif c in " .-_*":
            found = [("", AS_GAP), (" ", AS_SPLIT)]
        else:
            found = [("", AS_GAP)]
        return [*found, ("", AS_REPEAT)] if c == before else found

    def _decode(self, raw: str, drawn: bool = True) -> str:
        states: dict[tuple[int, int], tuple[float, list | None]] = {(0, 0): (0.0, None)}
        before, done = "", []
        inner = [i for i, c in enumerate(raw) if c.isalnum()] or [len(raw)]
        first, last = inner[0], inner[-1]
        for i, c in enumerate(raw):
            new: dict[tuple[int, int], tuple[float, list | None]] = {}
            nothing = (AS_OPENING if i < first else AS_CLOSING if i > last else {}).get(c, AS_NOTHING)
            options = self.options(c, before if drawn else "", nothing)
            for (p, q), (score, path) in states.items():
                for x, cost in options:
                    at, s, to = (p, q), score + cost, path
                    if x:
                        k = letter(x)
                        at, s, to = (q, k), s + self.model[p][q][k], [path, x]
                    if at not in new or s > new[at][0]:
                        new[at] = (s, to)
            states, before = new, c
            if i % STEP == STEP - 1:
                self.settle([path for _, path in states.values()], done)
        path = max(((s + self.model[p][q][0], at, to) for at, (s, to) in states.items() for p, q in [at]), key=lambda x: x[:2])[2]
        return "".join(done) + self.spelt(path)

    @staticmethod
    def spelt(path: list | None) -> str:
        out = []
        while path:
            path, x = path
            out.append(x)
        return "".join(reversed(out))

    def settle(self, paths: list[list | None], done: list[str]) -> None:
        """Move what all paths begin with to ``done``."""
        common: list[list] = []  # nodes of all paths so far, the last one first
        for n, path in enumerate(paths):
            own, nodes = [], {id(x) for x in common}
            while path and not (n and id(path) in nodes):
                own.append(path)
                path = path[0]
            if n:
                common = common[next((i for i, x in enumerate(common) if x is path), len(common)) :]
            else:
                common = own
        if common:
            done.append(self.spelt(common[0]))
            common[0][:] = [None, ""]

    def word(self, token: str) -> str:
        """A token in small letters, restored; edge punctuation goes. Without letters
        only one of several signs for letters, not digits alone, may be a word."""
        core = token.strip(EDGE)
        plain = core.strip(EDGE + SIGNS)
        if core.isalpha() and not DRAWN.search(core):
            return core
        if any(map(str.isalpha, core)):
            drawn = not plain.isalpha() or bool(REPEATED.search(core))
        elif len(found := {c for c in core if c in LOOKS}) < 2 or found.isdisjoint(SIGNS):
            return plain
        else:
            drawn = bool(REPEATED.search(core))
        return self.decode(core, drawn) if len(core) <= STEP else self._decode(core, drawn)

    def run(self, raw: str) -> str:
        """A run of letters set apart, restored; sums and the like stay."""
        if not any(map(str.isalpha, raw)) and any(c in SIGNS for c in raw):
            return raw
        return self.decode(raw) if len(raw) <= STEP else self._decode(raw)

    def restore(self, text: str) -> str:
        """The text in small letters, its words restored and set apart by spaces."""
        low = text.lower()
        low = SPACED.sub(lambda m: self.run(m[0]), low)
        drawn = bool(DRAWN.search(low))
        return " ".join([t if t.isalpha() and not drawn else self.word(t) for t in low.split()])


def beginnings(words: set[str]) -> set[str]:
    return {w[:n] for w in words for n in PREFIXES if len(w) > n}


def wilson(pos: int, neg: int, z: float = 2.5) -> float:
    """Lower bound of the share of pos."""
    n = pos + neg
    p = pos / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def restored_sample(sample: DataFrame, model: np.ndarray) -> DataFrame:
    """(words, y): the distinct restored words of each text. Texts that agree in
    their least hash of three words running count once, as copies of each other
    would pass the words that they happen to hold for evidence."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model)
        for part in parts:
            rows = [restorer.restore(t or "").split() for t in part["text"]]
            least = [
                min((xxhash.xxh64_intdigest(" ".join(w[i : i + 3])) >> 1 for i in range(max(1, len(w) - 2))), default=0)
                for w in rows
            ]
            yield pd.DataFrame({"words": [sorted(set(w)) for w in rows], "y": part["y"], "least": least})

    rows = sample.mapInPandas(run, "words array<string>, y int, least long")
    return stored(rows.dropDuplicates(["y", "least"]).select("words", "y"), "labelled")


def evidence(rows: DataFrame, made: Callable[[set[str]], set[str]], min_docs: int, floor: float) -> dict[str, float]:
    """Features of the words with the lower bound of their share of toxic documents."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            pos, neg = Counter(), Counter()
            for words, y in zip(part["words"], part["y"], strict=True):
                (pos if y else neg).update(made(set(words)))
            if names := list(pos.keys() | neg.keys()):
                yield pd.DataFrame({"f": names, "pos": [pos[f] for f in names], "neg": [neg[f] for f in names]})

    counts = rows.mapInPandas(run, "f string, pos long, neg long").groupBy("f")
    counts = counts.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    likely = counts.where((F.col("pos") >= min_docs) & (F.col("pos") / (F.col("pos") + F.col("neg")) >= floor))
    return {r.f: p for r in likely.collect() if (p := wilson(r.pos, r.neg)) >= floor}


Lexicon = tuple[dict[str, float], dict[str, float]]


def lexicon(rows: DataFrame, min_docs: int, floor: float) -> Lexicon:
    """Whole words, then beginnings of the words that aren't evident themselves."""
    words = evidence(rows, lambda w: w, min_docs, floor)
    evident = {w for w, p in words.items() if p >= EVIDENT}
    return words, evidence(rows, lambda w: beginnings(w - evident), min_docs, floor)


class Scorer:
    """Scores restored text by the lexicon."""

    def __init__(self, known: Lexicon):
        self.words, self.starts = known
        self.heads = {f[:3] for f in (*self.words, *self.starts)}

    def of(self, w: str) -> float:
        if w[:3] not in self.heads:
            return 0.0
        most = self.words.get(w, 0.0)
        return most if most >= EVIDENT else max(most, 0.0, *(self.starts.get(w[:n], 0.0) for n in PREFIXES if len(w) > n))

    def __call__(self, restored: str) -> float:
        found = [self.of(w) for w in set(restored.split())]
        clean = math.prod(1 - p for p in found if p >= EVIDENT)
        return 1 - clean if clean < 1 else max(found, default=0.0)


def score_texts(
    docs: DataFrame,
    labels: DataFrame,
    out: Column,
    max_labelled: int = 12_000,
    min_docs: int = 5,
    floor: float = 0.2,
    text_col: str = "text",
    score_col: str = "score",
    restored_col: str | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` with a score from 0 to 1 (higher: likelier
    toxic), and the restored text on demand. ``out`` marks, by id, the labels
    that are held out. Columns of the added names are replaced."""
    rows = docs.select(F.col("doc_id"), F.col(text_col).alias("text"))
    model = character_model(rows)
    sample = labelled_sample(rows, labels, "toxic", out, max_labelled)
    known = lexicon(restored_sample(sample, model), min_docs, floor)
    added = {score_col: T.DoubleType()} | ({restored_col: T.StringType()} if restored_col else {})

    def made() -> Callable[[list], tuple]:
        restorer, score = Restorer(model), Scorer(known)

        def of(texts: list) -> tuple:
            restored = [restorer.restore(t) if t else "" for t in texts]
            return ([score(t) for t in restored], restored)[: len(added)]

        return of

    return with_lists(docs, [text_col], added, made)
