"""Spelling variants: words of one edit apart, by a reduced alphabet.

Words are runs of Latin letters of the texts, some with a letter taken out by rule
(``cut_every``), counted over all documents; the vocabulary is those of ``least_letters``
code points and ``least_count`` occurrences or more. Two words are near if they differ
by exactly one inserted, deleted or replaced code point.

Near words meet by reduced words: every letter is hashed to one of ``symbols`` symbols,
which keeps an edit an edit, or hides it. Each distinct reduced word makes its full
one-edit neighbourhood, as numbers that follow from sums over its beginnings and ends in
one step each, and the neighbourhoods are joined with the reduced vocabulary. The words
behind two reduced words that meet (and behind one and the same) are paired by what
is left of them without one letter, and checked on the original strings. Words of a
reduced word are dealt into blocks of about ``block_words``, pairs of blocks being
checked each in one row, so a reduced word that many words share is spread.

A word's form is its near word of largest count, of the smallest of equal ones, if that
has ``ratio`` times its own or more; forms lead to rising counts, so the roots are found
by a few rounds of doubling, each a written table.

Null texts have no words; a null id counts as an empty one where letters are cut.
Repeated rows count each. A text of one very long run gives one word, whose neighbourhood
grows with its length. An empty table, or one without such words, gives an empty one.
Columns other than doc_id and text play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import mixed, ready_workers, stored

CUT_EVERY = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SYMBOLS = 8
BLOCK_WORDS = 256
#: Distinct words that a worker counts before it passes them on.
HELD_WORDS = 200_000
#: Numbers that a worker makes at a time.
HELD_NUMBERS = 1_000_000
#: Weight of a place in a word's number, and its inverse, modulo 2^64.
BASE = 0x9E3779B97F4A7C15
UNDO = pow(BASE, -1, 1 << 64)

#: Latin-1 letters, A-Z in small, other code points as a space.
RUNS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """The runs of letters of a text, in Latin-1."""
    return (text or "").encode("latin-1", "replace").translate(RUNS).split()


def cut(run: bytes, start: int, every: int) -> bytes:
    """The run, without a letter if the rule takes one; ``start`` is the checksum
    of what precedes it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, cut_every: int = CUT_EVERY, least_letters: int = LEAST_LETTERS, text_col: str = "text") -> DataFrame:
    """(word, n): words of enough letters with their occurrences in all texts."""
    ready_workers(docs.sparkSession)

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()
        for part in parts:
            for i, text in zip(part["id"], part["text"], strict=True):
                start = zlib.crc32(f"{i}:".encode())
                for found, n in Counter(runs_of(text)).items():
                    word = cut(found, start, cut_every)
                    if len(word) >= least_letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield frame(held)
                    held.clear()
        if held:
            yield frame(held)

    def frame(held: Counter[bytes]) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": list(held.values())})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, letters): words of one length each, a row of letters per word."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, np.frombuffer(b"".join(words[i] for i in at), dtype=np.uint8).reshape(len(at), n).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    """Weights of the first ``n`` places."""
    out = np.full(n, BASE, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def beginnings(letters: np.ndarray) -> np.ndarray:
    """Numbers of the beginnings of words, from the empty one to the whole."""
    out = np.zeros((letters.shape[0], letters.shape[1] + 1), dtype=np.uint64)
    np.cumsum(letters * powers(letters.shape[1]), axis=1, dtype=np.uint64, out=out[:, 1:])
    return out


def without_one(begin: np.ndarray) -> np.ndarray:
    """Numbers of words without each of their letters."""
    return begin[:, :-1] + (begin[:, -1:] - begin[:, 1:]) * np.uint64(UNDO)


def reduced(letters: np.ndarray, symbols: int) -> np.ndarray:
    """Symbols of letters, from 1 on."""
    return letters % np.uint64(symbols) + np.uint64(1)


def neighbourhood(own: np.ndarray, symbols: int) -> np.ndarray:
    """Numbers of all that one edit makes of reduced words, a row per word."""
    begin, w = beginnings(own), powers(own.shape[1] + 1)
    whole, found = begin[:, -1:], [without_one(begin)]
    for s in np.arange(1, symbols + 1, dtype=np.uint64):
        found.append(whole + (s - own) * w[:-1])
        found.append(begin + s * w + (whole - begin) * np.uint64(BASE))
    return np.concatenate(found, axis=1)


def reduced_numbers(words: DataFrame, symbols: int) -> DataFrame:
    """The rows (word, n) with ``r``, the number of the reduced word."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            r = np.zeros(len(part), dtype=np.uint64)
            for at, letters in by_length([w.encode("latin-1") for w in part["word"]]):
                r[at] = beginnings(reduced(letters, symbols))[:, -1]
            yield part.assign(r=r.view(np.int64))

    return words.mapInPandas(run, "word string, n long, r long")


def neighbour_numbers(words: DataFrame, symbols: int) -> DataFrame:
    """(r, other): numbers one edit from the reduced words of the rows, those greater
    than their own only, as neighbours are each other's."""

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for _, letters in by_length([w.encode("latin-1") for w in part["word"]]):
                step = max(1, HELD_NUMBERS // ((2 * letters.shape[1] + 1) * (symbols + 1)))
                for a in range(0, len(letters), step):
                    own = reduced(letters[a : a + step], symbols)
                    r = beginnings(own)[:, -1].view(np.int64)
                    made = np.sort(neighbourhood(own, symbols).view(np.int64), axis=1)
                    on = made > r[:, None]
                    on[:, 1:] &= made[:, 1:] != made[:, :-1]
                    yield pd.DataFrame({"r": np.repeat(r, on.sum(axis=1)), "other": made[on]})

    return words.select("word").mapInPandas(run, "r long, other long")


def candidate_blocks(words: DataFrame, symbols: int, block_words: int) -> DataFrame:
    """(a, b, same): lists of (word, n) whose reduced words are equal or one edit apart,
    in blocks; ``same`` where both are one block, which has its pairs in itself."""
    sized = words.join(words.groupBy("r").agg(F.ceil(F.count("*") / block_words).alias("blocks")), "r")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    members = sized.groupBy("r", block.alias("block")).agg(F.collect_list(F.struct("word", "n")).alias("words"))
    members = stored(members, "members")
    some = words.groupBy("r").agg(F.min("word").alias("word"))
    hits = neighbour_numbers(some, symbols).join(some.select(F.col("r").alias("other")), "other", "left_semi").distinct()
    left = members.select("r", F.col("block").alias("x"), F.col("words").alias("a"))
    right = members.select(F.col("r").alias("other"), F.col("block").alias("y"), F.col("words").alias("b"))
    apart = hits.join(left, "r").join(right, "other").select("a", "b", F.lit(False).alias("same"))
    alike = left.join(right, (F.col("r") == F.col("other")) & (F.col("x") <= F.col("y")))
    return apart.unionByName(alike.select("a", "b", (F.col("x") == F.col("y")).alias("same")))


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether two different strings differ by one code point put in, left out or replaced."""
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def keys_of(words: list[bytes], pair: np.ndarray, other_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, words): numbers that words of a pair of blocks share if one edit apart: of
    what is left without a letter at a place, for words as long as those of the other block;
    of that in the longer word, of the whole in the shorter, if they are one letter apart."""
    keys, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, letters in by_length(words):
        n, begin = letters.shape[1], beginnings(letters)
        p, apart = mixed(pair[i].astype(np.uint64) + np.uint64(1)), other_size[i] - n
        if (long := apart <= 0).any():
            left = without_one(begin[long]) + p[long][:, None]
            left += np.where(apart[long] == 0, np.uint64(BASE), np.uint64(0))[:, None] * np.arange(1, n + 1, dtype=np.uint64)
            keys.append(left.ravel())
            at.append(np.repeat(i[long], n))
        short = apart > 0
        keys.append(begin[short, -1] + p[short])
        at.append(i[short])
    return mixed(np.concatenate(keys)), np.concatenate(at)


def met(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of equal keys."""
    order = np.argsort(b, kind="stable")
    low = np.searchsorted(b[order], a, "left")
    n = np.searchsorted(b[order], a, "right") - low
    x = np.repeat(np.arange(len(a)), n)
    return x, order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def checked(a: list[bytes], b: list[bytes], pair_a: np.ndarray, pair_b: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of ``a`` and ``b`` that are one edit apart within a pair of
    blocks; within one block each two words once."""
    size_a = np.zeros(len(same), dtype=np.int64)
    size_b = np.zeros(len(same), dtype=np.int64)
    size_a[pair_a] = np.fromiter(map(len, a), np.int64, len(a))  # the words of a block are of one length
    size_b[pair_b] = np.fromiter(map(len, b), np.int64, len(b))
    key_a, word_a = keys_of(a, pair_a, size_b[pair_a])
    key_b, word_b = keys_of(b, pair_b, size_a[pair_b])
    x, y = met(key_a, key_b)
    found = np.unique(word_a[x].astype(np.int64) * max(len(b), 1) + word_b[y])
    x, y = found // max(len(b), 1), found % max(len(b), 1)
    inner = same[pair_a[x]]
    on = [pair_a[i] == pair_b[j] and a[i] != b[j] and (not s or a[i] < b[j]) and one_edit(a[i], b[j]) for i, j, s in zip(x, y, inner, strict=True)]
    on = np.array(on, dtype=bool)
    return x[on], y[on]


def near_words(blocks: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words of each word that has any, and the
    one of largest count, the smallest of equal ones, as (-n, word)."""

    def lists(column: pa.ListArray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        flat = column.flatten()
        size = np.diff(column.offsets.to_numpy())
        words = [w.encode("latin-1") for w in flat.field("word").to_pylist()]
        return words, flat.field("n").to_numpy(zero_copy_only=False), np.repeat(np.arange(len(size)), size)

    def summed(word: list[bytes], other: list[bytes], n: np.ndarray) -> pd.DataFrame:
        names, at = np.unique(np.array([*word, *other], dtype=object), return_inverse=True)
        w, o = at[: len(word)], at[len(word) :]
        order = np.lexsort((o, -n, w))
        first = np.flatnonzero(np.append(True, w[order][1:] != w[order][:-1])) if len(order) else order
        best = order[first]
        return pd.DataFrame({
            "word": [x.decode("latin-1") for x in names[w[best]]], "n_near": np.diff(np.append(first, len(order))),
            "less": -n[best], "form": [x.decode("latin-1") for x in names[o[best]]],
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n_a, pair_a = lists(batch.column("a"))
            b, n_b, pair_b = lists(batch.column("b"))
            x, y = checked(a, b, pair_a, pair_b, batch.column("same").to_numpy(zero_copy_only=False).astype(bool))
            if len(x):
                ax, by = [a[i] for i in x], [b[j] for j in y]
                found = summed([*ax, *by], [*by, *ax], np.concatenate([n_b[y], n_a[x]]))
                yield pa.RecordBatch.from_pandas(found, schema=schema, preserve_index=False)

    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("less", pa.int64()), ("form", pa.string())])
    rows = blocks.mapInArrow(run, "word string, n_near long, less long, form string")
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that (word, form) lead to. Counts grow by the
    ratio from form to form, so a round of doubling more than the logarithm ends it."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        joined = stored(joined, "roots")
        found = joined.drop("moved")
        if joined.where("moved").isEmpty():
            return found


def variants(
    docs: DataFrame,
    cut_every: int = CUT_EVERY,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    symbols: int = SYMBOLS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = word_counts(docs, cut_every, least_letters).where(F.col("n") >= least_count)
    words = stored(reduced_numbers(words, symbols), "vocabulary")
    near = near_words(candidate_blocks(words, symbols, block_words))
    form = (-F.col("best.less") >= F.col("n") * ratio) & F.col("best").isNotNull()
    rows = words.drop("r").join(near, "word", "left").select(
        "word", F.when(form, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(form, -F.col("best.less")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    last = roots(rows.where("form is not null"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
