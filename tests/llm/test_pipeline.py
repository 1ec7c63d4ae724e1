"""Each stage of the corpus pipeline against a plain version on its own input."""

from __future__ import annotations

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from candlewick.llm.common import stored
from candlewick.llm.queries import op4_toxicity, word_bpe_path
from tests.llm.test_decontam import plain as plain_overlaps
from tests.llm.test_simhash import plain_components, plain_print
from tests.llm.test_suffix_dedup import plain as plain_removal

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF), name))
    assert all(df.columns == columns for df in kept[:-1])
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]

    toxic = {r.doc_id for r in op4_toxicity(spark, SF).where("predicted = 1").collect()}
    assert set(rows[1]) == set(rows[0]) - toxic

    ids = sorted(rows[1])
    group = plain_components(ids, [plain_print(rows[1][i].text) for i in ids])
    assert set(rows[2]) == set(group)

    ids = sorted(rows[2])
    removed = dict(zip(ids, plain_removal([rows[2][i].text for i in ids], corpus_pipeline.REPEAT_BYTES), strict=True))
    assert set(rows[3]) == set(ids)
    for i in ids:
        was, now = rows[2][i].text, rows[3][i].text
        if not removed[i][1]:
            assert now == was
        else:
            assert len(now.encode()) <= len(was.encode()) - removed[i][1]
        assert rows[3][i].n_chars == len(now)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    short = [i for i in sorted(rows[3]) if len(rows[3][i].text) < 1500]
    found = {d for d, *_ in plain_overlaps([(i, rows[3][i].text) for i in short], items)}
    assert {i for i in short if i in rows[4]} == set(short) - found

    library = Tokenizer.from_file(word_bpe_path())
    assert set(rows[5]) == set(rows[4])
    for i, r in rows[5].items():
        want = library.encode(rows[4][i].text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == want
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(bytes(r.ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()

    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == set(rows[5])


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "word " * 30_000, "en", "a", 1), (3, "some words here", "", "", 3), (3, "some words here", "", "", 3)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "odd")
    assert sorted(r.doc_id for r in docs.collect()) == [1, 2, 3]
    docs = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "odd")
    assert docs.count() == 0


def test_clashing_columns_pass_every_stage(spark):
    names = ["_toxicity", "_id", "_content", "_none", "_n", "_k1", "_K2", "_spans", "fp", "label", "score", "k1", "h", "seg", "item_id", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = stored(docs.select("*", *(docs.doc_id.cast("string").alias(n) for n in names)), "extra")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        extra = stored(stage(spark, extra, SF), name)
        assert extra.columns == [*docs.columns, *names]
        assert all(r[n] == str(r.doc_id) for r in extra.collect() for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF).count() == extra.count()


def test_planted_passages_of_fifty_words_go(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghilmnorstu"), rng.integers(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    planted = [text(rng.integers(51, 61)) for _ in range(40)]
    rows = [(i, f"{text(80)} {planted[i % 40]} {text(70)}") for i in range(80)] + [(100 + i, text(200)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, docs, SF).collect()}
    gone = [planted[i % 40] not in left[i] and len(left[i]) <= len(t) - len(planted[i % 40]) for i, t in rows[:80]]
    assert np.mean(gone) >= 0.9
    assert all(left[i] == t for i, t in rows[80:])
