"""The registered queries of the text operators, with their parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    bpe,
    decontam,
    divergence_audit,
    html_text,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    suffix_tree_lm,
    token_rollup,
    toxicity,
)
from candlewick.llm.common import documents, held_out, stored
from candlewick.session import scratch_path


def word_bpe_path() -> str:
    """Place of the tokenizer file that queries and pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), word_bpe_path())


#: Scores from here on are predicted to have the label.
LABEL_SCORE = 0.7


def predicted() -> Column:
    return (F.col("score") >= LABEL_SCORE).cast("int").alias("predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = held_out(4, 2)
    scored = quality_model.score_texts(docs, documents(spark, sf_dir, "labels"), out)
    return scored.select("doc_id", out.alias("held_out"), "score", predicted())


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = held_out(3, 1)
    scored = toxicity.score_texts(docs, documents(spark, sf_dir, "labels"), out)
    return scored.select("doc_id", out.alias("held_out"), "score", predicted())


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: each is loaded under the first
    tokenizer version, copies of the text of a smaller id and documents without an
    id are deleted again, and the documents left are counted anew under the second
    version. The first two batches are sent twice."""
    first, second = token_rollup.VERSIONS
    counts = stored(token_rollup.counted(documents(spark, sf_dir), [first, second]), "counts")
    least = counts.groupBy("content").agg(F.min("doc_id").alias("least"))
    counts = stored(counts.join(least, "content"), "counts").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(True)))
    old, new = counts.withColumn("tokens", F.col("tokens_0")), counts.withColumn("tokens", F.col("tokens_1"))
    load = token_rollup.changes(old, first, 1)
    delete = token_rollup.changes(old.where("copy"), first, -1)
    anew = token_rollup.changes(old.where("not copy"), first, -1).unionByName(token_rollup.changes(new.where("not copy"), second, 1))
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "rollup"))
    for batch, rows in (("1-load", load), ("2-copies", delete), ("1-load", load), ("3-anew", anew), ("2-copies", delete)):
        rollup.commit(batch, rows)
    return rollup.totals()


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(documents(spark, sf_dir), shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(documents(spark, sf_dir), length=400)


def op10_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(7, 2)
    rows = suffix_tree_lm.scored(documents(spark, sf_dir), out)
    return rows.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.audit(documents(spark, sf_dir))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(documents(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_decontam": op3_decontam,
    "op4_toxicity": op4_toxicity,
    "op5_token_rollup": op5_token_rollup,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash": op7_simhash,
    "op8_sharding": op8_sharding,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_suffix_tree_lm": op10_suffix_tree_lm,
    "op11_spelling": op11_spelling,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_html_text": op13_html_text,
}

ORACLE: dict[str, str] = {
    "op5_token_rollup": r"""
        with firsts as (select min(doc_id) as doc_id from documents group by md5(coalesce(text, '')))
        select source, lang, 'signs-2' as tokenizer, count(*) as docs,
            sum(len(regexp_extract_all(coalesce(text, ''),
                '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[^0-9A-Za-z\x{80}-\x{10FFFF}\x20\x09-\x0D]')))::bigint as tokens,
            sum(coalesce(strlen(text), 0))::bigint as bytes
        from documents join firsts using (doc_id)
        group by source, lang""",
    "op12_divergence_audit": r"""
        with docs as materialized (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x{00}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') as found
            from documents),
        counts as materialized (
            select lang, source, term, count(*) as n, count(distinct row) as docs
            from (select row, lang, source, unnest(found) as term from docs) group by all),
        vocabulary as materialized (
            select lang, term, sum(n)::hugeint as n from counts group by lang, term having sum(docs) >= 3),
        langs as (select lang, sum(n)::hugeint as total, count(*)::hugeint as terms from vocabulary group by lang),
        held as (select lang, source, term, counts.n from counts join vocabulary using (lang, term)),
        totals as (select lang, source, sum(n)::hugeint as total from held group by all),
        groups as materialized (
            select lang, source, coalesce(totals.total, 0) as total
            from (select distinct lang, source from docs) left join totals using (lang, source)),
        prices as materialized (
            select lang, source, term, coalesce(held.n, 0)::hugeint as n,
                1 + (1000000000::hugeint * (coalesce(held.n, 0) + 1)) // (groups.total + langs.terms) as p,
                1 + (1000000000::hugeint * (vocabulary.n + 1)) // (langs.total + langs.terms) as q
            from groups join langs using (lang) join vocabulary using (lang) left join held using (lang, source, term)),
        gaps as (
            select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
            from prices a join prices b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        parts as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
            from groups a join groups b on a.lang = b.lang and a.source <> b.source
                left join gaps on gaps.lang = a.lang and gaps.source = a.source and gaps.item = b.source
            union all
            select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from prices where n > 0 and p > q),
        ranks as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank from parts)
        select lang, source, part, item, value, rank from ranks where part = 'pair' or rank <= 200""",
}
