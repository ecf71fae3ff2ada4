"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareline.llm.common import read_table
from fareline.llm.divergence import audit_sources
from fareline.llm.embedding_dedup import link_vectors
from fareline.llm.language import fit_languages, held_out, identify
from fareline.llm.licenses import scan_licenses
from fareline.llm.packing import pack_documents
from fareline.llm.pieces import encode_digest
from fareline.llm.pii import disclosing_spans, span_digest
from fareline.llm.runs import periodic_runs, run_digest, with_planted_periods
from fareline.llm.secrets import scan_secrets, secret_digest
from fareline.llm.sharding import shard_rows
from fareline.llm.simhash import group_near_copies
from fareline.llm.topk import top_products
from fareline.llm.toxicity import fit_toxicity, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _tokenizer(name: str) -> str:
    return importlib.import_module("public_tokenizers").path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.93."""
    return link_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms of every document."""
    return span_digest(disclosing_spans(read_table(spark, sf_dir, "documents")))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best scores of every twentieth vector against all others."""
    return top_products(read_table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and its round trip, as digests."""
    return encode_digest(read_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit_languages(docs))
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", found["lang_score"].alias("score"), "lang_accepted"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, category by category."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs.select("doc_id", "text"), model).drop("text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 4096 tokens."""
    return pack_documents(read_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies of every document."""
    return group_near_copies(read_table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    return shard_rows(read_table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document, the notices with their words and edits."""
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, one text in ten with a planted period."""
    return run_digest(periodic_runs(with_planted_periods(read_table(spark, sf_dir, "documents"))))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and the words that set each apart."""
    return audit_sources(read_table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: known forms and random strings."""
    return secret_digest(scan_secrets(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_dedup,
        op2_pii,
        op3_topk,
        op4_sentencepiece,
        op5_language,
        op6_toxicity,
        op7_packing,
        op8_simhash,
        op9_sharding,
        op10_licenses,
        op11_runs,
        op12_divergence,
        op13_secrets,
    )
}

#: The other queries train a model, hash with XXH64, tokenize, match with edits or search for
#: a packing, which SQL doesn't express; tests hold them against brute force instead.
ORACLE: dict[str, str] = {
    "op1_embedding_dedup": """
        with recursive usable as (
            select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
            where label is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as (
            select a.vec_id as a, b.vec_id as b from usable a join usable b
                on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
            where list_cosine_similarity(a.e, b.e) >= 0.93),
        reach as (
            select vec_id as node, vec_id as root from embeddings
            union select links.b, reach.root from reach join links on links.a = reach.node),
        roots as (select node, min(root) as root from reach group by 1),
        counts as (select a, count(*) as n from links group by 1)
        select vec_id, coalesce(n, 0) as n_links, root as component_id, vec_id = root as kept
        from embeddings join roots on node = vec_id left join counts on a = vec_id""",
    "op3_topk": """
        with usable as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as e from embeddings
            where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scores as (
            select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
            from usable q join usable c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0)
        select query_id, vec_id, score,
            cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank
        from scores qualify rank <= 20""",
    "op12_divergence": r"""
        with docs as (
            select row_number() over () as id, coalesce(text, '') as text, coalesce(lang, '') as lang,
                coalesce(source, '') as source from documents),
        words as (
            select id, lang, source, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
        groups as (select distinct lang, source from docs),
        kept as (select lang, term, count(*) as c from words group by all having count(distinct id) >= 3),
        langs as (select lang, count(*) as v, sum(c) as n from kept group by all),
        counts as (select lang, source, term, count(*) as c from words semi join kept using (lang, term) group by all),
        totals as (select lang, source, sum(c) as n from counts group by all),
        shares as (
            select lang, source, term, coalesce(counts.c, 0) as c,
                1 + (1000000000::hugeint * (coalesce(counts.c, 0) + 1)) // (coalesce(totals.n, 0) + langs.v) as p,
                1 + (1000000000::hugeint * (kept.c + 1)) // (langs.n + langs.v) as q
            from groups join kept using (lang) join langs using (lang)
                left join totals using (lang, source) left join counts using (lang, source, term)),
        sums as (
            select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        found as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
            from groups a join groups b on a.lang = b.lang and a.source <> b.source
                left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source
            union all
            select lang, source, 'term', term, (p - q) * (p - q) // q from shares where c > 0 and p > q)
        select lang, source, part, item, cast(value as bigint) as value,
            cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
        from found qualify part = 'pair' or rank <= 200""",
}
