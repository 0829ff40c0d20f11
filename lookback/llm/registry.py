"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.llm.alignment import TokenizerPair, alignment_table
from lookback.llm.common import table
from lookback.llm.html import main_text
from lookback.llm.linedup import dedup_lines
from lookback.llm.mixing import mix
from lookback.llm.multiindex import similar_groups
from lookback.llm.ngram import quality_rules
from lookback.llm.pieces import Vocabulary, count_pieces, encoded
from lookback.llm.private import private_spans, train as train_tagger
from lookback.llm.quality import judge, train
from lookback.llm.recurrent import score_documents
from lookback.llm.simhash import simhash_groups
from lookback.llm.warc import archived_pages
from lookback.llm.whitening import whitened

#: Production weights of the mix; values not named weigh 1.
MIX_WEIGHTS = {"domain": {"d1": 2.0, "d2": 3.0}, "lang": {"en": 4.0, "de": 2.0}}


def mix_levels() -> dict[str, Column]:
    """Domain (numbered sources fall into four, others have none), language, source."""
    number = F.regexp_extract("source", r"(\d+)$", 1).try_cast("decimal(38,0)")
    domain = F.concat(F.lit("d"), F.pmod(number, F.lit(4).cast("decimal(38,0)")).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents"), min_words=50)
    return cleaned.select(
        "doc_id",
        "text",
        F.col("lb_lines").alias("n_lines"),
        F.col("lb_deleted").alias("n_deleted"),
    )


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, levels=mix_levels(), weights=MIX_WEIGHTS, share=0.6, max_epochs=4)
    return mixed.select(
        "doc_id",
        F.col("lb_domain").alias("domain"),
        "lang",
        "source",
        F.col("lb_tokens").alias("tokens"),
        F.col("lb_epochs").alias("epochs"),
    )


def piece_model_path() -> str:
    """Place of the public piece vocabulary; ``LOOKBACK_PIECE_MODEL`` overrides it."""
    return os.environ.get("LOOKBACK_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op7_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab = Vocabulary.load(piece_model_path())
    vocab = vocab.weighted(count_pieces(vocab, docs.select("text")))
    coded = docs.withColumn("e", encoded(vocab, F.col("text"), n_best=4, verify=True))
    return coded.select(
        "doc_id",
        F.col("e.ids").alias("ids"),
        F.coalesce(F.array_size("e.ids").cast("long"), F.lit(0)).alias("n_pieces"),
        F.col("e.score").alias("score"),
        F.col("e.alternatives").alias("alternatives"),
        F.col("e.round_trip").alias("round_trip"),
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    judged = judge(docs, model, host=F.col("source"), path=F.col("lang"), keep_text=False)
    return judged.select("doc_id", "doc_score", "site_score", "quality", "kept")


def op9_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op10_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def byte_model_path() -> str:
    """Place of the public byte-level vocabulary; ``LOOKBACK_BYTE_MODEL`` overrides it."""
    return os.environ.get("LOOKBACK_BYTE_MODEL", "/opt/tokenizers/byte_bpe_50k.json")


def op11_aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = TokenizerPair.load(byte_model_path(), piece_model_path())
    return alignment_table(table(spark, sf_dir, "documents"), pair)


def op12_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), wanted=32)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = private_spans(docs, train_tagger(docs.select("text")))
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans")


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_embedding_groups": op2_embedding_groups,
    "op3_main_text": op3_main_text,
    "op4_simhash_groups": op4_simhash_groups,
    "op5_line_dedup": op5_line_dedup,
    "op6_source_mix": op6_source_mix,
    "op7_nbest_pieces": op7_nbest_pieces,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_warc_captures": op9_warc_captures,
    "op10_recurrent_scores": op10_recurrent_scores,
    "op11_aligned_tokens": op11_aligned_tokens,
    "op12_whitened_embeddings": op12_whitened_embeddings,
    "op13_personal_data": op13_personal_data,
}

def _level_sql(n: int, path: str, above: str, weight: str) -> str:
    """One level of the budget tree: children fill up in the order of capacity per weight."""
    group = f"PARTITION BY {above}" if above else ""
    parent = f"JOIN g{n - 1} ON (n.{above.replace(', ', ', n.')}) IS NOT DISTINCT FROM (g{n - 1}.{above.replace(', ', f', g{n - 1}.')})"
    return f"""
        n{n} AS (
            SELECT {path}, sum(tokens * 4)::DOUBLE AS cap, {weight} AS w FROM leaf GROUP BY {path}
        ), b{n} AS (
            SELECT n.*, {f"g{n - 1}.given" if above else "0.6 * (SELECT sum(tokens) FROM leaf)"} AS b
            FROM n{n} n {parent if above else ""}
        ), l{n} AS (
            SELECT *, b - coalesce(sum(cap) OVER before, 0) AS rest,
                   sum(w) OVER ({group}) - coalesce(sum(w) OVER before, 0) AS free
            FROM b{n}
            WINDOW before AS ({group} ORDER BY cap / w, {path.split(", ")[-1]}
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), g{n} AS (
            SELECT {path}, cap, coalesce(least(cap, w * max(CASE WHEN cap * free > w * rest
                   THEN rest / free END) OVER ({group})), cap) AS given
            FROM l{n}
        )"""


ORACLES: dict[str, str] = {
    "op6_source_mix": f"""
        WITH d AS (
            SELECT doc_id, lang, source, coalesce(doc_id::VARCHAR, '') AS key,
                   'd' || (try_cast(regexp_extract(source, '(\\d+)$', 1) AS DECIMAL(38, 0)) % 4)::INT AS domain,
                   len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                                   lambda x: x <> '')) AS tokens
            FROM documents
        ), leaf AS (
            SELECT domain, lang, source, sum(tokens) AS tokens FROM d GROUP BY ALL
        ), {_level_sql(1, "domain", "", "CASE domain WHEN 'd1' THEN 2.0 WHEN 'd2' THEN 3.0 ELSE 1.0 END::DOUBLE")},
        {_level_sql(2, "domain, lang", "domain", "CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 ELSE 1.0 END::DOUBLE")},
        {_level_sql(3, "domain, lang, source", "domain, lang", "1::DOUBLE")},
        p AS (
            SELECT d.*, floor(g3.given)::BIGINT AS budget, leaf.tokens AS leaf_tokens,
                   CASE WHEN leaf.tokens > 0 THEN floor(g3.given)::BIGINT // leaf.tokens ELSE 4 END AS e
            FROM d
            JOIN leaf ON d.domain IS NOT DISTINCT FROM leaf.domain
                AND d.lang IS NOT DISTINCT FROM leaf.lang AND d.source IS NOT DISTINCT FROM leaf.source
            JOIN g3 ON d.domain IS NOT DISTINCT FROM g3.domain
                AND d.lang IS NOT DISTINCT FROM g3.lang AND d.source IS NOT DISTINCT FROM g3.source
        ), o AS (
            SELECT *, sum(tokens) OVER (
                PARTITION BY domain, lang, source
                ORDER BY ('0x' || md5('42:' || e || ':' || key)[1:15])::BIGINT, key
            ) AS upto FROM p
        )
        SELECT doc_id, domain, lang, source, tokens,
               (e + CASE WHEN budget - e * leaf_tokens > 0 AND upto <= budget - e * leaf_tokens
                    THEN 1 ELSE 0 END)::INT AS epochs
        FROM o WHERE epochs > 0
    """,
    "op9_warc_captures": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
        ), w AS (
            SELECT *, min(page_id) OVER (PARTITION BY html) AS first,
                   row_number() OVER (PARTITION BY html ORDER BY page_id) AS n
            FROM p
        )
        SELECT page_id, strlen(html) AS payload_bytes,
               translate(
                   list_aggregate([to_base(('0x' || hex[1 + 5 * i : 5 + 5 * i])::BIGINT, 32, 4)
                                   FOR i IN range(8)], 'string_agg', ''),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
               ) AS payload_digest,
               CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN n > 1 THEN first END AS refers_to
        FROM w
    """,
}
