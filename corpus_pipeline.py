"""Corpus preparation: five stages over ``documents``, each written and read again.

Rejected documents go, later copies of long passages go, one document of each group of
near copies stays, sources are mixed to their weights, and what is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.llm.common import staged, table
from lookback.llm.linedup import dedup_lines
from lookback.llm.mixing import mix
from lookback.llm.pieces import Vocabulary, count_pieces, encoded
from lookback.llm.quality import judge, train
from lookback.llm.registry import MIX_WEIGHTS, mix_levels, piece_model_path
from lookback.llm.simhash import one_of_each

#: Share of all words that the mix may spend, each document at most once.
MIX_SHARE = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their site's evidence accept; others go.

    A text without words is rejected. Labels may be empty or null: then only texts
    without words go.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    judged = judge(docs, model, host=F.col("source"), path=F.col("lang"))
    return judged.where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 50 words or more, ``n_chars`` adjusted.

    A document of which nothing remains goes, since an earlier one has all its lines.
    Documents without deletions stay as they are, null texts included.
    """
    cleaned = dedup_lines(docs, min_words=50)
    cleaned = cleaned.where((F.col("lb_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    length = F.when(F.col("lb_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Documents with null ids stay; of rows of a group that repeat its smallest id one stays.
    """
    return one_of_each(docs, shingle=3, radius=3).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words meet the budgets of domain, language and source."""
    mixed = mix(docs, levels=mix_levels(), weights=MIX_WEIGHTS, share=MIX_SHARE, max_epochs=1)
    return mixed.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text with their score and the next best segmentations.

    Scores are log probabilities that the pieces' counts in these documents give them.
    """
    vocab = Vocabulary.load(piece_model_path())
    vocab = vocab.weighted(count_pieces(vocab, docs.select("text")))
    coded = docs.withColumn("lb_e", encoded(vocab, F.col("text")))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.col("lb_e.ids").alias("ids"),
        F.coalesce(F.array_size("lb_e.ids").cast("long"), F.lit(0)).alias("n_pieces"),
        F.col("lb_e.score").alias("score"),
        F.col("lb_e.alternatives").alias("alternatives"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("source mixing", source_mix),
    ("sentencepiece encoding", encode),
]

#: The classifier is trained and the fingerprints use XXH64: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
