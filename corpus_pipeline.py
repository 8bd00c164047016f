"""Documents to training ids: quality, language, near duplicates, mixture, encoding.

Columns of any name pass through the first four stages.  Every stage takes all that its predecessor kept, as written and read back.  The first four drop rows
of ``documents`` and keep its columns; the last encodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import langid, quality, queries, sentencepiece_codec, verified
from lexloom.llm.runtime import row_hash, row_key, staged_alone

#: Languages that training wants; others, and texts without letters, are rejected.
LANGUAGES = ("en", "de", "fr", "es")
#: Two documents link if eight tenths of the five-word shingles of both are common; README has the measured figures.
WORDS, SIMILARITY_TENTHS = 5, 8
#: Tenths of the remaining tokens that the mixture takes, each document once.
KEPT_TENTHS = 9


def own_name(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``docs`` has it."""
    while name in docs.columns:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose score is below the threshold, null and blank texts among them.

    Equal texts are kept or rejected together; an empty table stays empty.
    """
    score = own_name(docs, "quality_score")
    scored = quality.classify(docs, quality.fit(docs), out_col=score)
    return scored.where(F.col(score) >= queries.QUALITY_THRESHOLD).select(docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose predicted language is not wanted; learns from the rows' own labels.

    Null texts and texts without letters are rejected, whatever their label; an empty table stays empty.
    """
    language = own_name(docs, "language")
    found = langid.identify(docs, langid.train(docs), out_col=language)
    return found.where(F.col(f"{language}.lang").isin(*LANGUAGES)).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates.

    A null id comes after all others, and among rows of one id the smallest row key decides: every group
    keeps one row, whatever its ids.  Null and empty texts are one group; an empty table stays empty.
    """
    row = own_name(docs, "row")
    found = verified.components(docs, WORDS, SIMILARITY_TENTHS).withColumnRenamed("row", row)
    keyed = docs.withColumn(row, row_key(docs))
    ids = found.join(keyed.select(row, "doc_id").distinct(), row)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    firsts = ids.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first")[row].alias(row))
    return keyed.join(firsts, row, "left_semi").dropDuplicates([row]).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the target weights take, whole; rows count one by one, whatever their ids.

    Documents without words, null and empty texts among them, have no tokens to take and go; an empty
    table stays empty.
    """
    row = own_name(docs, "row")
    keyed = docs.withColumn(row, row_hash(docs))
    taken = queries.mixed(keyed, 1, KEPT_TENTHS, row).select(row)
    return keyed.join(taken, row, "left_semi").select(docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_ids) of each document left; null and empty texts have no ids."""
    ids = own_name(docs, "ids")
    coded = sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), out_col=ids)
    return coded.select("doc_id", "lang", "source", F.col(ids).alias("ids"), F.size(ids).cast("long").alias("n_ids"))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]

#: Classifiers, fingerprints and encoding are not SQL.  Tests hold every stage against plain code: quality and language row by
#: row against the operators' own functions and those against definitions, near duplicates against exact similarity, mixing
#: against water-filling child by child, encoding against the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
