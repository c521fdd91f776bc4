"""A corpus made ready for training: quality, toxicity, line dedup, near-dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import linededup, neardup, packing, quality, toxicity
from lodestack.llm.common import fold, folded, release, stored, table, unfolded, with_scores
from lodestack.llm.queries import vocabulary


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of quality 1 is at least 0.3.

    Null and empty texts are scored as texts without words; repeated rows stay or
    go together; a row without a doc_id is scored but not learned from.
    """
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    return unfolded(with_scores(folded(docs), model.score).where("score >= 0.3"), docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of toxic 1 is below 0.5.

    Null and empty texts are scored as texts without a match; repeated rows stay
    or go together; a row without a doc_id is scored but not learned from.
    """
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    return unfolded(with_scores(folded(docs), model.score).where("score < 0.5"), docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; n_chars follows the text, and a null text becomes empty.

    A line stays in the largest doc_id that holds it; a row without a doc_id
    isn't counted but loses lines; repeated rows count as one document.
    """
    out = linededup.dedup_lines(folded(docs), carry=("rest",)).withColumnRenamed("kept_text", "text")
    return unfolded(out, docs.columns, n_chars=F.char_length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id, and one row of it.

    Of rows that share a doc_id the one with the smallest hash of its text stays.
    Of rows without a doc_id one of each text stays.  Null and empty texts are no
    duplicates of others.
    """
    rows = folded(docs)
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    several = stored(rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "repeated-ids")
    out = rows.join(kept, "doc_id", "left_semi")
    if not several.isEmpty():
        one = F.min_by(F.struct("text", "rest"), F.struct(F.xxhash64("text"), F.col("text"))).alias("row")
        repeated = out.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(one).select("doc_id", "row.*")
        nameless = rows.where("doc_id IS NULL").groupBy("doc_id", F.sha2("text", 256).alias("digest")).agg(one).select("doc_id", "row.*")
        out = out.join(several, "doc_id", "left_anti").unionByName(repeated).unionByName(nameless)
    else:
        release(several)
    return unfolded(out, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens.

    A null or empty text gives one piece, the end id; repeated rows give their
    pieces again; a null doc_id stays null.
    """
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), limit=2048, end_id=0)


STAGES = [("quality", drop_low_quality), ("toxicity", drop_toxic), ("line_dedup", drop_common_lines), ("near_dedup", drop_near_duplicates), ("packing", pack)]

#: Learned classifiers and a tokenizer can't be expressed in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another, each one's rows written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, before = stored(stage(spark, docs, sf_dir), f"stage-{name}"), docs
        release(before)
    return docs
