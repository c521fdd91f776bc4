"""The queries over the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, embeddup, fingerprint, langid, linededup, neardup, packing, quality, tokenfile, toxicity
from .common import fold, scratch, table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces with their places.  A null text is empty and gives the end id alone; repeated rows give their pieces again; rows without a doc_id keep it null."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048, end_id=0)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's language, learned from the rows that are not held out.  A null text or one without a letter is und; a row without a doc_id is neither learned from nor held out; repeated rows stay."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold(4) != 2))
    return langid.predict(docs, model).select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's component of near-duplicates.  Null and empty texts link with nothing; rows of one doc_id are one document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's toxicity, learned from labelled rows that are not held out.  Null and empty texts get the score of a text without a match; a row without a doc_id is neither learned from nor held out; repeated rows stay."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's links and component.  Vectors that are null, zero or not finite link with nothing; rows of one vec_id are one vector."""
    return embeddup.embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token files of all documents, written and read back.  A null text is empty; rows without a doc_id come first; repeated rows stay, in the order of their texts' hashes."""
    path = scratch(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=2)
    return tokenfile.read_tokens(spark, path, with_ids=False)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's quality, learned from labelled rows that are not held out.  Null and empty texts get the score of a text without words; a row without a doc_id is neither learned from nor held out; repeated rows stay."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    return quality.score(docs, model).select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's lines and what is left of them.  A null or empty text is one empty line; a row without a doc_id isn't counted but loses lines; repeated rows count as one document."""
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's byte-level ids and the bytes that they decode to.  A null or empty text has no ids; repeated rows stay."""
    import public_tokenizers

    path, pattern = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bytebpe.decode_ids(bytebpe.encode_documents(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how near they and the next row's are.  A null text is empty; rows of one doc_id follow each other by their texts' hashes; rows without a doc_id come last."""
    found = fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))
    near = lambda other: fingerprint.resemblance(F.col("sketch"), F.col(other))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), fingerprint.as_text(F.col("sketch")).alias("fingerprint"), fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), near("edited_sketch").alias("near_edited"), near("next_sketch").alias("near_next")
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over the whole documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pack, op2_language, op3_near_duplicates, op4_toxicity, op5_embedding_duplicates, op6_token_files, op7_quality, op8_line_dedup, op9_byte_bpe, op10_fingerprints, pipeline)
}
