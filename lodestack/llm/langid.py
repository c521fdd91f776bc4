"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters becomes a blank; n-grams of one
to three characters that hold a letter are hashed into a fixed number of
buckets.  The matrix of log-probabilities (buckets by languages) goes to every
worker; all languages are learned, and with very many of them there are fewer
buckets, so that the matrix never exceeds MATRIX_NUMBERS.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import docs_of, text_parts
from .sampling import bound, within

BUCKETS = 1 << 16
#: Rows of each language that the model is fitted on, about; a language with fewer gives all.
SAMPLE_ROWS = 4000
#: Numbers of four bytes in the matrix at most: a thousand languages have all buckets.
MATRIX_NUMBERS = 1 << 26
_KIND: list[np.ndarray] = []


def _is_letter(code: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter, as str.isalpha has it."""
    if not _KIND:
        _KIND.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    out = _KIND[0][np.minimum(code, 0xFFFF)]
    high = np.flatnonzero(code > 0xFFFF)
    if len(high):
        some, place = np.unique(code[high], return_inverse=True)
        out[high] = np.array([chr(i).isalpha() for i in some.tolist()])[place]
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with all but letters as blanks, a blank before and after each text and two after the last; each text's first place."""
    joined = "  ".join(["", *texts, "", ""])[1:]
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    code[~_is_letter(code)] = 32
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    return code, np.cumsum(sizes) - sizes


def grams(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: the bucket of the n-gram that starts at each place, the number of buckets if it holds no letter; each text's first place."""
    lowered = [(t or "").lower() for t in texts]
    code, first = _codes(lowered)
    size = len(code) - 3
    last = np.append(first[1:], size) - 1  # what starts at the blank after a text would reach into the next
    letter = code != 32
    h, any_letter = np.zeros(size, np.uint32), np.zeros(size, bool)
    for n in range(3):
        h = (h ^ code[n : n + size]) * np.uint32(0x01000193) + np.uint32(0x9E3779B1)
        any_letter |= letter[n : n + size]
        if n:
            bucket = ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(16)).astype(np.int32)
        else:
            bucket = ((h * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.int32)
        bucket = np.where(any_letter, bucket % buckets, buckets)
        bucket[last] = buckets
        yield bucket, first


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # buckets + 1 by languages, in single precision; the last row, for n-grams without a letter, is 0
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its probability; ``und`` and 0 for texts without a letter."""
        total = np.tile(self.prior, (len(texts), 1))
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        for bucket, first in grams(texts, len(self.log_prob) - 1):
            if len(bucket):
                total += np.add.reduceat(self.log_prob[bucket], first, axis=0, dtype=np.float64)
        ok = np.array([any(map(str.isalpha, t or "")) for t in texts])
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if k else "und" for b, k in zip(best, ok, strict=True)], np.where(ok, score, 0.0)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, numbers: int = MATRIX_NUMBERS) -> LanguageModel:
    """Learns every language of ``rows`` (doc_id, text, lang).

    Rows with a null lang or text are left out.  Of each language about
    ``sample_rows`` rows are taken, by a hash of doc_id; the matrix has at most
    ``numbers`` numbers.
    """
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a number for each language
    names = sorted(per)
    number = {x: i for i, x in enumerate(names)}
    buckets = max(1, min(BUCKETS, numbers // max(1, len(names))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for part, texts in text_parts(batches):
            which = np.array([number[x] for x in part.column(1).to_pylist()])
            for bucket, first in grams(texts, buckets):
                of = np.repeat(which, np.diff(np.append(first, len(bucket))))
                for k in np.unique(which).tolist():
                    each = np.bincount(bucket[of == k], minlength=buckets + 1)
                    found[k] = found[k] + each if k in found else each
        for k, each in found.items():
            some = np.flatnonzero(each[:-1])
            yield pa.record_batch([pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)), pa.array(each[some].astype(np.int64))], ["k", "bucket", "n"])

    total = np.zeros((buckets, len(names)), np.float32)
    if names:
        most = F.element_at(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.lit(bound(min(1.0, sample_rows / per[x]))).cast("long") for x in names))), F.col("lang"))
        counted = rows.where(within("doc_id", most)).select("text", "lang").mapInArrow(count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow()
        total[counted["bucket"].to_numpy(), counted["k"].to_numpy()] = counted["n"].to_numpy()  # as many numbers as the matrix at most
    total += 0.5
    log_prob = np.zeros((buckets + 1, len(names)), np.float32)
    log_prob[:-1] = np.log(total) - np.log(total.sum(axis=0, dtype=np.float64))
    counts = np.array([per[x] for x in names], float)
    return LanguageModel(names, log_prob, np.log(counts / counts.sum()) if names else np.zeros(0))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    A null text and one without a letter give ``und`` and 0; so does every text
    if the model has learned no language.  Equal scores: the first language by
    name.  Repeated rows stay; other columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MATRIX_NUMBERS numbers at most
    part_bytes = (1 << 22) // max(4, len(model.languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches, part_bytes):
            lang, score = sent.value.predict(texts)
            yield pa.record_batch([part.column(0), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
