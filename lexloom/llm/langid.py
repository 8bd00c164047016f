"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become sequences of code points: lower case, everything that is no letter one space.  Training
rows are counted on the executors into (language, bucket) sums; the log-probability matrix, of at most
MATRIX entries, is broadcast.  A batch of texts becomes one sparse matrix of counts
(text, bucket, count), whose product with the log-probability matrix gives all scores at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import SHARES, bounded_batches, row_hash, session_of, share_limit

#: Hash buckets, and the most that all languages together have: with more than 512 languages buckets become fewer.
DIMS = 1 << 14
MATRIX = 1 << 23
SIZES = (2, 3, 4)
#: Texts of each language that are counted, at most about so many, chosen by hash; equal rows count once.
TRAIN_TEXTS = 4000
#: Texts of one sparse matrix; code points handled together; entries of a product held at once.
ROWS = 64
PIECE = 1 << 19
PRODUCT = 1 << 20
UNKNOWN = "und"


def buckets_for(languages: int) -> int:
    """A power of two, as many as MATRIX has room for, DIMS at most."""
    return min(DIMS, 1 << max(0, (MATRIX // max(languages, 1)).bit_length() - 1))


@cache
def letter_table() -> np.ndarray:
    """Whether a code point is a letter (Unicode categories L*)."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def points(text: str) -> np.ndarray:
    """Code points of the lowered text, other characters as spaces."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(letter_table()[codes], codes, np.uint32(32))


def has_letter(codes: np.ndarray) -> bool:
    return bool((codes != 32).any())


def framed(codes: np.ndarray) -> np.ndarray:
    """Runs of spaces as one, a space at either end."""
    codes = np.r_[np.uint32(32), codes, np.uint32(32)]
    return codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]


def gram_counts(texts: list[np.ndarray], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse counts (row, bucket, count), by row and bucket, of all n-grams of the framed ``texts``."""
    codes = np.concatenate(texts).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    total = np.zeros(len(texts) * dims, np.int64)
    for n in SIZES:
        for lo in range(0, len(codes) - n + 1, PIECE):
            part, owner = codes[lo : lo + PIECE + n - 1], row[lo : lo + PIECE + n - 1]
            size = len(part) - n + 1
            h = np.full(size, n, np.uint64)
            for i in range(n):
                h = h * np.uint64(1_114_112) + part[i : i + size]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            bucket = (h >> np.uint64(40)).astype(np.int64) & (dims - 1)
            own = owner[:size] == owner[n - 1 :]
            total += np.bincount(owner[:size][own] * dims + bucket[own], minlength=len(total))
    at = np.flatnonzero(total)
    return at // dims, at % dims, total[at]


def stretches(sizes: list[int]) -> Iterator[slice]:
    """Neighbouring texts of up to ROWS and about PIECE code points together."""
    begin = held = 0
    for k, n in enumerate(sizes):
        if k > begin and (k - begin == ROWS or held + n > PIECE):
            yield slice(begin, k)
            begin, held = k, 0
        held += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    #: (buckets, languages)
    log_prob: np.ndarray

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): the sparse counts of framed ``texts`` times the log probabilities, and the priors."""
        row, bucket, count = gram_counts(texts, len(self.log_prob))
        out = np.tile(self.log_prior, (len(texts), 1))
        step = max(1, PRODUCT // len(self.languages))
        for at in range(0, len(row), step):
            r = row[at : at + step]
            starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            out[r[starts]] += np.add.reduceat(self.log_prob[bucket[at : at + step]] * count[at : at + step, None].astype(np.float64), starts, axis=0)
        return out

    def predict_all(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The best language of each text and its posterior; ties go to the first by name."""
        names, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, score
        codes = [points(t) if t else None for t in texts]
        known = [k for k, c in enumerate(codes) if c is not None and has_letter(c)]
        for part in stretches([len(codes[k]) for k in known]):
            own = known[part]
            s = self.scores([framed(codes[k]) for k in own])
            best = np.argmax(s, 1)
            sure = 1 / np.exp(s - s[np.arange(len(s)), best][:, None]).sum(1)
            for k, b, p in zip(own, best.tolist(), sure.tolist(), strict=True):
                names[k], score[k] = self.languages[b], p
        return names, score


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """The model of ``df``'s rows with a text and a language.

    About TRAIN_TEXTS texts of each language are counted, chosen by the hash of the whole row, equal rows
    once; priors use all rows.  The driver holds a count for each language and the matrix.  No rows: a
    model without languages.
    """
    bounded_batches(session_of(df))
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), row_hash(df).alias("_s")).where("text is not null and lang is not null")
    held = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(held)
    dims = buckets_for(len(languages))
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((dims, 0), np.float32))
    limit = F.create_map(*[F.lit(x) for name, n in held.items() for x in (name, share_limit(n, TRAIN_TEXTS))])
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(place) * dims, np.int64)
        for batch in batches:
            texts, langs = (batch.column(i).to_pylist() for i in range(2))
            for part in stretches([len(t) for t in texts]):
                row, bucket, n = gram_counts([framed(points(t)) for t in texts[part]], dims)
                own = np.array([place[x] for x in langs[part]], np.int64)
                np.add.at(sums, own[row] * dims + bucket, n)
        at = np.flatnonzero(sums)
        for lo in range(0, len(at), 1 << 18):
            some = at[lo : lo + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array((some // dims).astype(np.int32)), pa.array((some % dims).astype(np.int32)), pa.array(sums[some])], names=["k", "bucket", "n"])

    sample = rows.where(F.pmod(F.col("_s"), F.lit(SHARES)) < limit[F.col("lang")]).dropDuplicates(["lang", "_s"]).select("text", "lang")
    counted = sample.mapInArrow(count, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n"))
    sums = np.ones((len(languages), dims))
    table = counted.toArrow()
    sums[table["k"].to_numpy(), table["bucket"].to_numpy()] += table["n"].to_numpy()
    prior = np.array([held[x] for x in languages], float)
    return LanguageModel(languages, np.log(prior / prior.sum()), np.ascontiguousarray(np.log(sums / sums.sum(1, keepdims=True)).T.astype(np.float32)))


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``df`` with ``out_col``, struct(lang, score): ``und`` and 0 for a text that is null or has no letter.

    Empty tables stay empty, repeated rows get equal results, an existing ``out_col`` is replaced.  No shuffle.
    """
    spark = session_of(df)
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            names, score = shared.value.predict_all(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    return df.withColumn(out_col, predict(F.col(text_col)))
