"""Quality classifier from weak labels.

Overlapping heuristic labellers each vote good, bad or nothing on a text.  Votes of all texts are
counted by pattern (at most 3 to the number of labellers); expectation-maximisation over those counts
estimates how accurate each labeller is and the share of good texts.  The posteriors
of a bounded sample of texts then train a linear scorer on hashed n-grams of character classes,
and the scorer alone decides about every text.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.ngrams import grams
from lexloom.llm.runtime import bounded_batches, hash_share, row_hash, session_of

GOOD, BAD, NONE = "g", "b", "-"
DIMS = 1 << 11
SIZES = (1, 2, 3, 4)
#: Texts that the scorer is fitted on, at most about so many, chosen by hash.
TRAIN_TEXTS = 4000
EM_ROUNDS = 100
PRESUMED_GRAMS = 200
PRESUMED_WORDS = 10
#: Shortest text, in words, on which labellers of shares vote.
FEW_WORDS = 6
LABELLERS = ("symbols", "capitals", "shouting", "cells", "repeats", "word_length", "marks_on_words", "sentences", "stutter")


def votes(text: str) -> str:
    """A letter for each of LABELLERS: good, bad or no vote.

    Each looks at a different trait of prose: share of characters that are neither letters, digits nor
    common punctuation; of capitals among letters; exclamation marks for each word; words that are one
    sign, as cells of a table are; distinct words; mean word length; words that end in two or more signs;
    sentence ends for each word; words that repeat the one before.  Only symbols, word_length and
    sentences ever speak for a text: a text that lacks one kind of junk is not good for that.
    """
    data = text.encode()
    words = data.split()
    n = len(words)
    if n < FEW_WORDS:
        return NONE * len(LABELLERS)
    codes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = codes[65:91].sum(), codes[97:123].sum()
    letters = upper + lower + codes[128:].sum()
    plain = letters + codes[48:58].sum() + codes[[9, 10, 13, 32, 33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    total = max(len(data), 1)
    signs = sum(1 for w in words if len(w) == 1 and not w.isalnum() and w < b"\x80")
    marked = sum(1 for w in words if len(w) > 2 and w[-1] in b"*%&#$!|~^=+" and w[-2] in b"*%&#$!|~^=+")

    def two_sided(bad: bool, good: bool) -> str:
        return BAD if bad else GOOD if good else NONE

    odd, caps, shouts = 1 - plain / total, upper / max(letters, 1), codes[33] / n
    ends = (codes[46] + codes[63] + codes[33]) / n
    mean = (total - n) / n
    distinct, stutter = relations(words)
    return "".join((
        two_sided(odd > 0.08, odd < 0.02),
        two_sided(caps > 0.4, False),
        two_sided(shouts > 0.2, False),
        two_sided(signs / n > 0.1, False),
        two_sided(distinct < 0.1 * min(1.0, (300 / n) ** 0.5), False),
        two_sided(mean > 15 or mean < 2, 3 <= mean <= 10),
        two_sided(marked / n > 0.1, False),
        two_sided(ends > 0.9 and n >= 20, 0.01 <= ends <= 0.35),
        two_sided(stutter > 0.2, False),
    ))


def relations(words: list[bytes]) -> tuple[float, float]:
    """Distinct words, and words that repeat the one before, as shares of all."""
    n = max(len(words), 1)
    return len(set(words)) / n, sum(map(operator.eq, words, words[1:])) / n


@dataclass
class WeakLabels:
    """Latent classes: good text first, then a kind of junk for each labeller.

    ``share`` is each class's part of all texts, ``outcome`` (labellers, classes, good/bad/none) what a
    labeller says of it.
    """

    share: np.ndarray
    outcome: np.ndarray

    def classes(self, pattern: str) -> np.ndarray:
        at = [(GOOD + BAD + NONE).index(v) for v in pattern]
        log = np.log(self.share) + np.log(self.outcome[range(len(at)), :, at]).sum(0)
        p = np.exp(log - log.max())
        return p / p.sum()

    def posterior(self, pattern: str) -> float:
        """Probability of a good text."""
        return float(self.classes(pattern)[0])

    def accuracy(self) -> dict[str, float]:
        """How often each labeller is right when it votes."""
        joint = self.outcome * self.share[None, :, None]
        right, said = joint[:, 0, 0] + joint[:, 1:, 1].sum(1), joint[:, :, :2].sum((1, 2))
        return dict(zip(LABELLERS, (right / np.maximum(said, 1e-12)).tolist(), strict=True))


def fit_weak_labels(patterns: dict[str, int]) -> WeakLabels:
    """Expectation-maximisation over counted vote patterns.

    A labeller speaks up on one kind of junk, so most of them call good what one rightly calls bad.
    Two classes would take that for agreement; here junk has a class for each labeller, which starts
    from the texts it calls bad and settles on what the others say of them.  Texts without any bad
    vote start as good, those without any vote are left out.
    """
    k = len(LABELLERS)
    rows = sorted((p, n) for p, n in patterns.items() if set(p) != {NONE})
    usual = np.full((k, k + 1, 3), 0.02)
    usual[:, :, 0] = 0.95
    for j in range(k):
        usual[j, j + 1] = [0.05, 0.9, 0.05]
    usual /= usual.sum(2, keepdims=True)
    if not rows:
        return WeakLabels(np.r_[0.5, np.full(k, 0.5 / k)], usual)
    hot = np.array([[[v == o for o in (GOOD, BAD, NONE)] for v in p] for p, _ in rows], float)
    n = np.array([c for _, c in rows], float)
    bad = hot[:, :, 1]
    some = bad.sum(1, keepdims=True)
    part = np.hstack([np.where(some > 0, 0.05, 0.95), np.where(some > 0, 0.95 * bad / np.maximum(some, 1), 0.05 / k)])
    for _ in range(EM_ROUNDS):
        mass = n @ part
        outcome = np.einsum("rc,rko->kco", part * n[:, None], hot) + usual
        model = WeakLabels((mass + 1) / (mass + 1).sum(), outcome / outcome.sum(2, keepdims=True))
        old, part = part, np.array([model.classes(p) for p, _ in rows])
        if np.abs(old - part).max() < 1e-6:
            break
    return model


#: Character classes: letters by case, digits, white space, other bytes as they are.
_CLASS = np.array([ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else 32 if b in b"\t\n\r\x0b\x0c " else b for b in range(256)], np.uint64)


def features(text: str) -> np.ndarray:
    """Share of each bucket among the text's n-grams, then the two shares of ``relations``."""
    total = np.zeros(DIMS)
    for ids in grams(text.encode(), SIZES, DIMS, _CLASS):
        total += np.bincount(ids, minlength=DIMS)
    return np.r_[total / max(total.sum(), 1), relations(text.encode().split())].astype(np.float32)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    labels: WeakLabels
    #: Mean features of good training texts: what a text is presumed to hold until its own n-grams outweigh it.
    usual: np.ndarray

    def __post_init__(self) -> None:
        self.presumed = float(self.weights[:DIMS] @ self.usual[:DIMS])

    def score(self, text: str | None) -> float:
        """Probability of a good text; null, empty and blank texts get 0.

        Shares are shrunk towards the usual ones by PRESUMED_GRAMS n-grams and PRESUMED_WORDS words, so
        that a few words do not condemn a text.
        """
        if not text or not text.strip():
            return 0.0
        data = text.encode()
        total = count = 0.0
        for ids in grams(data, SIZES, DIMS, _CLASS):
            total += float(self.weights[ids].sum())
            count += len(ids)
        words = data.split()
        own = np.array(relations(words))
        shares = (len(words) * own + PRESUMED_WORDS * self.usual[DIMS:]) / (len(words) + PRESUMED_WORDS)
        margin = self.bias + (total + PRESUMED_GRAMS * self.presumed) / (count + PRESUMED_GRAMS) + self.weights[DIMS:] @ shares
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam over the whole sample, in units of each feature's spread."""
    mean, spread = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-4
    z = (x - mean.astype(np.float32)) / spread.astype(np.float32)  # 4-byte numbers: the sample is the driver's largest array
    w, b = np.zeros(x.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(z @ w.astype(np.float32) + b, -50, 50)))
        g = np.r_[z.T @ (p - y).astype(np.float32) / len(y) + decay * w, (p - y).mean()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w / spread, float(b - (w / spread * mean).sum())


def fit(df: DataFrame, text_col: str = "text") -> Scorer:
    """Labellers over all texts, then the scorer on about TRAIN_TEXTS of them, chosen by the row's hash.

    Equal whole rows count once in the sample, so it stays as small whatever is repeated.  Without any
    votes (an empty table, texts of a few words only) the scorer is neutral: 0.5 for every text with content.
    """
    bounded_batches(session_of(df))
    texts = df.select(F.col(text_col).cast("string").alias("text"), row_hash(df).alias("_s")).where("text is not null")

    @F.arrow_udf("string")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([votes(t) for t in batch.to_pylist()], pa.string())

    patterns = {r["v"]: r["n"] for r in texts.groupBy(vote("text").alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = fit_weak_labels(patterns)
    rows = sum(n for p, n in patterns.items())

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(features(t), v) for t in batch.column(0).to_pylist() if set(v := votes(t)) != {NONE}]
            yield pa.RecordBatch.from_arrays([pa.array([v for _, v in kept], pa.string()), pa.array([x.tobytes() for x, _ in kept], pa.binary())], names=["v", "x"])

    sample = texts.where(hash_share(rows, TRAIN_TEXTS, F.col("_s"))).dropDuplicates(["_s"]).select("text").mapInArrow(examples, "v string, x binary").toArrow()
    y = np.array([labels.posterior(v) for v in sample["v"].to_pylist()])
    if len(y) == 0:
        return Scorer(np.zeros(DIMS + 2), 0.0, labels, np.zeros(DIMS + 2))
    x = np.frombuffer(b"".join(sample["x"].to_pylist()), np.float32).reshape(len(y), DIMS + 2)
    order = np.lexsort((x[:, 0], y))
    weights, bias = fit_linear(x[order], y[order])
    usual = (y @ x) / max(y.sum(), 1e-9)
    return Scorer(weights, bias, labels, usual)


def classify(df: DataFrame, scorer: Scorer, text_col: str = "text", out_col: str = "quality_score") -> DataFrame:
    """``df`` with ``out_col`` (double, 0 to 1); an existing column of that name is replaced.

    Null, empty and blank texts get 0, repeated rows equal scores.  No shuffle.
    """
    spark = session_of(df)
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = shared.value
        for batch in batches:
            yield pa.array([s.score(t) for t in batch.to_pylist()], pa.float64())

    return df.withColumn(out_col, score(F.col(text_col)))
