"""Document quality from weak labels: heuristic labellers, their accuracies by expectation-maximisation, and a scorer.

Labellers vote good, bad or nothing on simple traits of a text. Their votes overlap and nobody says which are right, so
accuracies and the documents' labels are estimated together (Dawid and Skene 1979) from the counts of vote patterns over the
whole corpus. The posterior labels then train a linear scorer over hashed word shapes.
"""

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import fresh, in_share, prepare, whole_text, written

BUCKETS = 512
GOOD, BAD, NONE = 1, 0, 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CLASSES = bytes(
    ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57
    else ord("m") if chr(c) in "#$%&*|~^_=+<>{}[]\\/@" else ord(".") if 32 < c < 127 else 32 for c in range(256))
#: Traits, and for each the thresholds up to which a labeller says good and from which it says bad.
LABELLERS = {
    "marked_words": (0.03, 0.15),
    "shouted_words": (0.15, 0.5),
    "bare_marks": (0.03, 0.12),
    "stutter": (0.05, 0.2),
    "few_kinds": (0.3, 0.5),
    "repeated_runs": (0.1, 0.3),
    "no_stops": (0.5, 0.95),
    "odd_characters": (0.02, 0.06),
}


def _kinds(words: list[bytes], size: int = 5) -> tuple[int, int]:
    """How many different words there are, and different runs of ``size`` of them, in eight bytes a run."""
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)  # the same for equal words of one process
    n = max(0, len(words) - size + 1)
    runs = codes[:n].copy()
    for k in range(1, size):
        runs ^= runs >> np.uint64(29)
        runs *= _ODD
        runs += codes[k:k + n]
    runs.sort()
    return len(set(words)), int(n > 0) + int(np.count_nonzero(runs[1:] != runs[:-1]))


def traits(text: str) -> tuple[list[float], np.ndarray]:
    """Each labeller's trait (larger is worse; NaN if the text is too short to tell) and hashed shares of word shapes."""
    data = text.encode("utf-8", "surrogatepass")
    words, shaped = data.split(), data.replace(b"!!", b"##").translate(_CLASSES)
    shares = np.zeros(BUCKETS, np.float32)
    n = len(words)
    if n == 0:
        return [float("nan")] * len(LABELLERS), shares
    codes = np.frombuffer(shaped, np.uint8)
    kinds = Counter(codes[np.r_[True, codes[1:] != codes[:-1]]].tobytes().split())
    marked = sum(c for k, c in kinds.items() if k.endswith(b"m") and len(k) > 1)
    shouted = sum(c for k, c in kinds.items() if k.startswith(b"A") and b"a" not in k)
    lettered = max(1, sum(c for k, c in kinds.items() if k[:1] in b"aA"))
    stops = sum(c for k, c in kinds.items() if k.endswith(b"."))
    stutter = sum(map(operator.eq, words, words[1:]))
    distinct, grams = _kinds(words)
    enough = n >= 20
    found = [
        marked / n, shouted / lettered, kinds.get(b"m", 0) / n, stutter / n,
        1 - np.log(1 + distinct) / np.log(1 + n) if enough else np.nan,
        1 - grams / (n - 4) if enough else np.nan,
        max(0.0, 1 - 20 * stops / n) if enough else np.nan,
        shaped.count(b"m") / max(1, len(data) - shaped.count(b" ")),
    ]
    for kind, c in kinds.items():
        shares[zlib.crc32(kind) % (BUCKETS - 8)] += c / n
    shares[BUCKETS - 8:] = np.nan_to_num(found)
    return found, shares


def votes(found: list[float]) -> list[int]:
    return [NONE if not v == v else GOOD if v <= good else BAD if v >= bad else NONE
            for v, (good, bad) in zip(found, LABELLERS.values())]


def pattern_of(text: str) -> int:
    """The votes as one number in base three."""
    return sum(v * 3 ** k for k, v in enumerate(votes(traits(text)[0])))


@dataclass
class Accuracies:
    """How often a good (1) and a bad (0) document gets each vote of each labeller, and the share of good ones."""

    log_votes: np.ndarray  # class, labeller, vote; no vote says nothing
    log_prior: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that documents with these patterns are good."""
        given = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
        scores = self.log_prior + np.stack([self.log_votes[c, np.arange(len(LABELLERS)), given].sum(axis=1) for c in (0, 1)], axis=1)
        scores -= scores.max(axis=1, keepdims=True)
        weights = np.exp(scores)
        return weights[:, 1] / weights.sum(axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Accuracies:
    """Expectation-maximisation from the majority vote on; counts of at most 3 to the number of labellers patterns."""
    given = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    # A single vote for bad outweighs several for good at first: each labeller knows one way to be bad.
    good = np.where((given == BAD).any(axis=1), 0.2, 0.9)
    model = None
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        table = np.stack([[[weight[c][given[:, k] == v].sum() + 1.0 for v in (BAD, GOOD)] for k in range(len(LABELLERS))] for c in (0, 1)])
        table = np.log(table / table.sum(axis=2, keepdims=True))
        prior = weight.sum(axis=1) + 1.0
        model = Accuracies(np.concatenate([table, np.zeros_like(table[:, :, :1])], axis=2), np.log(prior / prior.sum()))
        after = model.posterior(patterns)
        moved, good = np.abs(after - good).max(initial=0), after
        if moved < 1e-6:
            break
    return model


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, shares: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(shares @ self.weights + self.bias, -30, 30)))


def train(shares: np.ndarray, good: np.ndarray, steps: int = 300, rate: float = 0.5, ridge: float = 1e-4) -> Scorer:
    """Logistic regression on posterior labels by accelerated gradient steps."""
    scale = 1 / np.maximum(np.sqrt((shares ** 2).mean(axis=0)), 0.02)
    x = shares * scale
    beta, bias, speed, bias_speed = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta + bias, -30, 30)))
        speed = 0.9 * speed - rate * (x.T @ (p - good) / len(x) + ridge * beta)
        bias_speed = 0.9 * bias_speed - rate * float((p - good).mean())
        beta, bias = beta + speed, bias + bias_speed
    return Scorer((beta * scale).astype(np.float64), bias)


def fit(docs: DataFrame, sample: int = 8192, text_column: str = "text") -> tuple[Accuracies, Scorer] | None:
    """Accuracies from all documents, and a scorer trained on about ``sample`` distinct ones; None without documents.

    The sample is picked by a hash of the text, so copies count once and rows need no id.
    """
    prepare(docs.sparkSession)
    texts = docs.select(whole_text(F.col(text_column)).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter(pattern_of(t) for t in batch["text"])
            yield pd.DataFrame({"pattern": list(found), "n": list(found.values())})

    counted = texts.mapInPandas(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    if counted.empty:
        return None
    model = estimate(counted["pattern"].to_numpy(), counted["n"].to_numpy(float))
    share = min(1.0, sample / counted["n"].sum())

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [traits(t) for t in batch["text"]]
            patterns = np.array([sum(v * 3 ** k for k, v in enumerate(votes(found))) for found, _ in rows], np.int64)
            good = model.posterior(patterns) if len(rows) else []
            yield pd.DataFrame({"key": batch["key"], "good": good, "shares": [s.tobytes() for _, s in rows]})

    picked = texts.withColumn("key", F.xxhash64("text")).where(in_share(F.col("key"), share))
    taken = written(picked.mapInPandas(features, "key long, good double, shares binary"), "quality-sample")
    rows = taken.groupBy("key").agg(F.any_value("good").alias("good"), F.any_value("shares").alias("shares")).toPandas()
    if rows.empty:
        return model, Scorer(np.zeros(BUCKETS), 0.0)
    shares = np.stack([np.frombuffer(s, np.float32) for s in rows["shares"]]).astype(np.float64)
    return model, train(shares, rows["good"].to_numpy())


def quality_of(text: Column, model: tuple[Accuracies, Scorer] | None, spark) -> Column:
    """Struct of ``posterior`` (from the labellers' votes) and ``score`` (from the trained scorer)."""
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.DataFrame:
        rows = [traits(t) for t in texts]
        if shared.value is None or not rows:
            return pd.DataFrame({"posterior": np.full(len(rows), 0.5), "score": np.full(len(rows), 0.5)})
        accuracies, scorer = shared.value
        patterns = np.array([sum(v * 3 ** k for k, v in enumerate(votes(found))) for found, _ in rows], np.int64)
        return pd.DataFrame({"posterior": accuracies.posterior(patterns), "score": scorer.score(np.stack([s for _, s in rows]))})

    return F.pandas_udf(score, "posterior double, score double")(whole_text(text))


def scored(docs: DataFrame, model=None, text_column: str = "text") -> DataFrame:
    """Every row with ``posterior``, ``score`` (probabilities of good quality) and ``rejected`` (score under one half).

    The model is fitted on the table itself if none is given. Missing and empty texts have no traits, get the
    scorer's bias as their score and are judged like any other; repeated rows get equal results. Added columns get
    underscores in front if the input has columns of their names.
    """
    names = fresh(docs, "posterior", "score", "rejected", "_quality")
    model = model or fit(docs, text_column=text_column)
    marked = docs.withColumn(names[3], quality_of(F.col(text_column), model, docs.sparkSession))
    score = F.col(f"{names[3]}.score")
    return marked.select(*docs.columns, F.col(f"{names[3]}.posterior").alias(names[0]), score.alias(names[1]), (score < 0.5).alias(names[2]))
