"""Document quality by Bradley-Terry pairwise ranking.

Features come from the text alone: the rates of its bytes, and how much it repeats words
and lines. A document's score is a linear function of its standardised features. It is
learnt from preference pairs, a better and a worse document each, by logistic loss on the
difference of their features: P(a over b) = 1 / (1 + exp(score_b - score_a)), with an L2
penalty, fitted by Newton's method.

The fit sees a documented number of labelled rows, ``sample``, taken by a hash of their id;
each row of the rarer label is paired with ``per_row`` rows of the other in turn. All
documents are scored. The threshold is the quantile of the sample's scores below which the
share of rows with label 0 lies, moved to the middle of the gap there; scores become
probabilities by a logistic curve that is ``cut`` at the threshold.

Edge cases: null texts count as empty; they have zero features and get a score too. With
no pair to learn from every score is 0.5. Repeated rows count as often as they occur. An
empty table gives no rows. Labels, ids and sources are no features, and other columns are
not read.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FOLD = np.arange(256)
_FOLD[65:91] += 32  # A-Z count as a-z; upper case has a feature of its own
EXTRA = 8


def features(text: str | None) -> np.ndarray:
    """Square roots of byte rates, then measures of repetition, case and length."""
    raw = (text or "").encode()
    out = np.zeros(256 + EXTRA)
    if not raw:
        return out
    data = np.frombuffer(raw, np.uint8)
    counts = np.bincount(data, minlength=256)
    np.add.at(out, _FOLD, counts)
    out[:256] = np.sqrt(out[:256] / len(data))
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    times = {}
    for w in words:
        times[w] = times.get(w, 0) + 1
    most = max(times.values(), default=0)
    same = sum(a == b for a, b in zip(words, words[1:]))
    out[256:] = [
        len(times) / n,
        most / n,
        same / n,
        len(set(lines)) / len(lines),
        counts[65:91].sum() / len(data),
        np.log1p(len(words)) / 10,
        min(1.0, len(data) / n / 20),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n,
    ]
    return out


def fit(good: np.ndarray, bad: np.ndarray, per_row: int = 8, penalty: float = 1e-3, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """(mean, weights) of the pairwise model from features of better and worse documents."""
    both = np.concatenate([good, bad])
    mean, spread = both.mean(axis=0), both.std(axis=0)
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0)
    good, bad = (good - mean) * scale, (bad - mean) * scale
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    at = np.arange(len(few) * per_row)
    other = many[(at % len(few) * per_row + at // len(few)) % len(many)]
    pairs = (other - few[at % len(few)]) * (1 if few is bad else -1)
    weights = np.zeros(pairs.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(pairs @ weights, -30, 30)))  # of being ranked wrongly
        slope = pairs.T @ p / len(pairs) - penalty * weights
        bend = (pairs * (p * (1 - p))[:, None]).T @ pairs / len(pairs) + penalty * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, weights * scale


class Ranking:
    def __init__(self, sample: list[tuple[np.ndarray, int]], cut: float):
        good, bad = ([f for f, q in sample if q == label] for label in (1, 0))
        self.cut, self.weights = cut, None
        if not good or not bad:
            return
        self.mean, self.weights = fit(np.array(good), np.array(bad))
        scores = np.sort(self.raw(np.array(good + bad)))
        self.threshold = (scores[len(bad) - 1] + scores[len(bad)]) / 2
        self.spread = max(1e-9, scores.std())

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.weights

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """``cut`` at the threshold, more above it."""
        if self.weights is None:
            return np.full(len(x), 0.5)
        z = 4 * (self.raw(x) - self.threshold) / self.spread + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000, cut: float = 0.3) -> Ranking:
    """A ranking from ``sample`` labelled rows at most: all, or those with the smallest hash of their id.

    The chosen labels, of at most ``sample`` rows, go to the documents. Features, not
    texts, reach the driver, one row per label: of rows that repeat an id the smallest.
    """
    marked = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    share = min(1.0, sample / max(1, marked.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    near = marked.where(place < F.lit(round(1.1 * share * (1 << 20)) + 64))
    chosen = near.orderBy(place, "doc_id", "quality").limit(sample)

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t).tobytes())

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", of("text").alias("f"), "quality")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("f").alias("f")).toArrow()
    # In an order of their own, so that the same rows make the same pairs.
    pairs = sorted(zip(rows["f"].to_pylist(), rows["quality"].to_pylist(), strict=True))
    return Ranking([(np.frombuffer(f, float), q) for f, q in pairs], cut)


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """doc_id, score of each row."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(ranking.probabilities(np.array([features(t) for t in texts]).reshape(-1, 256 + EXTRA)))

    return docs.select("doc_id", of("text").alias("score"))


def rank(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """doc_id, score of each row of ``docs``, learnt from the labels of the rows where ``training`` holds."""
    return score(docs, learn(docs.where(training), labels))
