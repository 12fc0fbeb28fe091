"""Quality classifier learned from trusted positives and unlabelled text.

A small network is fitted to the non-negative unbiased risk of positive-unlabelled learning:
``prior * R_P(+1) + max(0, R_U(-1) - prior * R_P(-1))`` under the logistic loss. Positives are
trusted good texts; the unlabelled ones are a bounded sample of all documents, whether they
have a label or not. The class prior, the share of good texts among these, is estimated from
the two samples: a ranking of good before unlabelled texts is fitted on one half of each, and on
the other half the share of unlabelled texts is compared with that of good ones above each cut.
Labels other than good are not read.

Defined results: a null or empty text has features of zero and a score like any other.
Repeated rows are scored alike. Labels other than 1 are not used; of two labels for one
id the larger counts. Without positives every score is ``DEFAULT_PRIOR``. An empty table gives
an empty result. Texts of any length are read whole. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import whole
from shelfmark.llm.labels import Logistic, held_out, sigmoid, training_labels
from shelfmark.llm.shingles import SPACES, mix, text_bytes, word_hashes

FOLDS, FOLD = 5, 0
#: Good texts, and unlabelled ones, read for fitting, at most.
SAMPLE_ROWS = 12_000
#: Prior and score where no text is labelled good.
DEFAULT_PRIOR = 0.8
#: Chance that the bounds used in estimating the prior do not hold.
DOUBT = 0.1
THRESHOLD = 0.3
HIDDEN, ROUNDS, RATE, DECAY, SEED = 16, 600, 0.02, 1e-4, 7
TEXTS_AT_ONCE = 256

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = (_BYTES >= 0x61) & (_BYTES <= 0x7A)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_STOP = np.isin(_BYTES, [ord(c) for c in ".,;:?"])
_SIGN = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_UPPER & ~_LOWER & ~_DIGIT & ~_STOP
_NEWLINE = _BYTES == 0x0A
_WIDE = _BYTES >= 0x80
KINDS = (_UPPER, _LOWER, _DIGIT, _STOP, _SIGN, _NEWLINE, _WIDE, SPACES)
NAMES = (
    "words", "word_size", "upper", "lower", "digit", "stop", "sign", "newline", "wide", "space",
    "distinct", "commonest", "repeated_next", "distinct_pairs", "distinct_fives", "long_runs",
)


def _repetition(words: np.ndarray) -> tuple[float, float, float, float, float, float]:
    """Shares of distinct words, of the commonest, of words that repeat the one before, of
    distinct pairs and fives, and of places in runs of three equal words."""
    n = len(words)
    if not n:
        return 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    _, times = np.unique(words, return_counts=True)
    same = words[1:] == words[:-1]
    pairs = words[:-1] * np.uint64(3) + words[1:]
    fives = mix(
        words[: n - 4] + words[1 : n - 3] * np.uint64(3) + words[2 : n - 2] * np.uint64(5)
        + words[3 : n - 1] * np.uint64(7) + words[4:] * np.uint64(11)
    ) if n > 4 else words[:0]
    return (
        len(times) / n, times.max() / n, float(same.mean()) if n > 1 else 0.0,
        len(np.unique(pairs)) / (n - 1) if n > 1 else 1.0,
        len(np.unique(fives)) / len(fives) if len(fives) else 1.0,
        float((same[1:] & same[:-1]).mean()) if n > 2 else 0.0,
    )


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text, over whole texts."""
    data, bounds = text_bytes(texts)
    hashes, counts = word_hashes(data, bounds)
    rows = np.zeros((len(texts), len(NAMES)))
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    rows[:, 0] = np.log1p(counts)
    if len(full):
        part = data[bounds[0] : bounds[-1]]
        starts = (bounds[:-1] - bounds[0])[full]
        for place, kind in enumerate(KINDS):
            total = np.add.reduceat(kind[part].astype(np.int64), starts)
            rows[full, 2 + place] = total / sizes[full]
        solid = sizes[full] * (1 - rows[full, 2 + len(KINDS) - 1])
        rows[full, 1] = np.minimum(solid / np.maximum(counts[full], 1), 100)
    ends = np.cumsum(counts)
    for row, (end, count) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
        rows[row, 10:] = _repetition(hashes[end - count : end])
    return rows


@dataclass
class Network:
    """One hidden layer on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def hidden(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        return x, np.tanh(x @ self.weights[0] + self.weights[1])

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return self.hidden(rows)[1] @ self.weights[2] + self.weights[3][0]

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(rows))


def risk_gradient(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float
) -> tuple[float, np.ndarray, np.ndarray]:
    """The risk, and its gradient by the logits of the positives and of the unlabelled.

    Where the estimated risk on negatives is below zero, which no true risk is, the step
    goes against it instead of following it further down.
    """
    p, u = sigmoid(positive), sigmoid(unlabelled)
    n_p, n_u = len(p), len(u)
    as_positive = np.logaddexp(0, -positive).mean()
    negative = np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()
    by_p, by_u = -(1 - p) / n_p * prior, np.zeros(n_u)
    if negative >= 0:
        return prior * as_positive + negative, by_p - prior * p / n_p, u / n_u
    return prior * as_positive, prior * p / n_p, by_u - u / n_u


def fit_network(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Adam on the non-negative risk, from a fixed seed."""
    rows = np.vstack([positive, unlabelled])
    scale = rows.std(0)
    rng = np.random.default_rng(SEED)
    width = rows.shape[1]
    network = Network(rows.mean(0), np.where(scale > 1e-9, scale, 1.0), [
        rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN), np.array([np.log(prior / (1 - prior))]),
    ])
    first = [np.zeros_like(w) for w in network.weights]
    second = [np.zeros_like(w) for w in network.weights]
    cut = len(positive)
    for step in range(1, ROUNDS + 1):
        x, hidden = network.hidden(rows)
        logits = hidden @ network.weights[2] + network.weights[3][0]
        _, by_p, by_u = risk_gradient(logits[:cut], logits[cut:], prior)
        by_logit = np.concatenate([by_p, by_u])
        by_hidden = np.outer(by_logit, network.weights[2]) * (1 - hidden**2)
        gradient = [
            x.T @ by_hidden, by_hidden.sum(0), hidden.T @ by_logit, np.array([by_logit.sum()])
        ]
        for place, weight in enumerate(network.weights):
            slope = gradient[place] + DECAY * weight
            first[place] = 0.9 * first[place] + 0.1 * slope
            second[place] = 0.999 * second[place] + 0.001 * slope**2
            unbiased = first[place] / (1 - 0.9**step)
            spread = np.sqrt(second[place] / (1 - 0.999**step)) + 1e-8
            weight -= RATE * unbiased / spread
    return network


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in a mixture, from features of positives and of the mixture.

    Above any cut of a score, the mixture's share is at least the prior times the positives'.
    So no ratio of the two shares is below the prior, and where the cut leaves hardly any
    negative above it, the ratio comes close. The score is fitted on every other row and the
    ratios are taken on the rest, at the cut where the ratio's upper bound is least.
    """
    labels = np.concatenate([np.ones(len(positive[::2])), np.zeros(len(unlabelled[::2]))])
    ranking = Logistic.fit(np.vstack([positive[::2], unlabelled[::2]]), labels)
    p, u = (np.sort(ranking.logit(rows[1::2])) for rows in (positive, unlabelled))
    if not len(p) or not len(u):
        return DEFAULT_PRIOR
    above_p = 1 - np.searchsorted(p, p) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    slack = np.sqrt(np.log(4 / DOUBT) / 2) * (len(u) ** -0.5 + len(p) ** -0.5)
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
) -> Network | float:
    """Fit on at most ``sample_rows`` texts labelled good outside the held-out fold, and on as
    many texts of all documents outside that fold, without their labels.

    Which texts is settled by hashes of their ids, so a run on the same table takes the same.
    The sampled ids are broadcast to the scan; features are made in the tasks, and a row of
    numbers per sampled text comes to the driver.
    """
    ids = docs.select(F.col(id_col).alias("doc_id")).withColumn("unlabelled", F.lit(1))
    marked = {
        1: training_labels(labels.where(F.col(label) == 1), label, FOLDS, FOLD, sample_rows),
        0: training_labels(ids, "unlabelled", FOLDS, FOLD, sample_rows),
    }
    texts = docs.select(F.col(id_col).alias("_id"), whole(F.col(text_col)).alias("_text"))
    rows = {}
    for side, sample in marked.items():
        chosen = sample.select(F.col("doc_id").alias("_id"))
        found = texts.join(chosen, "_id").select("_id", feature_column()("_text").alias("x"))
        found = found.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows).toPandas()
        rows[side] = np.array(found["x"].to_list()).reshape(-1, len(NAMES))
    if not len(rows[1]):
        return DEFAULT_PRIOR
    return fit_network(rows[1], rows[0], estimate_prior(rows[1], rows[0]))


def _in_parts(texts: pd.Series) -> Iterator[np.ndarray]:
    for start in range(0, len(texts), TEXTS_AT_ONCE):
        part = texts.iloc[start : start + TEXTS_AT_ONCE]
        yield features(pa.array(part.to_list(), pa.large_string()))


def feature_column():
    """A column function: the features of a text."""

    @F.pandas_udf("array<double>")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([row for part in _in_parts(texts) for row in part])

    return made


def score_column(model: Network | float):
    """A column function: the quality of a text, 0 to 1."""
    if isinstance(model, float):
        return lambda text: F.lit(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([model(part) for part in _in_parts(texts)] or [np.zeros(0)]))

    return score


def score_documents(
    docs: DataFrame, model: Network | float, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of each document; one pass."""
    score = score_column(model)(whole(F.col(text_col)))
    return docs.select(
        F.col(id_col), held_out(F.col(id_col), FOLDS, FOLD).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
