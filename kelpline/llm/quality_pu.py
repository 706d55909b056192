"""Quality classifier by positive-unlabelled learning.

Features are shares of characters and words of the whole text (below), computed for whole Arrow batches. A
logistic model minimises the non-negative unbiased risk

    prior * R+(g)  +  max(0, Ru-(g) - prior * R-(g))

where R+ and R- are the mean losses of trusted positives taken as positive or negative, and Ru- that of
unlabelled texts taken as negative. When the second term is negative, a step is taken against it, as
published for the non-negative estimator. No label 0 is ever used.

The class prior is estimated from the same two sets: with a first model (positives against
unlabelled texts), the smallest ratio of the shares of unlabelled and positive texts above a score, over
all scores that leave at least a tenth of the positives, is the share of positives among the unlabelled.

The model is fitted on at most `most_positive` trusted positives and `most_unlabelled` unlabelled texts,
the first of each in the order of a hash of their ids: these two bounds are parameters. Of rows that repeat an id the
least text is taken, so that the fit doesn't depend on the order of rows. Scores are of all rows.

Defined cases: null text is scored as an empty one; an empty text gets a score like any other. Rows that
repeat are scored alike. A null doc_id is not held out, and not in any sample. Labels that are null, or whose doc_id is null or not in docs, are ignored. Without
any positive in the labels every score is the prior parameter's default, 0.5. A text of any length is read whole. Columns of the documents
pass through `score` unchanged; one with the name of the result is refused. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from kelpline.llm.common import free, slices, unused
from kelpline.llm.wordhash import SPACED, Words, text_buffer

MOST_POSITIVE, MOST_UNLABELLED = 8_000, 16_000

_KINDS = np.zeros(256, dtype=np.int64)
for _k, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:", "!", "?", "|", "#*$%&<>", "\"'()[]{}", "/\\@_=+~^`-", " \t\r\v\f", "\n"], start=1):
    for _c in _chars:
        _KINDS[ord(_c)] = _k
_N_KINDS = 14
_KINDS[128:] = 13
N_FEATURES = _N_KINDS + 9


def features(column: pa.Array) -> np.ndarray:
    """One row of N_FEATURES numbers for each text."""
    words = Words(column, SPACED)
    raw, offsets = text_buffer(column)
    n, size = len(column), np.maximum(np.diff(offsets) - 1, 1).astype(float)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(doc * _N_KINDS + _KINDS[raw], minlength=n * _N_KINDS).reshape(n, _N_KINDS).astype(float)
    shares = counts / size[:, None]
    n_words = np.diff(words.first).astype(float)
    some = np.maximum(n_words, 1)
    per_word = lambda mask: np.bincount(words.doc[mask], minlength=n) / some
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    two = np.zeros(len(words), dtype=bool)
    two[2:] = (words.hash[2:] == words.hash[:-2]) & (words.doc[2:] == words.doc[:-2])
    order = np.lexsort((words.hash, words.doc))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    length = (words.end - words.start).astype(float)
    first = raw[words.start] if len(words) else np.zeros(0, np.uint8)
    upper = (first >= 65) & (first <= 90)
    last = raw[words.end - 1] if len(words) else np.zeros(0, np.uint8)
    odd_end = (last < 128) & (_KINDS[last] > 4)
    more = [
        per_word(again), per_word(two), np.bincount(words.doc[order][new], minlength=n) / some,
        np.bincount(words.doc, weights=length, minlength=n) / some / 10, per_word(upper), per_word(odd_end), per_word(length == 1),
        np.log1p(n_words) / 10, counts[:, 12] / some,
    ]
    return np.column_stack([shares, *more])


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _grow(x: np.ndarray) -> np.ndarray:
    """The features and their square roots, which tell small shares apart."""
    return np.column_stack([x, np.sqrt(np.maximum(x, 0)), np.ones(len(x))])


class Model:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = (_grow(x) - self.mean) / self.scale
        return np.clip(z, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, rounds: int = 600, rate: float = 0.05, ridge: float = 1e-4) -> np.ndarray:
    """Weights by Adam on whole sets; without a prior, of a plain model of positives against unlabelled texts."""
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    grad = lambda x, sign: (-sign / (1 + np.exp(np.clip(sign * (x @ w), -30, 30)))) @ x / len(x)
    for t in range(1, rounds + 1):
        if prior is None:
            g = grad(p, 1) + grad(u, -1)
        else:
            rest = _loss(-(u @ w)).mean() - prior * _loss(-(p @ w)).mean()
            g_rest = grad(u, -1) - prior * grad(p, -1)
            g = prior * grad(p, 1) + g_rest if rest >= 0 else -g_rest
        g = g + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled scores u, given those of positives."""
    p, u = np.sort(p), np.sort(u)
    at = p[: max(1, int(0.9 * len(p)))]
    above_p = 1 - np.searchsorted(p, at, side="left") / len(p)
    above_u = 1 - np.searchsorted(u, at, side="left") / len(u)
    slack = np.sqrt(above_u / len(u)) + np.sqrt(above_p / len(p))  # a ratio of few texts says little
    return float(np.clip(((above_u + slack) / above_p).min(), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model from features of trusted positives and of unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        k = 2 * N_FEATURES + 1
        return Model(np.zeros(k), np.ones(k), np.zeros(k), 0.5)
    p, u = _grow(positive), _grow(unlabelled)
    mean, scale = u.mean(0), u.std(0) + 1e-3
    mean[-1], scale[-1] = 0, 1
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    first = _fit(p, u, None)
    prior = class_prior(p @ first, u @ first)
    return Model(mean, scale, _fit(p, u, prior), prior)


@arrow_udf(T.ArrayType(T.DoubleType()))
def _features(text: pa.Array) -> pa.Array:
    rows = [r for part in slices(text) for r in features(part)]
    return pa.array(rows, pa.list_(pa.float64()))


def in_training(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text (null: empty), modulo 3, is not 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def train(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """Fit on bounded samples: positives of the labels, and texts taken without regard to any label."""
    order = F.xxhash64(F.lit("quality"), "doc_id")
    mine = F.col("doc_id").isNotNull() & in_training(F.col("doc_id"))
    positive = labels.where((F.col("quality") == 1) & mine).select("doc_id").distinct().orderBy(order, "doc_id").limit(most_positive)
    unlabelled = docs.where(mine).select("doc_id").distinct().orderBy(order, "doc_id").limit(most_unlabelled)
    wanted = positive.withColumn("p", F.lit(True)).unionByName(unlabelled.withColumn("p", F.lit(False))).groupBy("doc_id").agg(F.max("p").alias("p"), F.max(~F.col("p")).alias("u"))
    # one row for each id, however often it is repeated: no more than the two bounds say
    own = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.first("p").alias("p"), F.first("u").alias("u"), F.min("text").alias("text"))
    rows = own.select("p", "u", _features("text").alias("x"), "doc_id").toPandas().sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), N_FEATURES)
    return fit(x[rows["p"].to_numpy(bool)], x[rows["u"].to_numpy(bool)])


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """docs with the score of each whole text, between 0 and 1."""
    free(docs, column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(T.DoubleType())
    def scored(text: pa.Array) -> pa.Array:
        parts = [shared.value.score(features(part)) for part in slices(text)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return docs.withColumn(column, scored.asNondeterministic()("text"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts (score of 0.5 or more), with all their columns."""
    name = unused(docs, "score")
    return score(docs, train(docs, labels), name).where(F.col(name) >= 0.5).select(*docs.columns)
