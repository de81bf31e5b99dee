"""Quality classifier: cumulative-link regression on graded ratings.

A rating is one of ordered grades: 0 toxic, 1 poor, 2 good. One weight per hashed feature
of the text is shared by all grades; ordered thresholds cut the score into them, so
``P(grade > k) = 1 / (1 + exp(threshold_k - score))``. Selection uses the tail probability
of the best grade.

Features are words, without case and outer punctuation, and a few signs of a text's form
(share of words with symbols, in capitals, repeated), all hashed into one table. Only
features whose presence departs from independence of the grade get a weight, so the
thousands of rare words of a long text add nothing to its score.

The fit uses at most ``sample`` labelled documents, the ones first by a hash of their id.

Cases: null text is the empty one; documents without label are scored but not learned
from; several labels of one document count as the lowest; without labels, or with one
grade only, every document is kept with tail probability 1; a result's name among the
columns is replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, small_batches, whole_text

GRADES = 3
TABLE = 1 << 20
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
LEVELS = (0.05, 0.2, 0.5)
SYMBOLS = set("*#$%&|<>!")

_hashed: dict[str, int] = Recent("grader")


def _slot(word: str) -> int:
    known = _hashed.get(word)
    if known is None:
        known = _hashed.keep(word, zlib.crc32(("w:" + word.lower().strip(EDGES)).encode()) % TABLE)
    return known


def _form(words: list[str]) -> list[int]:
    """Signs of the text's form, as hashed features."""
    n = len(words) or 1
    shares = {
        "symbols": sum(w[-1] in SYMBOLS for w in words) / n,
        "capitals": sum(map(str.isupper, words)) / n,
        "again": sum(map(str.__eq__, words, words[1:])) / n,
    }
    return [zlib.crc32(f"f:{name}>{level}".encode()) % TABLE for name, x in shares.items() for level in LEVELS if x > level]


def features(text: str) -> set[int]:
    words = text.split()
    found = set(map(_slot, set(words)))
    found.update(_form(words))
    return found


@dataclass(frozen=True)
class Model:
    slots: tuple[int, ...]
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]


def fit_rows(rows: list[tuple[int, list[int]]], least: int = 6, strength: float = 18.0) -> Model | None:
    """Weights of the (grade, features) rows; null without two grades."""
    grades = np.array([g for g, _ in rows], np.int64)
    if len(np.unique(grades)) < 2:
        return None
    counts = np.zeros((GRADES, TABLE), np.int32)
    for grade, slots in rows:
        counts[grade, slots] += 1
    total, of_grade = counts.sum(0), np.bincount(grades, minlength=GRADES)
    often = np.flatnonzero(total >= least)
    share = of_grade / len(rows)
    tests = np.zeros(len(often))
    for k in range(GRADES):
        if of_grade[k]:
            for seen, expected in ((counts[k, often], total[often] * share[k]),
                                   (of_grade[k] - counts[k, often], (len(rows) - total[often]) * share[k])):
                tests += 2 * seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    picked = often[tests > strength]
    place = np.full(TABLE, -1, np.int32)
    place[picked] = np.arange(len(picked))
    held = [at[at >= 0] for at in (place[slots] for _, slots in rows)]
    row = np.repeat(np.arange(len(rows)), list(map(len, held)))
    weights, thresholds = _descend(row, np.concatenate(held).astype(np.int64), len(picked), grades)
    return Model(tuple(map(int, picked)), tuple(map(float, weights)), tuple(map(float, thresholds)))


def _descend(row: np.ndarray, feature: np.ndarray, width: int, grades: np.ndarray, rounds: int = 400, rate: float = 0.1, ridge: float = 0.3):
    """Adam on the cumulative-link likelihood of rows that have the features named beside them; the step
    between thresholds is kept positive by its logarithm."""
    n = len(grades)
    below = np.clip(np.cumsum(np.bincount(grades, minlength=GRADES))[:-1] / n, 1e-4, 1 - 1e-4)
    first = np.log(below / (1 - below))
    theta = np.concatenate([np.zeros(width), [first[0]], np.log(np.maximum(np.diff(first), 0.1))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sigma = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, rounds + 1):
        cuts = np.cumsum(np.concatenate([[theta[width]], np.exp(theta[width + 1:])]))
        score = np.bincount(row, theta[feature], n)
        edge = np.concatenate([np.full((n, 1), 0.0), sigma(cuts - score[:, None]), np.full((n, 1), 1.0)], 1)
        rows = np.arange(n)
        low, high = edge[rows, grades], edge[rows, grades + 1]
        p = np.maximum(high - low, 1e-9)
        slope_low, slope_high = low * (1 - low) / p, high * (1 - high) / p
        by_score = (slope_high - slope_low)  # of the negative log likelihood
        by_cut = np.array([
            (slope_low[grades == k + 1]).sum() - (slope_high[grades == k]).sum() for k in range(GRADES - 1)
        ])
        tail = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate([np.bincount(feature, by_score[row], width) + ridge * theta[:width], [tail[0]], tail[1:] * np.exp(theta[width + 1:])]) / n
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:width], np.cumsum(np.concatenate([[theta[width]], np.exp(theta[width + 1:])]))


def grade_of(toxic: str = "toxic", quality: str = "quality") -> Column:
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_column: str = "doc_id", text_column: str = "text") -> Model | None:
    small_batches(docs.sparkSession)
    graded = labels.select(F.col(id_column).alias("id"), grade_of().alias("grade")).dropna()
    # at most ``sample`` ids, so small enough to send everywhere
    chosen = graded.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(features(t)) for t in texts.to_pylist()], pa.list_(pa.int32()))

    # documents may repeat an id: the first by text stands for it
    found = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("grade").alias("grade"))
    coded = found.select("id", "grade", F.arrow_udf(run, "array<int>")("text").alias("slots"))
    table = coded.toArrow()
    order = np.argsort(table["id"].to_numpy())
    slots, grades = table["slots"].combine_chunks(), table["grade"].to_numpy()
    return fit_rows([(int(grades[i]), slots[int(i)].values.to_numpy()) for i in order])


def graded(docs: DataFrame, model: Model | None, least: float = 0.5, text_column: str = "text") -> DataFrame:
    """All columns, ``expected_grade``, ``tail_probability`` (of the best grade) and ``kept``."""
    small_batches(docs.sparkSession)
    schema = "struct<expected_grade:double,tail_probability:double>"
    session = docs.sparkSession
    sent = session.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        model = sent.value
        if model is None:
            ones = np.ones(len(texts))
            return pa.StructArray.from_arrays([pa.array(ones * (GRADES - 1)), pa.array(ones)], names=["expected_grade", "tail_probability"])
        weight = dict(zip(model.slots, model.weights))
        scores = np.array([sum(sorted(weight.get(s, 0.0) for s in features(t) if s in weight)) for t in texts.to_pylist()], float)
        tails = 1 / (1 + np.exp(np.clip(np.array(model.thresholds) - scores[:, None], -40, 40)))
        return pa.StructArray.from_arrays(
            [pa.array(tails.sum(1)), pa.array(tails[:, -1])], names=["expected_grade", "tail_probability"]
        )

    scored = docs.drop("expected_grade", "tail_probability", "kept", "_g").withColumn("_g", F.arrow_udf(run, schema)(whole_text(text_column)))
    return scored.select("*", "_g.*", (F.col("_g.tail_probability") >= least).alias("kept")).drop("_g")


def accepted(docs: DataFrame, model: Model | None, **params) -> DataFrame:
    """The same columns of the rows that are kept."""
    return graded(docs.select(F.struct("*").alias("row"), "text"), model, **params).filter("kept").select("row.*")
