"""Quality rules by robust multivariate outliers.

Every text gives a vector of transformed statistics. Per language and source, the minimum
covariance determinant is approached by concentration steps: take the share ``core`` of
rows nearest to the present centre, estimate centre and scatter from them alone, repeat.
Rows far from their group's centre by Mahalanobis distance are rejected. Each step is an
aggregate with one small row per group, so a group with most rows is spread over all tasks.
Groups with fewer than ``least`` rows take their language's estimate, or that of all.

Cases: null text has no words and fails the fixed rules; null languages and sources are
groups of their own; identical statistics leave no scatter, which ``FLOORS`` then bounds
from below; an empty table gives an empty result; a result's name among the columns is
replaced, all others stay; repeated rows get the same verdict each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, landed, small_batches, whole_text
from tidemark.operators.joins import join_under_skew

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_upper bigint, n_lines bigint"
# Least standard deviation of each feature: what differs by less is no sign of anything.
FLOORS = {"word_length": 0.25, "symbols": 0.03, "dup_lines": 0.12, "repeats": 0.12, "upper": 0.06}
FEATURES = tuple(FLOORS)
PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for k in range(width):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n]
        windows ^= windows >> np.uint64(29)
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(windows, twice))
    edges = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + width, minlength=len(words) + 1)[:len(words) + 1]
    return int((np.cumsum(edges) > 0).sum())


def statistics_of(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    upper = sum(map(str.isupper, text)) if not text.isascii() else sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        upper,
        len(lines),
    )


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns and those of ``STATISTICS``."""
    small_batches(docs.sparkSession)
    names = [part.split()[0] for part in STATISTICS.split(", ")]

    def run(texts: pa.Array) -> pa.Array:
        Recent.leave_to("outliers")
        rows = np.array([statistics_of(text) for text in texts.to_pylist()], np.int64).reshape(-1, len(names))
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(names))], names=names)

    stats = docs.drop(*names, "_s").withColumn("_s", F.arrow_udf(run, f"struct<{STATISTICS.replace(' bigint', ':bigint')}>")(whole_text(text_column)))
    return stats.select("*", "_s.*").drop("_s")


def features() -> list[Column]:
    """Ratios, drawn to the usual value where the text is short, on a root scale where they pile up at zero."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return [
        ((chars + 300) / (words + 50)).alias("word_length"),
        F.sqrt(F.col("n_symbols") / (chars + 100)).alias("symbols"),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 8)).alias("dup_lines"),
        F.sqrt(F.col("n_repeat_words") / (words + 40)).alias("repeats"),
        F.sqrt(F.col("n_upper") / (chars + 100)).alias("upper"),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _keys(lang: str, source: str) -> list[Column]:
    """Names of a row's group, of its language and of all; null is a name of its own."""
    return [
        F.to_json(F.struct(F.col(lang).alias("lang"), F.col(source).alias("source"))),
        F.to_json(F.struct(F.col(lang).alias("of"))),
        F.lit("all"),
    ]


def _distance() -> Column:
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        a, b = F.col(FEATURES[i]) - F.col("centre")[i], F.col(FEATURES[j]) - F.col("centre")[j]
        total = total + (1.0 if i == j else 2.0) * a * b * F.col("precision")[k]
    return total


def _precisions(frames: Iterator[pd.DataFrame], inflate: float) -> Iterator[pd.DataFrame]:
    """Centre and inverse scatter from sums of a group's core; scatter is inflated, as a core is too narrow."""
    floors = np.array(list(FLOORS.values())) ** 2
    for frame in frames:
        rows = []
        for key, n, sums, products in frame.itertuples(index=False):
            centre = np.array(sums) / n
            scatter = np.zeros((len(FEATURES),) * 2)
            for (i, j), value in zip(PAIRS, products):
                scatter[i, j] = scatter[j, i] = value / n - centre[i] * centre[j]
            scatter = scatter * inflate + np.diag(floors)
            inverse = np.linalg.inv(scatter)
            rows.append((key, n, centre.tolist(), [float(inverse[i, j]) for i, j in PAIRS]))
        yield pd.DataFrame(rows, columns=["key", "n", "centre", "precision"])


def _estimate(rows: DataFrame, inflate: float) -> DataFrame:
    sums = rows.groupBy("key").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(f) for f in FEATURES]).alias("sums"),
        F.array(*[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in PAIRS]).alias("products"),
    )
    schema = "key string, n bigint, centre array<double>, precision array<double>"
    return landed(sums.mapInPandas(lambda frames: _precisions(frames, inflate), schema), "outliers")


def chi_square(p: float, quantile: float) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    from statistics import NormalDist

    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(quantile) * (2 / (9 * p)) ** 0.5) ** 3


def fit(docs: DataFrame, lang: str, source: str, core: float, steps: int, least: int) -> DataFrame:
    """key, centre, precision: one row for each pair of language and source."""
    small_batches(docs.sparkSession)
    group, of_lang, whole = _keys(lang, source)
    rows = landed(docs.select(*features(), group.alias("group"), of_lang.alias("of")), "statistics")
    spread = rows.select(*FEATURES, F.explode(F.array("group", "of", whole)).alias("key"))
    # start: distance from the medians, each feature by itself
    medians = landed(spread.groupBy("key").agg(
        F.array(*[F.percentile_approx(f, 0.5, 1000) for f in FEATURES]).alias("centre"), F.count("*").alias("n")
    ), "outliers")
    diagonal = F.array(*[F.lit(1.0 / v**2 if i == j else 0.0) for i, j in PAIRS for v in [list(FLOORS.values())[i]]])
    found = medians.withColumn("precision", diagonal)
    p = len(FEATURES)
    inflate = core / _chi_cdf(p + 2, chi_square(p, core))
    for _ in range(steps):
        far = join_under_skew(spread, found.select("key", "centre", "precision"), ["key"]).withColumn("d2", _distance())
        radius = landed(far.groupBy("key").agg(F.percentile_approx("d2", core, 2000).alias("radius")), "outliers")
        near = join_under_skew(far.select("key", *FEATURES, "d2"), radius, ["key"]).filter("d2 <= radius")
        found = _estimate(near, inflate)
    # a small group takes the estimate of its language, or of all
    counts = medians.filter((F.col("n") >= least) | (F.col("key") == "all")).select("key")
    known = found.join(counts, "key", "left_semi").select("key", F.struct("centre", "precision").alias("estimate"))
    levels = F.array(*[F.struct(F.lit(i).alias("level"), c.alias("key")) for i, c in enumerate((F.col("group"), F.col("of"), whole))])
    named = rows.select("group", "of").distinct().select("group", F.inline(levels)).join(known, "key")
    best = named.groupBy("group").agg(F.min_by("estimate", "level").alias("best"))
    return landed(best.select(F.col("group").alias("key"), "best.*"), "outliers")


def _chi_cdf(p: float, x: float) -> float:
    from statistics import NormalDist

    return NormalDist().cdf(((x / p) ** (1 / 3) - (1 - 2 / (9 * p))) / (2 / (9 * p)) ** 0.5)


def judged(
    docs: DataFrame, text_column: str = "text", lang: str = "lang", source: str = "source",
    core: float = 0.75, steps: int = 3, least: int = 200, quantile: float = 0.9999999,
) -> DataFrame:
    """All columns, the statistics, ``distance`` (squared), ``base_failed`` and ``kept``."""
    named = F.col(text_column).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source")
    narrow = docs.select(*named)
    results = [*[part.split()[0] for part in STATISTICS.split(", ")], "distance", "base_failed", "kept"]
    # everything the caller has stays in one column, so only the results' own names are taken
    stats = with_statistics(docs.select(F.struct(*docs.drop(*results).columns).alias("row"), *named))
    estimates = fit(with_statistics(narrow), "lang", "source", core, steps, least)
    keyed = stats.select("*", *features(), _keys("lang", "source")[0].alias("key"))
    far = join_under_skew(keyed, estimates, ["key"]).withColumn("distance", _distance())
    limit = chi_square(len(FEATURES), quantile)
    return far.select(
        "row.*", *results[:-2], base_failed().alias("base_failed"), (~base_failed() & (F.col("distance") <= limit)).alias("kept")
    )


def accepted(docs: DataFrame, **params) -> DataFrame:
    """The same columns of the rows that are kept."""
    row = docs.select(F.struct("*").alias("row"), "text", "lang", "source")
    return judged(row, **params).filter("kept").select("row.*")
