"""Emergence: each article against its own recent past, by median and MAD."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import series
from tidemark.functions.columns import between_days, day_key
from tidemark.params import DEFAULTS, Params

ARTICLE = ["project", "title"]
METRICS = ("edit_count", "unique_editors")


def history_window(day: date, params: Params = DEFAULTS) -> tuple[date, date]:
    """First and last day of [D - 28, D - 1]."""
    return day - timedelta(days=params.history_days), day - timedelta(days=1)


def past_edits(edits: DataFrame, day: date, params: Params = DEFAULTS) -> DataFrame:
    """Edits of the history window with the ``day`` they happened; also prunes day folders."""
    first, last = history_window(day, params)
    if "day" in edits.columns:
        edits = edits.filter(F.col("day").between(f"{first:%Y%m%d}", f"{last:%Y%m%d}"))
    past = edits.filter(between_days(F.col("timestamp_utc"), first, last))
    return past.withColumn("day", day_key(F.col("timestamp_utc")))


def observed_days(past: DataFrame) -> DataFrame:
    """Days with data; a day nobody recorded is no day without edits."""
    return past.select("day").distinct()


def history_days(past: DataFrame) -> Column:
    """Number of observed days as a scalar subquery: no job runs until the query does."""
    return observed_days(past).agg(F.count("*").cast("int").alias("n")).scalar()


def daily_history(past: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """Edits and distinct editors per article and day, optionally only for the articles given.

    Counted before it meets the articles: a heavily edited one is then at most one row
    per day, where joining the raw edits would gather all of them in one task.
    """
    history = past.groupBy(*ARTICLE, "day").agg(
        F.count("*").alias("edit_count"), F.count_distinct("user").alias("unique_editors")
    )
    if articles is None:
        return history
    return history.join(articles.select(*ARTICLE).distinct(), ARTICLE, "left_semi")


def article_history(history: DataFrame) -> DataFrame:
    """One row per article with its non-zero daily counts, at most one entry per history day."""
    return history.groupBy(*ARTICLE).agg(
        *[F.collect_list(m).alias(f"past_{m}") for m in METRICS]
    )


def robust_z(value: str, past: str, days: str, params: Params = DEFAULTS) -> str:
    """(baseline, z): z = (x - median) / max(1.4826 MAD, 1) over all observed days, zeros included."""
    mad = series.median("transform(counts, c -> abs(c - center))")
    scale = f"greatest({series.number(params.mad_to_sigma)} * {mad}, {series.number(params.scale_floor)})"
    scored = f"named_struct('baseline', center, 'z', (cast({value} AS double) - center) / {scale})"
    around = series.bind("center", series.median("counts"), scored)
    return series.bind("counts", series.zero_padded(past, days), around)


def _with_scores(rows: DataFrame, passed: list[str], params: Params) -> DataFrame:
    """Scores of rows that hold their past counts (``past_*``) and ``history_days``.

    The threshold sees the exact z; only the stored value is rounded. With too little
    history there is no baseline: all null and nobody emerges. The scores leave one
    expression through ``inline``, so later filters stay above and each is evaluated once.
    """

    def score(metric: str) -> str:
        z = robust_z(metric, f"past_{metric}", "history_days", params)
        return f"CASE WHEN history_days >= {params.min_history_days} THEN {z} END"

    emerging = f"editors.z >= {series.number(params.z_threshold)} AND unique_editors >= {params.min_editors}"
    row = f"""named_struct(
        'baseline_editors', editors.baseline, 'is_emerging', coalesce({emerging}, false),
        'z_editors', {series.half_even("editors.z", 2)}, 'z_edits', {series.half_even("edits.z", 2)},
        'anomaly_score', {series.half_even("editors.z", 2)})"""
    scores = series.bind("editors", score("unique_editors"), series.bind("edits", score("edit_count"), row))
    return rows.select(*passed, "history_days", F.expr(f"inline(array({scores}))"))


def flag_emerging(
    today: DataFrame, history: DataFrame, days: Column | int, params: Params = DEFAULTS
) -> DataFrame:
    """Add history_days, baseline_editors, is_emerging, z_editors, z_edits and anomaly_score."""
    observed = F.lit(days).cast("int") if isinstance(days, int) else days
    known = today.join(article_history(history), ARTICLE, "left").withColumn("history_days", observed)
    return _with_scores(known, today.columns, params)


def days_before(volumes: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """day, history_days: how many observed days lie in the window before each day.

    Each observed day counts for the days after it, as many as a window is long; there are
    as many rows as days, whatever was observed on them.
    """
    after = F.sequence(F.date_add("day", 1), F.date_add("day", params.history_days))
    reached = volumes.select("day").distinct().select(F.explode(after).alias("day"))
    return reached.groupBy("day").agg(F.count("*").cast("int").alias("history_days"))


def flag_period(volumes: DataFrame, first: date, last: date, params: Params = DEFAULTS) -> DataFrame:
    """``flag_emerging`` for every day (a date) of a period, from one aggregate.

    ``volumes`` holds one row per day and article, from the first day's window on. A day's
    counts serve the scores of all days whose window it lies in: a range of days per
    article, which has at most one row per day, instead of one history per target day.
    """
    window = Window.partitionBy(*ARTICLE).orderBy(F.unix_date("day")).rangeBetween(-params.history_days, -1)
    known = volumes.withColumns({f"past_{m}": F.collect_list(m).over(window) for m in METRICS})
    scored = known.filter(F.col("day").between(F.lit(first), F.lit(last)))
    with_days = scored.join(days_before(volumes, params), "day", "left").fillna(0, ["history_days"])
    return _with_scores(with_days, volumes.columns, params)


def top_emerging(trending: DataFrame, limit: int = 10) -> DataFrame:
    """The most anomalous emerging articles."""
    return (
        trending.filter("is_emerging")
        .orderBy(F.desc("z_editors"), "edit_project", "title")
        .select(
            "title", "edit_project", "unique_editors", "baseline_editors", "z_editors", "pageviews", "language_count"
        )
        .limit(limit)
    )
