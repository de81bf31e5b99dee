"""Gates: obviously wrong data stops here, before anything is written.

A gate is a small DataFrame of rules (rule, value, threshold, ok, detail), so it can be
queried like any result; ``enforce`` turns failed rules into an error naming them all.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import between_days
from tidemark.params import DEFAULTS, Params

RULE_COLUMNS = ["rule", "value", "threshold", "ok"]


class DataQualityError(RuntimeError):
    """Data too wrong to pass on."""


def _rule(name: str | Column, value: Column, threshold: float, ok: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        label.alias("rule"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    )


def edit_metrics(edits: DataFrame, day: date) -> DataFrame:
    """Edits per project and how many are dated on the day, in one pass."""
    dated = between_days(F.col("timestamp_utc"), day, day)
    return edits.groupBy("project").agg(F.count("*").alias("edits"), F.count_if(dated).alias("in_day"))


def edit_rules(edits: DataFrame, day: date, params: Params = DEFAULTS) -> DataFrame:
    """Enough edits, every tracked project present, nearly all dated on the day."""
    present = [
        F.coalesce(F.sum(F.when(F.col("project") == p, F.col("edits"))), F.lit(0)).alias(p)
        for p in params.edit_projects
    ]
    summary = edit_metrics(edits, day).agg(
        F.coalesce(F.sum("edits"), F.lit(0)).alias("total"),
        F.coalesce(F.try_divide(F.sum("in_day"), F.sum("edits")), F.lit(0.0)).alias("share"),
        *present,
    )
    rules = [
        _rule("daily_edits", F.col("total"), params.min_daily_edits, F.col("total") >= params.min_daily_edits),
        _rule("in_day_share", F.col("share"), params.min_in_day_share, F.col("share") >= params.min_in_day_share),
        *[
            _rule(f"edits:{p}", F.col(f"`{p}`"), 1, F.col(f"`{p}`") > 0)
            for p in params.edit_projects
        ],
    ]
    return summary.select(F.inline(F.array(*rules))).select(*RULE_COLUMNS)


def missing_projects(seen: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Tracked projects without a single row."""
    names = F.array(*[F.lit(p) for p in params.edit_projects])
    expected = seen.sparkSession.range(1).select(F.explode(names).alias("project"))
    return expected.join(seen.select("project").distinct(), "project", "left_anti")


def view_match(trending: DataFrame) -> DataFrame:
    """Share of edited articles that were read, per project."""
    return trending.groupBy("edit_project").agg(
        F.avg((F.col("pageviews") > 0).cast("double")).alias("view_match"), F.count("*").alias("articles")
    )


def trending_rules(trending: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Views found, one row per article, few emerging. An empty day passes.

    Articles are combined per (project, title) first and per project next, so one pass
    over the day yields every rule.
    """
    per_article = trending.groupBy("edit_project", "title").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("pageviews") > 0).alias("viewed"),
        F.count_if("is_emerging").alias("emerging"),
    )
    per_project = per_article.groupBy("edit_project").agg(
        F.sum("rows").alias("rows"),
        F.sum("viewed").alias("viewed"),
        F.sum("emerging").alias("emerging"),
        F.sum(F.col("rows") - 1).alias("duplicates"),
    )
    share = F.col("viewed") / F.col("rows")
    matches = per_project.select(
        F.inline(
            F.array(
                _rule(
                    F.concat(F.lit("view_match:"), F.col("edit_project")),
                    share, params.min_view_match, share >= params.min_view_match,
                )
            )
        )
    )
    whole = per_project.agg(
        F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates"),
        F.coalesce(F.try_divide(F.sum("emerging"), F.sum("rows")), F.lit(0.0)).alias("share"),
    ).select(
        F.inline(
            F.array(
                _rule("duplicate_articles", F.col("duplicates"), 0, F.col("duplicates") == 0),
                _rule(
                    "emerging_share", F.col("share"), params.max_emerging_share,
                    F.col("share") <= params.max_emerging_share,
                ),
            )
        )
    )
    return matches.unionByName(whole).select(*RULE_COLUMNS)


def id_rules(ids: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Enough articles with an entity id; no article at all counts as none."""
    rate = F.coalesce(F.avg(F.col("wikidata_id").isNotNull().cast("double")), F.lit(0.0))
    return (
        ids.agg(rate.alias("rate"))
        .select(F.inline(F.array(_rule("id_rate", F.col("rate"), params.min_id_rate, F.col("rate") >= params.min_id_rate))))
        .select(*RULE_COLUMNS)
    )


def enforce(rules: DataFrame, layer: str) -> None:
    """Raise with every failed rule; only the rules, a handful of rows, reach the driver."""
    failed = rules.filter(~F.col("ok")).orderBy("rule").collect()
    if failed:
        lines = [f"{r['rule']} is {r['value']:g} (limit {r['threshold']:g})" for r in failed]
        raise DataQualityError(f"{layer}: " + "; ".join(lines))
