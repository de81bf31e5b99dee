"""Landed entity lookups: one JSON response per line with its project, status and titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.entities import distinct_ids, renames, resolve_ids


class FailedResponses(RuntimeError):
    """At least one landed response cannot be used."""


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ENTITY_RESPONSE).json(path)


def response_problems(responses: DataFrame) -> DataFrame:
    """Responses that must not pass silently, with whether asking again makes sense.

    Too many requests, server errors, lagging replicas and unreadable bodies are
    temporary; other statuses, API errors and paged answers are not.
    """
    code = F.col("body.error.code")
    problem = (
        F.when((F.col("status") == 429) | (F.col("status") >= 500), F.concat(F.lit("http "), F.col("status").cast("string")))
        .when(F.col("status") >= 400, F.concat(F.lit("http "), F.col("status").cast("string")))
        .when(F.col("body").isNull(), F.lit("unreadable body"))
        .when(code.isNotNull(), F.concat(F.lit("api "), code))
        .when(F.col("body.continue").isNotNull(), F.lit("paged answer"))
    )
    retry = (
        (F.col("status") == 429)
        | (F.col("status") >= 500)
        | ((F.col("status") < 400) & F.col("body").isNull())
        | F.coalesce(code == "maxlag", F.lit(False))
    )
    return (
        responses.select("project", problem.alias("problem"), retry.alias("retry"))
        .filter(F.col("problem").isNotNull())
        .groupBy("project", "problem", "retry")
        .agg(F.count("*").alias("responses"))
    )


def require_usable(responses: DataFrame) -> None:
    """Fail when a response is in error; the summary has one row per project and kind of problem, and names all."""
    rows = response_problems(responses).orderBy(F.desc("responses"), "project", "problem").collect()
    if rows:
        raise FailedResponses("; ".join(f"{r['project']}: {r['problem']} x{r['responses']}" for r in rows))


def unanswered_titles(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """project, title: what was asked for and is in no landed response."""
    asked = requests.select("project", F.explode("titles").alias("title")).distinct()
    return asked.join(requested_titles(responses), ["project", "title"], "left_anti")


def require_answered(requests: DataFrame, responses: DataFrame) -> None:
    """Fail when a requested title has no answer; names how many per project, and the first of them."""
    lacking = unanswered_titles(requests, responses).groupBy("project").agg(
        F.count("*").alias("titles"), F.min("title").alias("first")
    )
    rows = lacking.orderBy("project").collect()
    if rows:
        raise FailedResponses("; ".join(f"{r['project']}: {r['titles']} unanswered, first {r['first']}" for r in rows))


def requested_titles(responses: DataFrame) -> DataFrame:
    return responses.select("project", F.explode("titles").alias("title")).distinct()


def response_renames(responses: DataFrame) -> DataFrame:
    """All renames of all responses, redirects winning."""
    return renames(
        responses.select("project", F.inline("body.query.normalized")),
        responses.select("project", F.inline("body.query.redirects")),
    )


def response_pages(responses: DataFrame) -> DataFrame:
    pages = responses.select("project", F.explode("body.query.pages").alias("page"))
    return pages.select(
        "project", F.col("page.title").alias("title"), F.col("page.pageprops.wikibase_item").alias("wikidata_id")
    )


def ids_from_responses(responses: DataFrame) -> DataFrame:
    """(project, title, wikidata_id) for every title asked for."""
    return distinct_ids(
        resolve_ids(requested_titles(responses), response_renames(responses), response_pages(responses))
    )
