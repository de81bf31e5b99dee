"""Entity ids: request batches, redirect chains, ids per edited title."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import join_under_skew, numbered
from tidemark.params import DEFAULTS, Params
from tidemark.session import WorkTables

TITLE = ["project", "title"]
POINTER = T.StructType([T.StructField(c, T.StringType()) for c in ("project", "node", "to")])


def numbered_titles(articles: DataFrame) -> DataFrame:
    """Distinct titles with their zero-based position in title order within the project."""
    return numbered(articles.filter(F.col("title").isNotNull()).select(*TITLE).distinct(), "project", ["title"])


def request_batches(articles: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Lookup requests: each project's titles in order, ``batch_size`` at a time."""
    return (
        numbered_titles(articles)
        .groupBy("project", F.floor(F.col("position") / params.batch_size).alias("batch"))
        .agg(F.array_sort(F.collect_list("title")).alias("titles"))
    )


def renames(normalized: DataFrame, redirects: DataFrame) -> DataFrame:
    """Union of both rename lists (project, from, to); a redirect wins over a normalisation."""
    both = normalized.select("project", "from", "to", F.lit(0).alias("priority")).unionByName(
        redirects.select("project", "from", "to", F.lit(1).alias("priority"))
    )
    return both.groupBy("project", "from").agg(F.max(F.struct("priority", "to")).alias("last")).select(
        "project", "from", F.col("last.to").alias("to")
    )


def _settle(work: WorkTables, name: str, steps: DataFrame) -> tuple[list[DataFrame], str | None]:
    """Follow every pointer (project, node, to) to its end: settled nodes, and the table of those that never settle.

    Each round a moving pointer takes over where the node it points at has got to, so it
    gets twice as far. One that reaches an end, or a node that has settled, is settled and
    is not read as moving again: it is written once, and only the moving rest is written
    anew. Every round settles some as long as any can; once none does, the rest move
    forever, on a loop or into one. That takes as many rounds as the logarithm of the
    longest chain.
    """
    settled: list[DataFrame] = []
    moving, before, turn = steps, -1, 0
    while True:
        reached = moving.select("project", F.col("node").alias("to"), F.col("to").alias("on"), F.lit(False).alias("ended"))
        for part in settled:
            reached = reached.unionByName(
                part.select("project", F.col("node").alias("to"), F.col("to").alias("on"), F.lit(True).alias("ended"))
            )
        followed = join_under_skew(moving, reached, ["project", "to"]).select(
            "project", "node", F.coalesce("on", "to").alias("to"), (F.col("on").isNull() | F.col("ended")).alias("settled")
        )
        part = f"{name}-{turn}"
        left = work.write(followed, part, by="settled", moving=F.count_if(~F.col("settled")))["moving"]
        if turn:
            work.remove(f"{name}-{turn - 1}/settled=false")
        settled.append(work.read(f"{part}/settled=true", POINTER))
        if left in (0, before):
            return settled, f"{part}/settled=false" if left else None
        moving, before, turn = work.read(f"{part}/settled=false", POINTER), left, turn + 1


def _loop_nodes(work: WorkTables, endless: DataFrame) -> DataFrame:
    """Nodes on a loop: where endless pointers land once the landing places stop getting fewer.

    Only pointers between landing places go on, each round twice as far.
    """
    steps, before, turn = endless, -1, 0
    while True:
        places = steps.select("project", F.col("to").alias("node")).distinct()
        ahead = steps.select("project", F.col("node").alias("to"), F.col("to").alias("on"))
        kept = steps.join(places, ["project", "node"], "left_semi")
        doubled = join_under_skew(kept, ahead, ["project", "to"]).select("project", "node", F.col("on").alias("to"))
        count = work.write(doubled, f"loops-{turn}")["rows"]
        if turn:
            work.remove(f"loops-{turn - 1}")
        steps = work.read(f"loops-{turn}", POINTER)
        if count == before:
            return steps.select("project", "node")
        before, turn = count, turn + 1


def _united(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def resolve_chains(edges: DataFrame, work: WorkTables | None = None) -> DataFrame:
    """(project, from, to) with one ``to`` per ``from``: the end of every chain as (project, title, final).

    A walk into a loop stops at the first title it meets again, the loop's entry. So the
    edges leaving loop titles are taken away and the same doubling then ends there. Of the
    tables written on the way, only those that hold the result stay.
    """
    work = work or WorkTables(edges.sparkSession, "chains")
    work.write(edges.select("project", F.col("from").alias("node"), "to"), "steps")
    steps = work.read("steps", POINTER)
    ends, endless = _settle(work, "ends", steps)
    if endless is not None:
        moving = work.read(endless, POINTER)
        on_loop = _loop_nodes(work, moving)
        leading_in = steps.join(moving, ["project", "node"], "left_semi").join(on_loop, ["project", "node"], "left_anti")
        work.write(leading_in, "leading-in")
        work.remove(endless)
        at_entry, _ = _settle(work, "entries", work.read("leading-in", POINTER))
        ends += [*at_entry, on_loop.select("project", "node", F.col("node").alias("to"))]
        work.remove("leading-in")
    work.remove("steps")
    return _united(ends).select("project", F.col("node").alias("title"), F.col("to").alias("final"))


def resolve_ids(titles: DataFrame, edges: DataFrame, pages: DataFrame) -> DataFrame:
    """The id of the page each title leads to; null for a missing page or one without id."""
    found = pages.groupBy("project", F.col("title").alias("final")).agg(F.max("wikidata_id").alias("wikidata_id"))
    led = titles.select(*TITLE).join(resolve_chains(edges), TITLE, "left")
    ends = led.select(*TITLE, F.coalesce("final", "title").alias("final"))
    return join_under_skew(ends, found, ["project", "final"]).select(*TITLE, "wikidata_id")


def distinct_ids(ids: DataFrame) -> DataFrame:
    """One row per article, ids as text."""
    return ids.groupBy(*TITLE).agg(F.min(F.col("wikidata_id").cast("string")).alias("wikidata_id"))
