import glob
import json
import os
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import entities
from tidemark.session import WorkTables
from tidemark.sources import entities as landed

EN = "en.wikipedia.org"
EDGE = "project STRING, `from` STRING, `to` STRING"


def on_a_loop(renames):
    """Titles that lead back to themselves, off the powers of the matrix of renames."""
    names = sorted({*renames, *renames.values()})
    step = np.array([[renames.get(x) == y for y in names] for x in names], int)
    power, back = step, np.diag(step) > 0
    for _ in names:
        power = np.minimum(power @ step, 1)
        back |= np.diag(power) > 0
    return {x for x, loops in zip(names, back) if loops}


def test_batches_of_fifty(spark):
    titles = [f"T{i:03d}" for i in range(120)]
    data = [(EN, x) for x in titles] * 2 + [("fr.wikipedia.org", "Z"), ("fr.wikipedia.org", None)]
    random.Random(1).shuffle(data)
    out = entities.request_batches(spark.createDataFrame(data, "project STRING, title STRING").repartition(5)).collect()
    got = {(r["project"], r["batch"]): r["titles"] for r in out}
    assert got == {
        (EN, 0): titles[:50], (EN, 1): titles[50:100], (EN, 2): titles[100:], ("fr.wikipedia.org", 0): ["Z"],
    }


def test_positions_of_a_hot_project(spark):
    data = [(EN, f"{i * 7919 % 20011:06d}") for i in range(20011)] + [("de.wikipedia.org", f"{i:04d}") for i in range(50)]
    out = entities.numbered_titles(spark.createDataFrame(data, "project STRING, title STRING").repartition(8))
    wrong = [r for r in out.collect() if int(r["title"]) != r["position"]]
    assert wrong == [] and out.count() == 20061


def resolved(spark, query, titles):
    line = json.dumps({"project": EN, "status": 200, "titles": titles, "body": {"query": query}})
    return {r["title"]: r["wikidata_id"] for r in ids(spark, [line]).collect()}


def ids(spark, lines):
    from pyspark.sql import functions as F

    from tidemark import schemas

    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    return landed.ids_from_responses(df.select(F.from_json("value", schemas.ENTITY_RESPONSE).alias("r")).select("r.*"))


def page(title, qid=None):
    return {"title": title, "pageprops": {"wikibase_item": qid}} if qid else {"title": title}


def test_missing_page_and_page_without_id(spark):
    query = {"pages": [page("Plain mill"), {"title": "Lost mill", "missing": True}]}
    asked = ["Plain mill", "Lost mill", "Unasked mill"]
    assert resolved(spark, query, asked) == dict.fromkeys(asked)


def test_redirect_wins_over_normalisation(spark):
    query = {
        "normalized": [{"from": "a", "to": "Wrong"}], "redirects": [{"from": "a", "to": "Right"}],
        "pages": [page("Wrong", "Q1"), page("Right", "Q2")],
    }
    assert resolved(spark, query, ["a"]) == {"a": "Q2"}


def test_ids_are_text(spark):
    assert resolved(spark, {"pages": [page("30417", "620")]}, ["30417"]) == {"30417": "620"}


def chains(spark, renames):
    df = spark.createDataFrame([(EN, a, b) for a, b in renames.items()], EDGE)
    return {r["title"]: r["final"] for r in entities.resolve_chains(df).collect()}


def test_chains_loops_and_tails(spark):
    renames = {f"c{i}": f"c{i + 1}" for i in range(20)}
    renames |= {"self": "self", "x": "y", "y": "x", "t1": "t2", "t2": "x", "u": "self"}
    ends = {f"c{i}": "c20" for i in range(20)}
    assert chains(spark, renames) == ends | {"self": "self", "x": "x", "y": "y", "t1": "x", "t2": "x", "u": "self"}


def test_many_titles_leading_to_one(spark):
    renames = {f"r{i}": "hub" for i in range(3000)} | {"hub": "main"}
    got = chains(spark, renames)
    assert set(got.values()) == {"main"} and len(got) == 3001


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 24), min_size=1, max_size=22))
def test_any_rename_graph(spark, targets):
    renames = {f"n{i}": f"n{t}" for i, t in enumerate(targets)}
    ends, loops = chains(spark, renames), on_a_loop(renames)
    assert set(ends) == set(renames)
    for title, end in ends.items():
        # the end is no longer renamed or the loop's first title, and a title shares it with its target
        assert end not in renames or end in loops
        target = renames[title]
        assert end == (title if title in loops else target if target in loops else ends.get(target, target))


def test_bad_responses_are_named(spark, tmp_path):
    lines = [
        {"project": EN, "status": 200, "titles": ["A"], "body": {"query": {"pages": []}}},
        {"project": EN, "status": 429, "titles": ["A"]},
        {"project": EN, "status": 404, "titles": ["A"]},
        {"project": EN, "status": 200, "titles": ["A"], "body": {"error": {"code": "maxlag", "info": "slow"}}},
        {"project": EN, "status": 200, "titles": ["A"], "body": {"error": {"code": "badtoken"}}},
        {"project": EN, "status": 200, "titles": ["A"], "body": {"continue": {"x": "1"}}},
        {"project": EN, "status": 200, "titles": ["A"]},
    ]
    (tmp_path / "r.ndjson").write_text("\n".join(map(json.dumps, lines)))
    read = landed.read_responses(spark, str(tmp_path))
    assert rows(landed.response_problems(read), "problem", "retry") == [
        ("api badtoken", False), ("api maxlag", True), ("http 404", False), ("http 429", True),
        ("paged answer", False), ("unreadable body", True),
    ]
    with pytest.raises(landed.FailedResponses, match="http 429"):
        landed.require_usable(read)
    landed.require_usable(read.limit(0))


def test_settled_rows_leave_and_working_tables_go(spark):
    renames = {f"c{i}": f"c{i + 1}" for i in range(40)} | {f"d{i}": "c39" for i in range(60)} | {"x": "y", "y": "x", "z": "x"}
    work = WorkTables(spark, "chains-test")
    df = spark.createDataFrame([(EN, a, b) for a, b in renames.items()], EDGE)
    got = {r["title"]: r["final"] for r in entities.resolve_chains(df, work).collect()}
    assert got == {a: "c40" for a in renames if a not in "xyz"} | {"x": "x", "y": "y", "z": "x"}
    # the edges, then ever fewer rows until only the three that move forever are left
    followed = work.rows[1:work.rows.index(3) + 1]
    assert work.rows[0] == len(renames) and followed == sorted(followed, reverse=True) and len(set(followed)) == len(followed)
    left = sorted(os.path.relpath(f, work.root) for f in glob.glob(f"{work.root}/**/settled=*", recursive=True))
    assert left and not [f for f in left if f.endswith("false")]
    assert not [f for f in os.listdir(work.root) if f in ("steps", "leading-in", "loops-0")]


def test_removed_tables_are_gone(spark):
    work = WorkTables(spark, "one")
    frame = spark.range(3).select(F.lit("p").alias("project"), F.lit("n").alias("node"), F.lit("t").alias("to"))
    assert work.write(frame, "a", many=F.count_if(F.col("node") == "n")) == {"rows": 3, "many": 3}
    assert work.read("a", entities.POINTER).count() == 3
    work.remove("a")
    assert work.read("a", entities.POINTER).count() == 0
