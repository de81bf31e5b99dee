from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie
from tidemark.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id bigint, turn int, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """The same over lists in memory."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])  # % as in SQL
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, who in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(who) - 1) * len(key[-1][1].encode()) if key else 0
    return sorted(
        (min(who), len(key), min(members[key[:-1]]) if key else None, len(who), children[key], leaves[key], saved[key],
         hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest())
        for key, who in members.items()
    )


def found(spark, frame, tmp_path, name="t"):
    frame.write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    rows = QUERIES["op11_conversation_trie"](spark, f"{tmp_path}/{name}").collect()
    return sorted(tuple(r[c] for c in COLUMNS) for r in rows)


def test_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_conversation_trie"](spark, folder).collect())
    assert got == plain(rows)


def test_sql_agrees(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    columns = ", ".join(COLUMNS)
    want = sorted(con.execute(f"SELECT {columns} FROM ({ORACLE['op11_conversation_trie']})").fetchall())
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_conversation_trie"](spark, folder).collect())
    assert got == want


def test_nulls_repeats_copies_and_turnless(spark, tmp_path):
    data = [(None, 0, "user", "nobody's")]
    for c in range(-12, 40):
        for t in range(abs(c) % 7 + 1):
            data.append((c, None if t == 3 else t, "user" if t % 2 == 0 else None, None if t == 1 else f"text {t if c % 3 else c}"))
    data += [(50, 1, "user", "again")] * 6 + [(51, 0, "user", "alone")]
    frame = spark.createDataFrame(data, SCHEMA).withColumns({"part": F.lit("p"), "place": F.lit(1), "depth": F.lit(1), "weight": F.lit(2)})
    assert found(spark, frame, tmp_path) == plain(data)


def test_long_conversation_in_many_parts(spark, tmp_path):
    data = [(10, t, "user", f"turn {t % 13}") for t in range(600)]
    data += [(c, t, "user", f"turn {t % 13}") for c in (11, 12, 14) for t in range(300)]
    data += [(c, 0, "user", "turn 0") for c in range(20, 60)]
    frame = spark.createDataFrame(data, SCHEMA).repartition(16)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = conversation_trie.ordered_turns(frame, "conv_id", "turn", "role", "text")
        assert turns.filter("conv = 10").select("part").distinct().count() > 1
        assert found(spark, frame, tmp_path) == plain(data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_long_end_list(spark, tmp_path):
    data = [(5 * c, 0, "user", "same") for c in range(3000)]
    assert found(spark, spark.createDataFrame(data, SCHEMA), tmp_path) == plain(data)


@pytest.mark.parametrize("data", [[], [(None, 0, "user", "x")]])
def test_no_conversation(spark, tmp_path, data):
    assert found(spark, spark.createDataFrame(data, SCHEMA), tmp_path) == []


def test_same_turn_number_has_one_order(spark, tmp_path):
    data = [(c, 1, "user", f"tie {k}") for c in (0, 5, 10) for k in range(4)]
    first = found(spark, spark.createDataFrame(data, SCHEMA), tmp_path, "a")
    assert first == found(spark, spark.createDataFrame(data[::-1], SCHEMA).repartition(3), tmp_path, "b")
    assert [r[3] for r in first] == [3] * 5
