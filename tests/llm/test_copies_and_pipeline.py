"""Near-duplicates, fingerprints and the pipeline against plain Python."""

import hashlib
import os
import random

import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
from tidemark.llm import fingerprints, near_duplicates
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def components(docs):
    own = {i: sets(t) for i, t in docs}
    label = {i: i for i in own}
    linked = [(a, b) for a in own for b in own if a < b and own[a] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])]
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(own[i]), label[i]) for i in own}


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    word = lambda: "w" + str(pick.randrange(500))
    docs = []
    for group in range(6):
        base = [word() for _ in range(120)]
        for _ in range(12):
            copy = list(base)
            for _ in range(pick.randrange(5)):
                copy[pick.randrange(120)] = word()
            base = copy if group % 2 else base  # chains and stars
            docs.append(" ".join(copy))
    base = [word() for _ in range(120)]
    for most in [3] * 15 + [40] * 30:  # copies around one text, some too far from it to be linked, with words of their own
        copy = list(base)
        for _ in range(pick.randrange(most)):
            copy[pick.randrange(120)] = f"own{pick.randrange(60)}"
        docs += [" ".join(copy), " ".join([*copy[:110], "end", *copy[110:]])]
    docs += ["", None, "one two", "One  two", "one two", docs[0], docs[0].upper()]
    return list(enumerate(docs))


def test_near_duplicates(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id bigint, text string, digest string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates.clusters(docs).collect()}
    expected = components(texts)
    assert found == expected
    rows = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, "one two", "x")] * 2, docs.schema))
    kept = near_duplicates.deduplicated(rows)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(None) == 2
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in expected.values()})
    assert near_duplicates.clusters(docs.limit(0)).count() == 0


def test_fingerprints(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in fingerprints.compared(docs).collect()}
    for k, (i, t) in enumerate(texts):
        t, following = t or "", texts[(k + 1) % len(texts)][1] or ""
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and rows[i]["n_chars"] == len(t)
    prints = fingerprints.compared(docs)
    same = {(r["query"], r["fingerprint"]) for r in fingerprints.within(prints, prints, 3).collect()}
    values = {r["fingerprint"] for r in rows.values()}
    close = {(a, b) for a in values for b in values if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert same == close
    repeated = docs.union(docs.limit(2)).union(spark.createDataFrame([(None, None)], docs.schema))
    assert fingerprints.compared(repeated).count() == len(texts) + 3
    assert fingerprints.compared(docs.limit(0)).count() == 0


def test_every_query_is_registered():
    names = entry_points.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")
def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, FOLDER)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    whole = {}
    for r in pieces:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert all(whole[r["doc_id"]] == r["doc_tokens"] for r in pieces)


def test_shingles_hash_each_word_of_a_batch_once_and_give_memory_back(monkeypatch):
    """what workers held on to took an executor of the pipeline beyond its memory."""
    hashed, digest = [], near_duplicates.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(near_duplicates.xxhash, "xxh3_64_intdigest", lambda word, **seed: hashed.append(word) or digest(word, **seed))
    texts = ["a b c D e f", "A b\x0bc d e\x1cx", "", "a  B", "a b c d e f a b c d e f", "\x85", " \t"]
    found = near_duplicates.shingles(pa.array(["x", *texts]).slice(1))
    assert sorted(hashed) == sorted([b"a", b"b", b"c", b"d", b"e", b"f", b"e\x1cx", "\x85".encode(), b"a b", "\x85".encode()])
    assert [len(s) for s in found] == [len(sets(t)) for t in texts]
    assert all((s[1:] > s[:-1]).all() for s in found)
    assert set(found[0]) <= set(found[4]) and found[3][0] == digest(b"a b", seed=2)
    many = pa.array([" ".join(f"w{i}x{k}" for k in range(300)) for i in range(600)])
    assert len(near_duplicates.shingles(many)) == 600
    whole = near_duplicates.shingles(pa.array(texts * 100))
    assert len(whole) == 700 and all((a == b).all() for a, b in zip(whole, found * 100))
    released = []
    monkeypatch.setattr(near_duplicates.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: released.append(1)})())
    near_duplicates.shingles(many)
    assert released
