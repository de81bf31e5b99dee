from __future__ import annotations

import itertools
import random
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import near_duplicates, ngram_join

SCHEMA = "doc_id bigint, text string"
SPACE = " \t\n\r\x0b\f"


def words_of(text):
    for c in SPACE:
        text = text.replace(c, " ")
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in lower.split(" ") if w]


def grams_of(text):
    words = words_of(text or "")
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def plain(docs):
    """All pairs with a common n-gram, and a union of the linked ones."""
    sets = [(i, grams_of(t)) for i, t in docs]
    distinct = list(dict.fromkeys(s for i, s in sets if s and i is not None))
    parent = list(range(len(distinct)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(distinct):
        for g in s:
            holders[g].append(k)
    common = defaultdict(int)
    for who in holders.values():
        for a, b in itertools.combinations(who, 2):
            common[a, b] += 1
    for (a, b), i in common.items():
        if 100 * i >= 80 * (len(distinct[a]) + len(distinct[b]) - i):
            parent[root(a)] = root(b)
    place = {s: k for k, s in enumerate(distinct)}
    least = {}
    for i, s in sets:
        if s and i is not None:
            r = root(place[s])
            least[r] = min(i, least.get(r, i))
    return sorted(((i, len(s), i if not s or i is None else least[root(place[s])]) for i, s in sets), key=repr)


def found(frame):
    rows = ngram_join.similar(frame).select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_test_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert found(docs) == plain([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_chains_stars_and_groups_near_the_threshold(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    docs = []
    for group in range(12):
        text = rng.choices(words, k=rng.choice([9, 30, 60, 120]))
        for member in range(15):
            changed = list(text)
            for _ in range(rng.randrange(4)):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            docs.append((1000 - len(docs), " ".join(changed)))
            if group % 3 == 0:
                text = changed  # a chain: ends may be far apart
    passage = " ".join(rng.choices(words, k=50))
    for k in range(60):
        docs.append((2000 + k, " ".join(rng.choices(words, k=rng.choice([3, 8, 12, 200]))) + " " + passage))
    rng.shuffle(docs)
    assert found(spark.createDataFrame(docs, SCHEMA).repartition(5)) == plain(docs)


def test_exactly_at_the_threshold(spark):
    # 8 of 10 n-grams in common, then 7 of 9
    base = [f"a{k}" for k in range(13)]
    docs = [(1, " ".join(base)), (2, " ".join(base[:12] + ["x"])), (3, " ".join(base[:11] + ["y", "z"]))]
    assert found(spark.createDataFrame(docs, SCHEMA)) == plain(docs)


def test_nulls_short_texts_and_repeats(spark):
    docs = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three four five"), (None, "one two"),
        (7, "one two three four five"), (7, "one two three four five"), (8, "other"), (8, "text of its own"), (4, "one two"),
        (9, "İ b c d e"), (10, "i̇ b c d e"), (11, "a b c d e f"),
    ]
    frame = spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit("x") for c in ("number", "label", "size", "digest", "grams", "id")})
    assert found(frame) == plain(docs)


def test_no_document(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_very_long_text(spark):
    long = " ".join(str(k % 70_000) for k in range(300_000))
    docs = [(1, long), (2, long + " end"), (3, "short")]
    assert [r[2] for r in found(spark.createDataFrame(docs, SCHEMA))] == [1, 1, 3]


def test_members_far_apart_make_no_pairs(spark):
    """Near copies of one text, each with too many other changes than any other: their pairs are not made."""
    size, members = 100, 60
    base = list(range(size))
    sets = []
    for number in range(members):
        gone = random.Random(number).sample(base, 9)
        sets.append((number, number, size, sorted(set(base) - set(gone)) + [1000 + 100 * number + k for k in range(9)]))
    mixed = lambda x: (x * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63)
    frame = spark.createDataFrame(
        [(n, label, s, [mixed(g) for g in grams]) for n, label, s, grams in sets],
        "number bigint, label bigint, size bigint, grams array<bigint>",
    )
    still_open = ngram_join._open_sets(frame, "open-sets")
    pairs = ngram_join._all_partners(ngram_join._buckets(still_open), still_open)
    enough = lambda a, b: 180 * len(a & b) >= 80 * 2 * size
    own = {n: set(grams) for n, _, _, grams in sets}
    linked = {p for p in itertools.combinations(own, 2) if enough(own[p[0]], own[p[1]])}
    met = {tuple(r) for r in pairs.select("a", "b").collect()}
    assert still_open.count() == members and linked <= met
    assert len(met) <= len(linked) + members


def test_sets_of_a_batch_hash_each_word_once(monkeypatch):
    """hashing every place of every text twice took most of the CPU time beyond the budget."""
    hashed, digest = [], near_duplicates.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(near_duplicates.xxhash, "xxh3_64_intdigest", lambda word, **seed: hashed.append(word) or digest(word, **seed))
    texts = pa.array(["a b c d e f g", "A B C d e f g a b", "", "b a"])
    signed, whole = (of(texts).to_pylist() for of in (ngram_join._signed, ngram_join._all_fragments))
    assert len(hashed) == 2 * (7 + 1) and [s["size"] for s in signed] == [3, 5, 0, 1]
    assert [s["digest"] for s in signed] == [s["digest"] for s in whole] and signed[2]["digest"] is None
    for one, every in zip(signed, whole):
        unsigned = [g % 2**64 for g in every["grams"]]
        assert len(unsigned) == one["size"] and unsigned == sorted(unsigned)
        assert one["grams"] == [g for g, u in zip(every["grams"], unsigned) if u < 2**62]
    assert set(whole[0]["grams"]) <= set(whole[1]["grams"])
