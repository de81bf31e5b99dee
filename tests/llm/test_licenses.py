"""The licence index against a plain scan of every template at every place."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses

DRAW = random.Random(11)
POOL = [f"term{k}" for k in range(90)] + ["the", "of", "software", "licence", "warranty"]


def made_up(words, phrases):
    """A long text with its phrases somewhere within."""
    text = [DRAW.choice(POOL) for _ in range(words)]
    for k, phrase in enumerate(phrases):
        at = (k + 1) * words // (len(phrases) + 2)
        text[at:at] = phrase.split()
    return " ".join(text)


TEMPLATES = {
    "alpha": (made_up(700, ["alpha public grant"]), ("alpha public grant", "under the alpha terms")),
    "beta-1": (made_up(300, ["beta licence one"]), ("beta licence one",)),
    "beta-2": (made_up(310, ["beta licence two", "no warranty of beta"]), ("beta licence two",)),
    "short": ("short permission notice", ("short permission",)),
    "wordless": ("...", ("alpha public grant",)),
    "unproven": (made_up(50, []), ()),
}


def changed(text, share):
    return " ".join("other" if DRAW.random() < share else w for w in text.split())


def texts():
    alpha, one, two = (TEMPLATES[label][0] for label in ("alpha", "beta-1", "beta-2"))
    sentence = one.split()
    found = [None, "", "no licence here", alpha, one.upper(), f"{one}\n\n{two}", f"preface {changed(alpha, 0.2)} end"]
    found += [changed(two, share) + " beta licence two" for share in (0.3, 0.55, 0.7)]
    found += [alpha.replace("alpha public grant", "alpha private grant"), alpha.replace("alpha public grant", "") + " Under the Alpha terms."]
    found += [" ".join(sentence[:150] + ["inserted", "name"] + sentence[150:]), " ".join(sentence[200:]) + " beta licence one"]
    found += ["Short-Permission: notice; MIT License, mit license", "permission short notice", TEMPLATES["unproven"][0], "the of " * 3000 + two]
    return found


def expected(text, weights):
    words = licenses.words_of(text or "")

    def stands(phrase, at):
        return words[at:at + len(phrase)] == phrase

    def places(phrase):
        return [at for at in range(len(words)) if stands(licenses.words_of(phrase), at)]

    base = {label: places(phrase) for label, phrase in licenses.PHRASES.items()}
    shares = {}
    for label, (whole, phrases) in TEMPLATES.items():
        own = licenses.words_of(whole)
        best = sorted(set(own), key=lambda w: (-weights[w], w))[:licenses.INDEXED]
        kept = [(k, w) for k, w in enumerate(own) if w in set(best)]
        if not kept or not any(places(p) for p in phrases):
            continue
        agree = lambda at: sum(0 <= at + k < len(words) and words[at + k] == w for k, w in kept)
        share = max(agree(at) for at in range(-len(own), len(words))) / len(kept)
        if share >= licenses.LEAST_SHARE:
            shares[label] = share
    fixed = sorted(label for label, found in base.items() if found)
    score = 1.0 if fixed else max(shares.values(), default=0.0)
    return len(words), base, fixed, sorted({*fixed, *shares}), pytest.approx(score)


def test_index_equals_a_scan_of_every_place(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id int, text string").repartition(3)
    weights = licenses.rarity(docs, templates=TEMPLATES)
    assert len(weights) > licenses.INDEXED  # so that not all words are indexed
    rows = licenses.scanned(docs, weights, templates=TEMPLATES).collect()
    found = {r["doc_id"]: (r["n_words"], {k: sorted(v) for k, v in r["base"].asDict().items()}, r["base_labels"], r["labels"], r["score"]) for r in rows}
    assert len(rows) == len(texts_of := docs.collect())
    for r in texts_of:
        assert found[r["doc_id"]] == expected(r["text"], weights), r["doc_id"]
    every = {label for _, _, _, labels, _ in found.values() for label in labels}
    assert {"alpha", "beta-1", "beta-2", "short", "mit"} <= every and not {"wordless", "unproven"} & every


def test_templates_are_read_from_a_table(spark, tmp_path):
    rows = [(label, *TEMPLATES[label]) for label in TEMPLATES] + [(None, "x", ("y",)), ("empty", None, None)]
    spark.createDataFrame([(a, b, None if c is None else list(c)) for a, b, c in rows], "label string, text string, phrases array<string>").write.parquet(
        str(tmp_path / "templates")
    )
    assert licenses.read_templates(spark, str(tmp_path / "templates")) == TEMPLATES | {"empty": ("", ())}


def test_votes_needed_are_the_least_that_reach_the_share():
    for size in range(1, 400):
        templates = {"t": (" ".join(f"w{k}" for k in range(size)), ("w0",))}
        made = licenses.index({}, templates, indexed=size)
        needed = next(n for kind, label, _, n in made.entries if kind == licenses.WHOLE)
        assert needed == min(n for n in range(1, size + 1) if n / size >= licenses.LEAST_SHARE)


def test_other_columns_repeats_and_empty_tables(spark):
    own = ("hits", "keys", "found", "row", "whole", "word", "vote")
    schema = "text string, score string, " + ", ".join(f"{c} string" for c in own)
    docs = spark.createDataFrame([("MIT license", "own", *own)] * 3 + [(None, None, *own)], schema)
    rows = licenses.scanned(docs, licenses.rarity(docs)).collect()
    assert [[r[c] for c in own] for r in rows] == [list(own)] * 4
    assert sorted((r["n_words"], r["labels"], r["score"]) for r in rows) == [(0, [], 0.0)] + [(2, ["mit"], 1.0)] * 3
    none = docs.limit(0)
    assert licenses.scanned(none, licenses.rarity(none)).count() == 0


def test_a_text_of_a_million_words(spark):
    docs = spark.range(1).select(F.concat(F.repeat(F.lit("the license of mit "), 250_000), F.lit("MIT license")).alias("text"))
    row = licenses.scanned(docs, licenses.rarity(docs)).select("n_words", "labels", F.size("base.mit").alias("n")).first()
    assert (row["n_words"], row["labels"], row["n"]) == (1_000_002, ["mit"], 1)


def test_the_plan_does_not_grow_with_the_templates(spark):
    docs = spark.createDataFrame([("a",)], "text string")

    def size(templates):
        weights = dict.fromkeys(licenses.vocabulary(templates), 1.0)
        plan = licenses.scanned(docs, weights, templates=templates)._jdf.queryExecution().analyzed()
        return plan.toString().count("lambdafunction")

    assert size(licenses.TEMPLATES) == size(TEMPLATES) == size({**TEMPLATES, **licenses.TEMPLATES})
