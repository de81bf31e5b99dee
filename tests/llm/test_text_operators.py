"""Corpus operators against libraries and plain Python, on texts made to be awkward."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, grader, licenses, near_duplicates, outliers, packing, personal_data, site_tree, suffix_tree

PATTERN = public_tokenizers.PATTERN
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "the cat sat", "", None, "  two  spaces \n\n", "x" * 3000, "é'. 漢😀 it's\x1c\x85\xa0 don't.", "a\ttab\x0b and\x0cmore", "eé'. a's*** b!!",
    "mail me.x@mail.example.com or +1 (555) 010-2030, 10.0.0.300 and 10.0.0.30", "card 4111 1111 1111 1111 4111111111111112",
    "Released under the MIT License. mit-license APACHE license, General Public License",
    'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"', "same words here again now same words here again now", "the cat sat",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 5 else None, t, "en" if i % 2 else None, "s", "own") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, ids string")


def by_text(df, *columns):
    return {r["text"]: tuple(r[c] for c in columns) for r in df.select("text", *columns).collect()}


def test_bpe_equals_the_library_and_decodes(docs):
    ranks = bpe.codec(BYTES, PATTERN).vocabulary.ranks
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text, (ids, back) in by_text(bpe.round_trip(docs, BYTES, PATTERN), "ids", "decoded").items():
        assert ids == library.encode_ordinary(text or "") and bytes(back) == (text or "").encode()
    assert bpe.encode(docs.limit(0), BYTES, PATTERN).count() == 0


def test_bpe_appends_and_edits_exactly():
    vocabulary = bpe.codec(BYTES, PATTERN).vocabulary
    whole = bpe.Prefixes(vocabulary, b"an exact ").append(b"appending of bytes")
    assert whole.ids() == bpe.Prefixes(vocabulary, b"an exact appending of bytes").ids()
    long = b"prefix dynamic programming keeps the last token of all prefixes " * 8
    edited = bpe.Prefixes(vocabulary, long)
    done = edited.replace(7, 14, b"static")
    assert edited.ids() == bpe.Prefixes(vocabulary, long[:7] + b"static" + long[14:]).ids() and done < len(long) / 2


def test_packing_loses_nothing(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    expected = Counter(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,) for t in TEXTS)
    pieces = packing.pack(docs.select("doc_id", "text"), WORDS, window=16).collect()
    place = {r["sequence_id"] * 16 + r["offset"]: r for r in pieces}
    at, found, own = 0, Counter(), ()
    while at in place:
        r = place[at]
        ids = tuple(np.frombuffer(r["ids"], np.uint32).tolist())
        assert len(ids) == r["length"] and r["start"] == len(own) and r["offset"] + r["length"] <= 16
        own, at = own + ids, at + r["length"]
        if len(own) == r["doc_tokens"]:
            found[own] += 1
            own = ()
    assert found == expected and at == sum(r["length"] for r in pieces)
    assert packing.pack(docs.limit(0), WORDS).count() == 0


def test_statistics_and_base_rule(docs):
    rows = by_text(outliers.with_statistics(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert rows[None] == rows[""] == (0, 0, 0, 0, 0)
    assert rows["same words here again now same words here again now"] == (10, 42, 0, 0, 10)
    assert outliers.repeated_words(b"a b c d e f a b c d e".split()) == 10
    assert outliers.statistics_of("x *\nx *\n\n\nx *")[2:4] == (3, 2)


def test_outliers_leave_usual_texts(spark):
    usual = [(i, " ".join(f"word{(i * 7 + k) % 97}{k}" for k in range(60)), "en", None) for i in range(300)]
    odd = [(1000 + i, " ".join("$$$***" + "|" * k for k in range(30)), "en", None) for i in range(5)]
    docs = spark.createDataFrame(usual + odd + [(None, None, None, None)], "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"] for r in outliers.accepted(docs).collect()}
    assert kept == set(range(300))
    assert outliers.judged(docs.limit(0)).count() == 0


def test_grader_learns_order(spark):
    good = [(i, f"calm words about nature number {i % 13} end", 1, 0) for i in range(150)]
    poor = [(200 + i, f"BAD!! LOUD!! SHOUT!! TEXT{i % 11}!!", 0, 0) for i in range(80)]
    foul = [(400 + i, f"calm words you awfulname number {i % 13}", 1, 1) for i in range(80)]
    rows = good + poor + foul
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows] + [(1, None, None)], "doc_id bigint, quality int, toxic int")
    model = grader.fit(docs, labels)
    kept = {r["doc_id"] for r in grader.accepted(docs, model).collect()}
    assert set(range(150)) <= kept and not kept & {r[0] for r in poor + foul}
    assert list(model.thresholds) == sorted(model.thresholds)
    assert grader.fit(docs, labels.limit(0)) is None
    assert grader.graded(docs, None).filter("kept").count() == len(rows) + 1


def base_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(digits):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0

    found = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": True, "ip": kind != "ip" or all(int(p) < 256 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def test_personal_data_base_spans(spark, docs):
    more = ["a@b.com_x@y.com", "1.2.3.4.5.6.7.8", "😀 a@b.co", "+1 234 567 890+12345678901", "4111-1111-1111-1111 " * 3, "1" * 5000, "a@b.co " * 200]
    every = docs.select("text").union(spark.createDataFrame([(t,) for t in more], "text string"))
    model = personal_data.fit(every)
    for text, (base, spans) in by_text(personal_data.with_spans(every, model), "base", "spans").items():
        assert [tuple(x) for x in base] == base_spans(text or "")
        assert {tuple(x) for x in base} <= {tuple(x) for x in spans}
    clean = personal_data.redacted(docs, None)
    assert clean.columns == docs.columns
    assert any("[EMAIL]" in (r["text"] or "") and "@" not in r["text"] for r in clean.collect())
    assert personal_data.fit(docs.limit(0)) is None


def test_license_phrases(docs):
    found = by_text(licenses.scanned(docs, licenses.rarity(docs)), "n_words", "base", "base_labels", "labels", "score")
    n, base, fixed, labels, score = found[TEXTS[10]]
    assert (n, fixed, score) == (12, ["apache", "gpl", "mit"], 1.0) and set(fixed) <= set(labels)
    assert base.asDict() == {"mit": [3, 5], "apache": [7], "gpl": [9]}
    assert found[None][0] == 0 and found[None][3] == [] and found["the cat sat"][4] == 0.0


def test_suffix_tree_scores_all(spark, docs):
    rows = {r["doc_id"]: r for r in suffix_tree.scored(docs).collect()}
    train = Counter()
    for i, t in enumerate(TEXTS):
        if i == 5 or zlib.crc32(str(i).encode()) % 7 != 2:
            train.update((t or "").encode().lower().split() + [b""])
    n, v = sum(train.values()), len(train)
    for i, t in enumerate(TEXTS):
        own = (t or "").encode().lower().split() + [b""]
        r = rows[i if i != 5 else None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(x in train for x in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((train[x] + 1) / (n + v + 1)) for x in own), rel_tol=1e-9)
        assert r["score"] < 0


def test_grown_states_sum_to_one(spark):
    pick = np.random.default_rng(3)
    texts = [" ".join(f"{w}{k % 3}" for k in pick.integers(0, 7, 12) for w in ("a", "b", "c"[: k % 2 + 1])) for _ in range(80)]
    coded = F.arrow_udf(suffix_tree.coded, "array<bigint>")("text").alias("tokens")
    training = spark.createDataFrame([(t,) for t in texts], "text string").select(coded)
    counted = suffix_tree.counts(training)
    words = suffix_tree.learned(counted)
    tree = {r["key"]: r["value"] for r in suffix_tree.grow(training, counted, words, gain=1.0, part=0.5, depth=2).collect()}
    following = np.append(words.keys, 12345)  # and one never seen
    root = np.log10(np.append(words.counts * words.each, words.unseen))
    states = {1: 0, 2: 0}
    for context in [(x, y) for x in words.keys for y in words.keys]:
        flat = np.array([x for last in following for x in (*context, last)])
        score = root.copy()
        for k, (_, before, whole, _) in enumerate(suffix_tree.runs(flat, np.full(len(following), 3), 2), 1):
            state, kept = (x.reshape(len(following), -1)[:, -1] for x in (suffix_tree.state_key(before), whole))
            states[k] += int(state[0]) in tree
            score += [tree.get(int(s), 0.0) + tree.get(int(w), 0.0) for s, w in zip(state, kept)]
        assert math.isclose((10.0**score).sum(), 1.0, rel_tol=1e-9)
    assert min(states.values()) > 0


def test_site_tree(spark):
    page = (
        "<html><head><title>t</title><script>var t='</p><p>no';</script></head><body><nav><ul><li>menu</ul></nav>"
        "<div class='ad'>buy</div><article><h1>T &amp; X</h1><p><b>one\n two<br>three<p>four<div class=comments>hey</div></article>"
        "<footer>f</footer></body></html>"
    )
    plain = lambda k: f"<body><div class=top>Always the same line</div><div class=body>Story {k} of today</div></body>"
    rows = [(0, "http://a.b/x", page, "own"), (1, None, None, "own"), (2, "http://q/", "", "own")]
    rows += [(10 + k, "https://news.site/p", plain(k), "own") for k in range(8)] + [(30, "https://news.site/p", plain(0), "own")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = {r["page_id"]: r["text"] for r in site_tree.extracted(pages).collect()}
    assert found[0] == "T & X\n\none two three\n\nfour" and found[1] == found[2] == ""
    assert all(found[10 + k] == f"Story {k} of today" for k in range(8)) and found[30] == found[10]
    assert site_tree.extracted(pages.limit(0)).count() == 0


def test_site_tree_judges_inside_and_outside_articles(spark):
    told = lambda k: (
        f"<body><article><p>Story {k}</p><div class=box>Tell a friend</div></article><div class=top>Our town</div></body>"
    )
    teased = lambda k: f"<body><article><p>Read more</p></article><div class=story>Long story {k}</div></body>"
    copied = lambda k: f"<body><div class=ad>buy {k}</div><article><p>One text for all</p></article></body>"
    mostly = lambda k: f"<body><div class=now>It is {k}</div><article><p>{'Rare text' if k == 7 else 'Usual text'}</p></article></body>"
    hosts = [told, teased, copied, mostly]
    rows = [(100 * h + k, f"https://h{h}/", page(k)) for h, page in enumerate(hosts) for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"] for r in site_tree.extracted(pages).collect()}
    assert all(found[k] == f"Story {k}" and found[100 + k] == f"Long story {k}" for k in range(20))
    assert all(found[200 + k] == "One text for all" for k in range(20))  # pages that differ in adverts only are one page
    assert found[300] == "It is 0" and found[307] == "It is 7\n\nRare text"


def test_suffix_tree_learns_rare_words_and_long_contexts(spark):
    # words far down in frequency, whose next one is settled by three tokens and not by two
    filler = [(i, " ".join(f"w{(i * 97 + j) % 9000}" for j in range(900))) for i in range(60)]
    told = [(1000 + i, f"rare{i % 2} odd even {'left' if i % 2 else 'right'}") for i in range(200)]
    docs = spark.createDataFrame(filler + told + [(5000, "rare1 odd even left"), (5001, "rare0 odd even left")], "doc_id bigint, text string")
    score = lambda **depth: {r["doc_id"]: r["score"] for r in suffix_tree.scored(docs, **depth).collect()}
    deep, flat = score(), score(depth=2)
    assert deep[5000] > deep[5001] + 1 and abs(flat[5000] - flat[5001]) < 0.5
    joined = score(cached=5)
    assert all(math.isclose(joined[k], deep[k], rel_tol=1e-9) for k in deep)


def test_a_collection_of_licenses_keeps_every_label(spark):
    text = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files. "
        "Redistribution and use in source and binary forms, with or without modification, are permitted. "
        "GNU General Public License version 3. GNU Lesser General Public License. Apache License, Version 2.0. CC BY-SA 4.0. CC BY-NC 4.0."
    )
    # every licence word of the others is more frequent than those of the first two
    usual = "GNU General Public License version 3, Lesser, Apache 2.0, CC BY-SA BY-NC 4.0"
    docs = spark.createDataFrame([(text,)] + [(usual,)] * 20, "text string")
    found = by_text(licenses.scanned(docs, licenses.rarity(docs)), "labels")[text][0]
    assert {"mit-text", "bsd", "gpl-3.0", "lgpl", "apache-2.0", "cc-by-sa", "cc-by-nc"} <= set(found)


def test_names_of_elements_do_not_drop_article_text(spark):
    page = (
        "<body><div id=comments>first!</div><article><section id='related-work'>Others did</section><h2 id=search>Search</h2>"
        "<div id=social-impact>People</div><p class=response-reply>She said</p><p>With <math><mi>x</mi><mo>=</mo><mn>2</mn></math> so"
        "<object data=a.svg>A <b>chart</b></object><canvas>drawn</canvas></p><div class='comment-list'>hey</div><div class=ad-slot>buy</div></article></body>"
    )
    story = lambda k: f"<body><article><p>Story {k}</p><div class=notice>Storm {k}</div><div class=related>More</div></article></body>"
    rows = [(0, "http://one/", page)] + [(10 + k, "http://many/", story(k)) for k in range(12)]
    found = {r["page_id"]: r["text"] for r in site_tree.extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[0] == "Others did\n\nSearch\n\nPeople\n\nShe said\n\nWith x=2 soA chartdrawn"
    assert all(found[10 + k] == f"Story {k}\n\nStorm {k}" for k in range(12))


def test_spelled_mail_is_found_in_any_case(spark):
    texts = [f"JOHN [{sign}] EXAMPLE [DOT] COM" for sign in ("AT", "At", "aT", "at")]
    found = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("found", personal_data.candidates(F.col("text")))
    assert all("spelled_mail" in {x["kind"] for x in r["found"]} for r in found.collect())


def test_packing_parts_words_as_the_library_does():
    """Every code point before a sign, whatever composing and lower case make of it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    texts = [f"{chr(c)}?)" for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000]
    texts += ["\u0130.", "1\u0130)", "a\u0130,", "x\u0958!", "\u0958", "\u03a3. \u03a3x"]
    found = packing.WordIds(WORDS).of(texts, 2)
    expected = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, f, e in zip(texts, found, expected) if np.frombuffer(f, np.uint32).tolist() != [*e.ids, 2]] == []


def test_remembered_words_stay_within_their_bytes_and_their_operator(monkeypatch):
    monkeypatch.setattr(common, "REMEMBERED_BYTES", 20_000)
    words = packing.WordIds(WORDS)
    assert words.of(["alpha beta"], 2) == packing.WordIds(WORDS).of(["alpha beta"], 2)
    texts = [" ".join(f"w{i}x{k}" for k in range(120)) for i in range(6)]
    assert [words.of([t], 2)[0] for t in texts] == words.of(texts, 2)  # more than there is room for, at once
    assert words.words.held <= words.words.most
    other = common.Recent("another")
    other.keep("a", 1)
    assert not words.words and other == {"a": 1}


def test_equal_candidates_are_one_span_and_unproven_ones_none(spark):
    texts = ["call 212-555-0142 now", "at 300.1.2.3 or 999.999.999.999", "from 10.0.0.1 on"]
    # a model that takes whatever it is asked about
    every = personal_data.Trees(9.0, (), {kind: 0.0 for kind in personal_data.KINDS})
    docs = spark.createDataFrame([(t, "own", "own") for t in texts], "text string, base string, spans string")
    found = {r["text"]: [(x["kind"], x["start"], x["end"]) for x in r["spans"]] for r in personal_data.with_spans(docs, every).collect()}
    assert len({x[1:] for x in found[texts[0]]}) == len(found[texts[0]]) > 0
    assert not [x for x in found[texts[1]] if x[0] == "ip"]
    assert [x for x in found[texts[2]] if x[0] == "ip"] == [("ip", 5, 13)]
    clean = personal_data.redacted(docs, every).filter("base = 'own' and spans = 'own'")
    assert clean.count() == len(texts)


def test_grader_weights_are_the_likeliest():
    """The penalised likelihood at the fit is not raised by any small step, by a plain rendering of it."""
    pick = np.random.default_rng(5)
    grades = pick.integers(0, 3, 200)
    held = [[f for f in range(4) if pick.random() < 0.2 + 0.15 * f * (g / 2)] for g in grades]
    row, feature = np.repeat(np.arange(200), list(map(len, held))), np.concatenate(held).astype(np.int64)
    weights, cuts = grader._descend(row, feature, 4, grades, rounds=3000, rate=0.02)

    def loss(weights, cuts):
        total = 0.15 * float(np.dot(weights, weights))
        for grade, own in zip(grades, held):
            score = sum(weights[f] for f in own)
            above = [1.0, *[1 / (1 + math.exp(cut - score)) for cut in cuts], 0.0]
            total -= math.log(above[grade] - above[grade + 1])
        return total

    best, theta = loss(weights, cuts), np.concatenate([weights, cuts])
    for k in range(len(theta)):
        for step in (-0.03, 0.03):
            moved = theta.copy()
            moved[k] += step
            assert loss(moved[:4], moved[4:]) > best - 1e-4


def test_grader_keeps_every_feature_that_passes():
    rows = [(k % 3, list(range(700 * (k % 3), 700 * (k % 3) + 700))) for k in range(60)]
    assert len(grader.fit_rows(rows).slots) == 2100


def test_outliers_leave_other_columns_alone(spark):
    own = ("key", "centre", "precision", "symbols", "upper", "repeats", "row", "text2")
    docs = spark.createDataFrame([(1, "some words", None, None, *own)], "doc_id int, text string, lang string, source string, " + ", ".join(f"{c} string" for c in own))
    row = outliers.judged(docs).first()
    assert [row[c] for c in own] == list(own) and row["n_words"] == 2 and not row["kept"]


def test_suffix_tree_shuffles_no_more_than_tells_a_run(spark, monkeypatch):
    """Context and what follows its first token tell the run, so its own hash is not shuffled beside them."""
    flat, sizes = np.arange(1, 8, dtype=np.int64), np.array([3, 4])
    for k, (_, context, whole, short) in enumerate(suffix_tree.runs(flat, sizes, 3), 1):
        assert (suffix_tree.whole(context.view(np.uint64), short.view(np.uint64), k).view(np.int64) == whole).all()
    counted, landed = [], suffix_tree.landed

    def watched(df, name):
        if name == "runs":
            counted.append(df._jdf.queryExecution().optimizedPlan().toString())
        return landed(df, name)

    monkeypatch.setattr(suffix_tree, "landed", watched)
    texts = spark.createDataFrame([(str(i), "a b c d e " * 8) for i in range(20)], "doc_id string, text string")
    assert suffix_tree.scored(texts).count() == 20
    sent = [line.split("), ")[-1] for plan in counted for line in plan.splitlines() if "MapInArrow" in line]
    assert len(sent) == suffix_tree.DEPTH and all("[context#" in x and "run#" not in x for x in sent), sent


def test_a_batch_of_words_is_kept_at_once_within_the_bound():
    words = common.Recent("batch", 1 / 1024)
    first = {b"w%d" % k: b"0123" for k in range(300)}
    words.keep_all(first)
    held = words.held
    assert words == first and held == common._held(first, first.values()) <= words.most
    more = {b"x%d" % k: b"0123" for k in range(400)}
    words.keep_all(more)
    assert words == more and words.held <= words.most
    words.keep_all({b"y%d" % k: b"0123" for k in range(3000)})
    assert 0 < len(words) < 3000 and words.held <= words.most
    other = common.Recent("batch-other")
    other.keep_all({b"a": b"b"})
    assert not words and words.held == 0


def test_memories_give_way_to_operators_that_keep_none(docs, monkeypatch):
    taken, real = [], F.arrow_udf
    monkeypatch.setattr(outliers.F, "arrow_udf", lambda run, schema: taken.append(run) or real(run, schema))
    outliers.with_statistics(docs)
    for run in (taken[0], near_duplicates._signatures):
        words = common.Recent("one that has ended")
        words.keep(b"a", b"b")
        assert len(run(pa.array(["some text of some words"]))) == 1
        assert not words and words.held == 0


def test_packing_leaves_plain_words_to_the_model_alone():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    texts = ["Plain words, only Straße été naïve ÀÉ÷", "", "x1 a'b plain\u0301 plain. \xa0 <|endoftext|>", "words " * 5000]
    words, asked = packing.WordIds(WORDS), []

    class Watched:
        def encode_batch_fast(self, some, **how):
            asked.extend(some)
            return library.encode_batch_fast(some, **how)

    words.tokenizer = Watched()
    found = words.of(texts, 2)
    expected = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(f, np.uint32).tolist() for f in found] == [[*e.ids, 2] for e in expected]
    assert asked and not {"plain", "words", "only", "straße", "été", "naïve"} & set(asked)
    assert words.of([], 2) == []


def test_bpe_computes_each_match_of_a_batch_once_and_shares_prefixes(monkeypatch):
    coder = bpe.Codec(bpe.codec(BYTES, PATTERN).vocabulary.ranks, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.vocabulary.ranks, special_tokens={})
    done, reach = [], bpe.Prefixes._reach
    monkeypatch.setattr(bpe.Prefixes, "_reach", lambda self, start, stop: done.append(stop - start) or reach(self, start, stop))
    words = [f"unforeseeable{end}" for end in ("", "s", "sting", "stingly", "ness", "nesses")]
    texts = [" ".join(words[k:] + words[:k]) for k in range(len(words))]
    awkward = ["", " ", "  a", "a ", "a  b", " \n a\n \n", "a\xa0 b \x1c c", "  ", "\n", "a\t b's  'll 1 2"]
    for batch in (texts, awkward):
        flat, ends = coder.lists(pa.array(batch))
        cuts = [0, *ends.tolist()]
        assert [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [library.encode_ordinary(t) for t in batch]
        assert coder.decode_all(flat, ends).to_pylist() == [t.encode() for t in batch]
        if batch is texts:
            assert sum(done) < sum(len(w) + 1 for w in words)
    assert len(coder.lists(pa.array([], pa.string()))[1]) == 0
    with pytest.raises(IndexError):
        coder.decode_all(np.array([max(coder.vocabulary.bytes_of) + 1], np.int32), np.array([1]))


def test_suffix_tree_shuffles_looked_up_keys_once_and_loses_none(spark):
    own = suffix_tree.coded(pa.array(["A b\x0bB  \xc9", "", " "])).to_pylist()
    assert own == [suffix_tree.hashes([b"a", b"b", b"b", "É".encode(), b""]).tolist()] + [[int(suffix_tree.END)]] * 2
    texts = spark.createDataFrame([(str(i), f"a b c d e f{i % 3} " * 8 + f"g{i}") for i in range(40)], "doc_id string, text string")
    none, all_cached = suffix_tree.scored(texts, cached=0), suffix_tree.scored(texts)
    plan = none._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [row#" in line]
    assert grouped and not [line for line in grouped if "], [" in line and "," in line.split("], [")[0]], grouped
    first, second = ({r["doc_id"]: r["score"] for r in df.collect()} for df in (none, all_cached))
    assert first.keys() == second.keys() and all(math.isclose(first[k], second[k], rel_tol=1e-9) for k in first)


@pytest.mark.parametrize("kept", [0, 1, 900])
def test_suffix_tree_looks_keys_up_by_slices(spark, monkeypatch, kept):
    """a row for each key looked up grew with the tree that the tasks do not hold; a slice and a part share one."""
    monkeypatch.setattr(suffix_tree, "SLICE", 100)
    monkeypatch.setattr(suffix_tree, "ASKED", 300)
    pick = np.random.default_rng(5)
    keys = np.unique(pick.integers(-(1 << 63), (1 << 63) - 1, 1000))
    tree = {int(k): float(k % 7 + 1) for k in pick.permutation(keys)[:kept]}
    asked = {(7 << 33) + i: pick.choice(keys, pick.integers(0, 40)).tolist() for i in range(60)}
    found = suffix_tree.looked_up(
        spark.createDataFrame(list(asked.items()), "row bigint, further array<bigint>").repartition(3),
        spark.createDataFrame(list(tree.items()), "key bigint, value double"),
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    sums = {}
    for r in found.collect():
        sums[r["row"]] = sums.get(r["row"], 0.0) + r["value"]
    expected = {row: sum(tree[k] for k in further if k in tree) for row, further in asked.items()}
    assert sums == {row: value for row, value in expected.items() if value}


def test_suffix_tree_counts_runs_in_few_rows(spark, monkeypatch):
    """each run of tokens that a task had seen was a row of the shuffle, though few runs are seen often."""
    monkeypatch.setattr(suffix_tree, "COUNTED", 400)
    monkeypatch.setattr(suffix_tree, "SUMMED", 700)
    pick = np.random.default_rng(9)
    texts = [pick.zipf(1.3, pick.integers(0, 60)).tolist() for _ in range(150)] + [[1, 2] * 40] * 5
    training = spark.createDataFrame([(text,) for text in texts], "tokens array<bigint>").repartition(3)
    seen = Counter()
    for text in texts:
        if text:
            _, context, own, short = next(suffix_tree.runs(np.array(text, np.int64), np.array([len(text)]), 1))
            seen.update(zip(context.tolist(), short.tolist(), own.tolist()))
    allowed = lambda own, context, short: context != 3
    often = suffix_tree.seen_often(training, 1, allowed, 4000, 3)
    expected = {run: n for run, n in seen.items() if n >= 3 and run[0] != 3}
    assert often.has(np.array([own for *_, own in expected], np.int64)).all()
    once = np.array([own for (*_, own), n in seen.items() if n < 3], np.int64)
    assert often.has(once).mean() < 0.01
    found = suffix_tree.runs_seen(training, 1, lambda own, context, short: allowed(own, context, short) & often.has(own), 4000, 3)
    assert {(r["context"], r["short"], r["run"]): r["n"] for r in found.collect()} == expected
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # no row for each run: they are told apart after the shuffle, a slice at a time
    assert "FlatMapGroupsInArrow [slice" in plan and "Aggregate" not in plan


def test_places_of_hashes():
    pick = np.random.default_rng(3)
    every = np.unique(pick.integers(-(1 << 63), (1 << 63) - 1, 2000))
    for n in (0, 1, 2, 1000):
        keys = np.sort(pick.permutation(every)[:n])
        at = suffix_tree.Places(keys).of(every)
        assert (at >= 0).sum() == n and (keys[at[at >= 0]] == every[at >= 0]).all()
