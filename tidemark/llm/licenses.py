"""License scans by a positional index of rare licence words.

The index is one table of postings: a word, the entry it stands in, and its place there.
Entries are the templates, whole licence texts or typical sentences of them, of which the
words of highest inverse document frequency are indexed, and the phrases, with all their
words. Every indexed word found in a text is looked up, and each of its postings votes for
the place in the text where its entry would then begin. As many equal votes as a phrase has
words are that phrase, word by word; a template counts from a share of its indexed words
that agree on one place, and only where one of its mandatory key phrases is present too.

Everything happens within a row, on the few positions of licence words, and the columns'
expressions are the same however many templates there are. The only shuffle counts in how
many texts each licence word occurs.

Words are runs of anything but ASCII signs and spaces, with A-Z in lower case, in texts and
templates alike.

Cases: null text is the empty one, without words and labels; a corpus without licence words
has no labels; equal templates share their votes but each gets its label; a template
without words or phrases is never found; a result's name among the columns is replaced, all
others stay; repeated rows give repeated results.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

# Phrases that give a label wherever they stand.
PHRASES = {
    "mit": "mit license",
    "apache": "apache license",
    "gpl": "general public license",
}
# Texts typical of a licence, and the phrases of which one must be present.
TEMPLATES = {
    "agpl": ("gnu affero general public license version 3", ("affero general public license",)),
    "apache-2.0": ("licensed under the apache license version 2 0", ("apache license version 2 0",)),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use in source and binary forms", "bsd license"),
    ),
    "cc-by-nc": (
        "licensed under cc by nc 4 0",
        ("cc by nc", "commons attribution noncommercial", "commons attribution non commercial"),
    ),
    "cc-by-sa": ("licensed under cc by sa 4 0", ("cc by sa", "attribution sharealike")),
    "cc0": ("creative commons zero public domain dedication cc0 1 0", ("cc0", "public domain dedication")),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("general public license version 3",)),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee", ("isc license", "with or without fee")),
    "lgpl": ("gnu lesser general public license", ("lesser general public license",)),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "unlicense": ("this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
}
# capitals are letters here too: only licence words are put in lower case
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_SHARE = 0.4
INDEXED = 64
BASE, KEY, WHOLE = 0, 1, 2
# a vote: the entry above, the place below, which may lie before the text's first word
BEFORE = 1 << 24
HITS = "array<struct<word:string,at:int>>"
Templates = dict[str, tuple[str, tuple[str, ...]]]


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(UPPER, LOWER))) if w]


def read_templates(spark: SparkSession, path: str) -> Templates:
    """Templates from a table of label, text and key phrases (an array): one row per licence, however large the corpus."""
    rows = spark.read.schema("label string, text string, phrases array<string>").parquet(path).collect()
    return {r["label"]: (r["text"] or "", tuple(p for p in r["phrases"] or () if p)) for r in rows if r["label"]}


@dataclass(frozen=True)
class Index:
    """Postings (entry, place) by word; kind, label, number of words and of votes needed by entry."""

    postings: dict[str, list[tuple[int, int]]]
    entries: list[tuple[int, str, int, int]]

    @property
    def signs(self) -> list[str]:
        """One word of each phrase, without which no text has a label."""
        phrases: dict[int, list[str]] = {}
        for word, places in self.postings.items():
            for entry, _ in places:
                if self.entries[entry][0] != WHOLE:
                    phrases.setdefault(entry, []).append(word)
        return sorted({max(sorted(words), key=len) for words in phrases.values()})


def vocabulary(templates: Templates = TEMPLATES) -> list[str]:
    texts = [*PHRASES.values(), *(t for text, phrases in templates.values() for t in (text, *phrases))]
    return sorted({word for text in texts for word in words_of(text)})


def index(weights: dict[str, float], templates: Templates = TEMPLATES, indexed: int = INDEXED) -> Index:
    """Postings of all words of the phrases and of the ``indexed`` words of highest weight of each template."""
    made = Index({}, [])

    def enter(kind: int, label: str, places: list[tuple[str, int]], share: float) -> None:
        needed = max(1, math.ceil(len(places) * share))
        for word, place in places:
            made.postings.setdefault(word, []).append((len(made.entries), place))
        made.entries.append((kind, label, len(places), needed))

    def placed(text: str) -> list[tuple[str, int]]:
        return [(word, place) for place, word in enumerate(words_of(text))]

    for label, phrase in PHRASES.items():
        enter(BASE, label, placed(phrase), 1.0)
    for label, (text, phrases) in templates.items():
        every = placed(text)
        chosen = set(sorted({w for w, _ in every}, key=lambda w: (-weights.get(w, 1.0), w))[:indexed])
        enter(WHOLE, label, [(w, k) for w, k in every if w in chosen], LEAST_SHARE)
        for phrase in phrases:
            if words_of(phrase):
                enter(KEY, label, placed(phrase), 1.0)
    return made


def _kept(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _words(text: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the array of all words, as they are written."""
    return _kept(F.split(text, SEPARATORS), lambda parts: then(F.filter(parts, lambda w: w != "")))


def _hits(text: Column, known: list[str], signs: list[str]) -> Column:
    """Indexed words with their place, where the text has one of the signs at all."""
    sign = "(?i)" + "|".join(map(re.escape, signs))
    longest = max(map(len, known))
    place = lambda w, i: F.when(F.length(w) <= longest, F.struct(F.translate(w, UPPER, LOWER).alias("word"), i.alias("at")))
    found = _words(text, lambda words: F.filter(F.transform(words, place), lambda h: F.coalesce(h["word"].isin(known), F.lit(False))))
    return F.when(text.rlike(sign), found.cast(HITS)).otherwise(F.array().cast(HITS))


def rarity(docs: DataFrame, text_column: str = "text", templates: Templates = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of the licence words: one row each, so at most as many as the templates have.

    Only texts with a word that a phrase needs are counted: in all others no word is looked up.
    """
    known = vocabulary(templates)
    hits = _hits(whole_text(text_column), known, index({}, templates, 0).signs)
    rows = docs.select(F.explode(F.array_distinct(F.transform(hits, lambda h: h["word"]))).alias("word"))
    found = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {word: 1.0 / (1 + found.get(word, 0)) for word in known}


def _table(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _found(hits: Column, made: Index) -> Column:
    """kind, label, start and share of each entry, at each place where it has the votes it needs."""
    postings = {word: [{"e": e, "p": p} for e, p in places] for word, places in made.postings.items()}
    entries = [{"kind": kind, "label": label, "size": size, "needed": needed} for kind, label, size, needed in made.entries]

    def votes(by_word: Column) -> Column:
        vote = lambda h: F.transform(
            F.try_element_at(by_word, h["word"]), lambda p: F.shiftleft(p["e"].cast("bigint"), 32) + (h["at"] - p["p"] + BEFORE)
        )
        return F.sort_array(F.flatten(F.transform(hits, vote)))

    def counted(every: Column) -> Column:
        """Each vote with how often it was given, off the places where the sorted votes change."""
        last = F.filter(
            F.sequence(F.lit(0), F.size(every) - 1), lambda i: F.coalesce(F.get(every, i) != F.get(every, i + 1), F.lit(True))
        )
        return _kept(last, lambda ends: F.transform(ends, lambda end, k: F.struct(
            F.get(every, end).alias("vote"), (end - F.coalesce(F.get(ends, k - 1), F.lit(-1))).alias("n")
        )))

    def judged(of: Column) -> Column:
        each = _kept(_kept(_table(postings, "map<string,array<struct<e:int,p:int>>>"), votes), counted)
        entry = lambda run: F.get(of, F.shiftright(run["vote"], 32).cast("int"))
        enough = F.filter(each, lambda run: run["n"] >= entry(run)["needed"])
        return F.transform(enough, lambda run: F.struct(
            entry(run)["kind"].alias("kind"), entry(run)["label"].alias("label"),
            (run["vote"].bitwiseAND(F.lit((1 << 32) - 1)) - BEFORE).cast("int").alias("start"),
            (run["n"] / entry(run)["size"]).alias("share"),
        ))

    found = _kept(_table(entries, "array<struct<kind:int,label:string,size:int,needed:int>>"), judged)
    kind = "array<struct<kind:int,label:string,start:int,share:double>>"
    return F.when(F.size(hits) > 0, found.cast(kind)).otherwise(F.array().cast(kind))


def scanned(docs: DataFrame, weights: dict[str, float], text_column: str = "text", templates: Templates = TEMPLATES) -> DataFrame:
    """All columns, n_words, base (places of each fixed label's phrase), base_labels, labels and score."""
    results = ("n_words", "base", "base_labels", "labels", "score")
    made = index(weights, templates)
    # everything the caller has stays in one column, so only the results' own names are taken
    rows = docs.select(F.struct(*docs.drop(*results).columns).alias("row"), whole_text(text_column).alias("text"))
    # empty pieces stand only at the ends
    n_words = _kept(F.split("text", SEPARATORS), lambda parts: (
        F.size(parts) - F.when(parts[0] == "", 1).otherwise(0)
        - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    ).cast("bigint"))
    rows = rows.select("row", n_words.alias("n_words"), _hits(F.col("text"), sorted(made.postings), made.signs).alias("hits"))
    rows = rows.select("row", "n_words", _found(F.col("hits"), made).alias("found"))
    of_kind = lambda kind: F.filter("found", lambda x: x["kind"] == kind)
    starts = {label: F.transform(F.filter(of_kind(BASE), lambda x: x["label"] == label), lambda x: x["start"]) for label in PHRASES}
    proven = F.transform(of_kind(KEY), lambda x: x["label"])
    rows = rows.select(
        "row", "n_words", F.struct(*[places.alias(label) for label, places in starts.items()]).alias("base"),
        F.array_sort(F.array_distinct(F.transform(of_kind(BASE), lambda x: x["label"]))).alias("base_labels"),
        _kept(proven, lambda known: F.filter(of_kind(WHOLE), lambda x: F.array_contains(known, x["label"]))).alias("whole"),
    )
    best = F.array_max(F.transform("whole", lambda x: x["share"]))
    return rows.select(
        "row.*", "n_words", "base", "base_labels",
        F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("whole", lambda x: x["label"])))).alias("labels"),
        F.when(F.size("base_labels") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
