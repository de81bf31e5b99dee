"""Personal data: broad candidates, boosted trees over their format and context, calibrated redaction.

Fixed formats (mail, address, card, phone) are found in every text and always count.
Beside them, generators of high recall propose further spans, which may overlap: key-like
strings after a naming word, long numbers, local phone numbers, spelled-out mail
addresses, national numbers. Boosted trees on a few small features of a candidate (what
proposed it, length, digits, variety, the word before it) give each a probability, and a
span is taken where its generator's threshold is reached: the lowest one whose held-out
candidates are right in ``precision`` of cases.

Nobody labels spans, so the trees learn from the formats' own proofs: a candidate counts
as right if a checksum, range or variety test confirms it, and as wrong if that test fails.
Features are small integers, so all candidates of the corpus, counted by feature vector,
make at most ``CELLS`` rows whatever its size; the trees are grown on that table.

Only column expressions touch the texts. Positions are code points: a text is split by a
pattern and the lengths of its pieces are summed. Patterns take whole runs without giving
back, so they need time in proportion to the text.

Cases: null text is the empty one, without spans; equal candidates of several generators
are merged into one span of the first; without any candidates of a generator, it takes
none; a result's name among the columns is replaced; repeated rows give repeated results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

# Fixed formats in their order, each with a cheap sign that a text may have one.
FORMATS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    "card": (r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
# Generators of further candidates.
PROPOSED = {
    "secret": r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+-]{12,}+",
    "number": r"(?<![0-9.])[0-9](?:[\x20-]?[0-9]){8,18}+(?![0-9.])",
    "local_phone": r"(?<![0-9+.])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "spelled_mail": r"(?i)(?<![a-z0-9._-])[a-z0-9._-]{1,64}+\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]++(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[a-z0-9-]++)++",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = (*FORMATS, *PROPOSED)
# Number of values of each feature.
FEATURES = {"kind": len(KINDS), "length": 6, "digits": 5, "variety": 5, "before": 4}
CELLS = math.prod(FEATURES.values())
NAMING = r"(?i)(?:token|secret|key|password|mail|phone|tel|fax|call|card|visa|iban|ssn|ip|address)\W{0,4}$"


def _matches(text: Column, pattern: str, *signs: str | None) -> Column:
    """Matches as array of (start, end, match); positions in code points, end exclusive. A text without any of the signs has none."""
    pattern_column = F.lit(pattern)
    found = F.regexp_extract_all(text, pattern_column, F.lit(0))

    def placed(pair: Column) -> Column:
        """Running lengths: a match starts after all pieces and matches before it."""
        start: Any = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("done"))
        return F.aggregate(
            F.arrays_zip(pair["found"], F.slice(pair["parts"], 1, F.size(pair["found"]))),
            start,
            lambda acc, x: F.struct(
                (acc["at"] + F.length(x["1"]) + F.length(x["found"])).alias("at"),
                F.concat(acc["done"], F.array(F.struct(
                    (acc["at"] + F.length(x["1"])).alias("start"),
                    (acc["at"] + F.length(x["1"]) + F.length(x["found"])).alias("end"),
                    x["found"].alias("match"),
                ))).alias("done"),
            ),
            lambda acc: acc["done"],
        )

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    # the array of matches is made once, then used only where it is not empty
    held = F.transform(F.array(found), lambda m: F.when(F.size(m) == 0, none).otherwise(
        placed(F.struct(m.alias("found"), F.split(text, pattern, -1).alias("parts")))
    ))[0]
    known = [F.contains(text, F.lit(sign)) for sign in signs if sign]
    return F.when(reduce(lambda a, b: a | b, known), held).otherwise(none) if known else held


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits pass the check: doubled every second from the right, nines cast out."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, k: acc + F.when(
            (n - k) % 2 == 1,
            (lambda d: d * 2 - F.when(d > 4, 9).otherwise(0))(F.substring(digits, k, F.lit(1)).cast("int")),
        ).otherwise(F.substring(digits, k, F.lit(1)).cast("int")),
    )
    return F.when(n.between(12, 19), total % 10 == 0).otherwise(False)


def _confirmed(kind: str, match: Column) -> Column:
    """The format's own proof."""
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    digits = F.length(_digits(match))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind in ("card", "number"):
        return luhn(_digits(match))
    if kind == "phone":
        return digits.between(9, 15)
    if kind == "secret":
        value = F.regexp_replace(match, r"^[^=:]*[=:]\s*[\"']?", "")
        return (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    if kind == "local_phone":
        return match.rlike(r"^\(?[2-9]")
    if kind == "national":
        return ~match.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    return sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))


def _features(kind: str, text: Column, found: Column) -> dict[str, Column]:
    match = found["match"]
    n = F.length(match)
    digits = F.length(_digits(match))
    different = F.size(F.array_distinct(F.split(match, "")))
    before = F.when(found["start"] > 0, F.substring(text, F.greatest(found["start"] - 19, F.lit(1)), F.least(found["start"], F.lit(20)))).otherwise("")
    return {
        "kind": F.lit(KINDS.index(kind)),
        "length": _bin(n, (10, 13, 17, 24, 40)),
        "digits": _bin(digits / n, (0.2, 0.5, 0.8, 0.999)),
        "variety": _bin(different, (4, 7, 10, 15)),
        "before": F.when(before.rlike(NAMING), 2).otherwise(F.when(before.rlike(r"[A-Za-z]\s*$"), 1).when(found["start"] == 0, 3).otherwise(0)),
    }


def with_base_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns, and ``base``: confirmed spans of the fixed formats by start, then by format."""
    text = whole_text(text_column)

    def of(rank: int, kind: str) -> Column:
        kept = F.filter(_matches(text, *FORMATS[kind]), lambda x: _confirmed(kind, x["match"]))
        return F.transform(kept, lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")
        ))

    spans = [of(rank, kind) for rank, kind in enumerate(FORMATS)]
    return docs.withColumn("base", F.array_sort(F.concat(*spans)))


def candidates(text: Column) -> Column:
    """Array of candidates of all generators: start, rank, end, kind, confirmed and the features."""
    every = {k: p for k, (p, _) in FORMATS.items() if k not in ("email", "phone")} | PROPOSED
    signs = {"ip": ["."], "spelled_mail": ["at", "AT", "At", "aT"]}

    def of(kind: str) -> Column:
        return F.transform(_matches(text, every[kind], *signs.get(kind, [])), lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"),
            _confirmed(kind, x["match"]).alias("confirmed"),
            *[value.alias(f"f_{name}") for name, value in _features(kind, text, x).items()],
        ))

    found = [of(kind) for kind in every]
    return F.concat(*found)


@dataclass(frozen=True)
class Trees:
    """Trees of depth two: (feature, edge, feature, edge, values of the four leaves), and thresholds by kind."""

    prior: float
    trees: tuple[tuple, ...]
    thresholds: dict[str, float]

    def score(self, cell: dict[str, int]) -> float:
        return self.prior + sum(v[2 * (cell[a] >= x) + (cell[b] >= y)] for a, x, b, y, v in self.trees)

    def column(self, candidate: Column) -> Column:
        def leaf(a, x, b, y, v):
            above = candidate[f"f_{b}"] >= y
            return F.when(candidate[f"f_{a}"] >= x, F.when(above, v[3]).otherwise(v[2])).otherwise(F.when(above, v[1]).otherwise(v[0]))

        return reduce(lambda s, t: s + leaf(*t), self.trees, F.lit(self.prior))


def grow(cells: list[tuple[dict[str, int], int, int]], rounds: int = 24, rate: float = 0.4) -> tuple[float, tuple]:
    """Gradient boosting on counted cells (features, right, wrong), by the second-order gain."""
    right, wrong = sum(c[1] for c in cells), sum(c[2] for c in cells)
    prior = math.log((right + 1) / (wrong + 1))
    scores, trees = [prior] * len(cells), []
    splits = [(name, edge) for name, n in FEATURES.items() for edge in range(1, n)]
    for _ in range(rounds):
        slopes = []
        for (_, r, w), s in zip(cells, scores):
            p = 1 / (1 + math.exp(-s))
            slopes.append((r - (r + w) * p, (r + w) * p * (1 - p)))

        def best(rows):
            def gain(split):
                g, h, g2, h2 = 0.0, 1.0, 0.0, 1.0
                for i in rows:
                    if cells[i][0][split[0]] >= split[1]:
                        g, h = g + slopes[i][0], h + slopes[i][1]
                    else:
                        g2, h2 = g2 + slopes[i][0], h2 + slopes[i][1]
                return g * g / h + g2 * g2 / h2
            return max(splits, key=gain)

        a, x = best(range(len(cells)))
        upper = [i for i in range(len(cells)) if cells[i][0][a] >= x]
        b, y = best(upper or range(len(cells)))
        sums = [[0.0, 1.0] for _ in range(4)]
        place = [2 * (c[0][a] >= x) + (c[0][b] >= y) for c in cells]
        for at, (g, h) in zip(place, slopes):
            sums[at][0] += g
            sums[at][1] += h
        values = tuple(rate * g / h for g, h in sums)
        trees.append((a, x, b, y, values))
        scores = [s + values[at] for s, at in zip(scores, place)]
    return prior, tuple(trees)


def fit(docs: DataFrame, precision: float = 0.9, text_column: str = "text") -> Trees | None:
    """Trees from all candidates of the corpus; thresholds from the half of them held out by a hash of the text."""
    names = list(FEATURES)
    each = docs.select(whole_text(text_column).alias("t")).select(
        (F.xxhash64("t") % 2 == 0).alias("held"), F.inline(candidates(F.col("t")))
    )
    counted = each.groupBy("held", "kind", *[f"f_{n}" for n in names]).agg(
        F.sum(F.col("confirmed").cast("bigint")).alias("right"), F.count("*").alias("n")
    )
    rows = counted.collect()  # at most 2 * CELLS rows
    cell = lambda r: {n: r[f"f_{n}"] for n in names}
    learn = sorted(((cell(r), r["right"], r["n"] - r["right"]) for r in rows if not r["held"]), key=lambda c: tuple(c[0].values()))
    if not learn:
        return None
    prior, trees = grow(learn)
    model = Trees(prior, trees, {})
    thresholds = {}
    for kind in KINDS:
        held = sorted(((model.score(cell(r)), r["right"], r["n"]) for r in rows if r["held"] and r["kind"] == kind), reverse=True)
        right = total = 0
        for score, r, n in held:
            right, total = right + r, total + n
            if right >= precision * total:
                thresholds[kind] = score
    return Trees(prior, trees, thresholds)


def with_spans(docs: DataFrame, model: Trees | None, text_column: str = "text") -> DataFrame:
    """All columns, ``base``, and ``spans``: those of ``base`` and the candidates the trees select."""
    based = with_base_spans(docs, text_column)
    plain = "array<struct<start:int,rank:int,end:int,kind:string>>"
    chosen = F.array().cast(plain)
    if model is not None and model.thresholds:
        def selected(x: Column) -> Column:
            least = reduce(lambda c, kv: c.when(x["kind"] == kv[0], kv[1] - 1e-9), list(model.thresholds.items())[1:],
                           F.when(x["kind"] == list(model.thresholds.items())[0][0], list(model.thresholds.items())[0][1] - 1e-9))
            return x["confirmed"] & F.coalesce(model.column(x) >= least, F.lit(False))

        picked = F.filter(candidates(whole_text(text_column)), selected)
        chosen = F.transform(picked, lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"])).cast(plain)
    # a candidate that a base span already covers adds nothing
    fresh = F.filter(chosen, lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"])))
    # of equal candidates the first generator's stays
    ordered = F.array_sort(F.transform(fresh, lambda x: F.struct(x["start"], x["end"], x["rank"], x["kind"])))
    first = F.transform(F.array(ordered), lambda every: F.filter(every, lambda x, k: (k == 0) | (
        F.struct(F.get(every, k - 1)["start"], F.get(every, k - 1)["end"]) != F.struct(x["start"], x["end"])
    )))[0]
    added = F.transform(first, lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"])).cast(plain)
    return based.withColumn("spans", F.array_sort(F.array_union(F.col("base").cast(plain), added)))


def listed(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, model: Trees | None, text_column: str = "text") -> DataFrame:
    """The same columns; in the text, overlapping spans are joined and each is replaced by its kind in brackets."""
    found = with_spans(docs.withColumnsRenamed({c: f"_{c}_" for c in docs.columns if c in ("base", "spans")}), model, text_column)
    text = F.col(text_column)
    start: Any = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        "spans",
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]")
            )).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    out = found.withColumn(text_column, F.when(F.size("spans") > 0, clean).otherwise(text)).drop("base", "spans")
    return out.withColumnsRenamed({f"_{c}_": c for c in ("base", "spans")}).select(*docs.columns)
