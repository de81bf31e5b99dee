"""Document fingerprints: SimHash, and all fingerprints within a Hamming radius.

Each occurrence of a word pair votes on 64 signed bits by its hash, so a pair's weight is
its frequency. The votes are summed by Spark, two bits to a number, combined before the
shuffle; a text of any length so needs one row of 32 sums.

Near fingerprints: the bits are cut into ``radius + 3`` blocks. Two fingerprints within
the radius agree on all but ``radius`` blocks at most, so some choice of three blocks is
the same in both: one table per choice, keyed by those bits, finds every pair. Equal
fingerprints are one before the search, and only the query side is matched with all.

The text after each one, in ascending order of id, comes from windows over ranges of ids
of about equal size; the first text of the next range is looked up in a list of one row
per range.

Cases: null text is the empty one; texts without a word have the fingerprint of no votes
(all zero bits); one word is its own pair; equal ids are ordered by their text, no id comes
first; a single document is its own next; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import landed, whole_text
from tidemark.operators.joins import join_under_skew

BITS = 64
LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    """Hashes of the text's word pairs; of its word if it has one only."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return F.transform(F.array(words), lambda w: F.when(F.size(w) < 2, F.transform(w, lambda x: F.xxhash64(x))).otherwise(
        F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.xxhash64(a, b))
    ))[0]


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and ``fingerprint`` (bigint) of each text in ``text``; keys name one text."""
    votes = texts.select(*keys, F.explode(terms(F.col("text"))).alias("h"))
    lane = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES))).alias(f"v{k}") for k in range(BITS // 2)]
    summed = votes.groupBy(*keys).agg(F.count("*").alias("n"), *lane)
    low = [(F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF)), k) for k in range(BITS // 2)]
    high = [(F.shiftrightunsigned(f"v{k}", 32), k + 32) for k in range(BITS // 2)]
    bits = [F.when(ones * 2 > F.col("n"), F.lit(_bit(k))).otherwise(F.lit(0)) for ones, k in low + high]
    return summed.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def _bit(k: int) -> int:
    return 1 << k if k < 63 else -(1 << 63)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for half of the bits different or more."""
    return F.greatest(F.lit(0.0), 1.0 - F.bit_count(a.bitwiseXOR(b)) / (BITS / 2.0))


def within(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """query, fingerprint, distance: all pairs of distinct values within the radius, equal ones included."""
    blocks = radius + 3
    edges = [BITS * k // blocks for k in range(blocks + 1)]

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen) for chosen in combinations(range(blocks), 3)]
        signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
        tables = [F.struct(F.lit(i).alias("table"), F.col(name).bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)]
        return rows.select(name, F.inline(F.array(*tables)))

    left = keyed(queries.select(F.col("fingerprint").alias("query")).distinct(), "query")
    right = keyed(prints.select("fingerprint").distinct(), "fingerprint")
    found = left.join(right, ["table", "bits"])
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    return found.select("query", "fingerprint", distance.alias("distance")).filter(F.col("distance") <= radius).distinct()


def ordered(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """place (0, 1, ... by ascending id), id, text, next_text; after the last row comes the first."""
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    session = docs.sparkSession
    ranges = 4 * int(session.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 100 * ranges).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    # the range of an id: how many cuts lie below it
    part = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("id"))), F.lit(-1)) if cuts else F.lit(0)
    ranged = rows.withColumn("part", F.when(F.col("id").isNull(), -1).otherwise(part))
    order = Window.partitionBy("part").orderBy("id", "text")
    placed = ranged.select(
        "part", "id", "text", (F.row_number().over(order) - 1).alias("row"), F.lead("text").over(order).alias("following")
    )
    # one row per range: its size, and its first text
    heads = ranged.groupBy("part").agg(F.count("*").alias("n"), F.min(F.struct("id", "text")).alias("head"))
    sizes = [(r["part"], r["n"]) for r in heads.select("part", "n").orderBy("part").collect()]
    starts, total = {}, 0
    for p, n in sizes:
        starts[p] = total
        total += n
    names = [p for p, _ in sizes]
    after = session.createDataFrame(
        [(p, starts[p], names[(i + 1) % len(names)]) for i, p in enumerate(names)], "part int, start bigint, after int"
    )
    firsts = after.join(heads.select(F.col("part").alias("after"), F.col("head.text").alias("first")), "after").drop("after")
    # few rows, one for each range
    joined = placed.join(F.broadcast(after.select("part", "start")), "part")
    last = F.col("following").isNull()
    ends = joined.filter(last).join(firsts.select("part", "first"), "part").select(
        (F.col("start") + F.col("row")).alias("place"), "id", "text", F.col("first").alias("next_text")
    )
    return joined.filter(~last).select(
        (F.col("start") + F.col("row")).alias("place"), "id", "text", F.col("following").alias("next_text")
    ).unionByName(ends)


def half_edited(text: str = "text", following: str = "next_text") -> Column:
    """The last half of the text's code points replaced by the first as many of the next text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - half), F.substring(F.col(following), F.lit(1), half))


def compared(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and the likeness to it and to the next document."""
    rows = ordered(docs, id_column, text_column).withColumn("edited", half_edited())
    both = rows.select("place", F.posexplode(F.array("text", "edited")).alias("kind", "text"))
    made = fingerprints(both, ["place", "kind"])
    facts = rows.select("place", "id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    total = facts.count()
    own = made.select("place", F.when(F.col("kind") == 0, F.col("fingerprint")).alias("own"), F.when(F.col("kind") == 1, F.col("fingerprint")).alias("edit"), F.lit(None).cast("bigint").alias("after"))
    before = F.pmod(F.col("place") - 1, F.lit(max(total, 1)))
    following = made.filter("kind = 0").select(before.alias("place"), F.lit(None).cast("bigint").alias("own"), F.lit(None).cast("bigint").alias("edit"), F.col("fingerprint").alias("after"))
    prints = own.unionByName(following).groupBy("place").agg(F.max("own").alias("own"), F.max("edit").alias("edit"), F.max("after").alias("after"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))  # noqa: E731  texts without a word cast no vote
    return facts.join(prints, "place", "left").select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", zero("own").alias("fingerprint"),
        zero("edit").alias("edited_fingerprint"), likeness(zero("own"), zero("edit")).alias("near_edited"),
        likeness(zero("own"), zero("after")).alias("near_next"),
    )


def neighbours(prints: DataFrame, radius: int = 3, id_column: str = "doc_id") -> DataFrame:
    """All columns, and ``n_near``: for ids divisible by 20, how many documents lie within the radius, itself included."""
    asked = prints.filter(F.col(id_column) % 20 == 0)
    sizes = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    found = within(asked, prints, radius).join(sizes, "fingerprint").groupBy(F.col("query").alias("fingerprint")).agg(F.sum("n").alias("n_near"))
    return join_under_skew(prints, found, ["fingerprint"]).withColumn("n_near", F.when(F.col(id_column) % 20 == 0, F.col("n_near")))
