"""Similar documents by an n-gram Jaccard join, partitioned vertically.

A document's set is its distinct word n-grams, as 64-bit hashes; equal sets are one class and
only one of them goes on. The global order of n-grams is that of their hashes, cut into
fragments of equal width. Everything is counted by fragment:

* An n-gram that no other set holds is in no overlap. The first fragment counts, for every
  set, how many of its n-grams others hold; sets that lack too many already are done. Of the
  rest all fragments are counted: few sets without a partner are left.
* Candidate pairs share one of the rarest n-grams of both, as many of them as sets this
  similar cannot miss.
* The overlap of a pair is counted in each fragment and summed; the pair is linked by that.

Links are wanted for the components, so pairs within a component need not be looked at.
Each round every set that may still join another component is compared with one partner, a
member chosen at random for each n-gram. Then n-grams held by one component only count as
held by no other, which ends the search for all members of a large group at once. When a
round joins little, all pairs that sizes, places in the order, components and sketches of
their n-grams allow are compared. A group of copies so costs in proportion to its size, and no link between
components is missed.

Cases: a text without words, or null, has an empty set and is linked with nothing; fewer words
than an n-gram make one n-gram of all; rows that share an id are documents of their own
and linked only if their texts are; a row without id is in no component; an empty table has
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed, small_batches, whole_text
from tidemark.llm.near_duplicates import components, list_array, shingles
from tidemark.operators.joins import join_under_skew

PERCENT = 80
FRAGMENT_BITS = 2
FRAGMENTS = 1 << FRAGMENT_BITS
SKETCH_WORDS = 16
LEAST_JOINED = 0.05  # a round that links a smaller share of its pairs is the last of its kind


def _fragment(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, 64 - FRAGMENT_BITS)


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _signed(texts: pa.Array) -> pa.Array:
    """size, digest and the n-grams of the first fragment of every text."""
    sets = shingles(texts)
    first = [s[: np.searchsorted(s, np.uint64(1 << (64 - FRAGMENT_BITS)))] for s in sets]
    return pa.StructArray.from_arrays(
        [pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()), list_array(first)],
        names=["size", "digest", "grams"],
    )


def _all_fragments(texts: pa.Array) -> pa.Array:
    sets = shingles(texts)
    return pa.StructArray.from_arrays(
        [pa.array([_digest(s) for s in sets], pa.binary()), list_array(sets)],
        names=["digest", "grams"],
    )


def _least_overlap(size: Column) -> Column:
    """What a set of this size must share with any partner."""
    return F.ceil(PERCENT * size / 100)


def _needed(size_a: Column, size_b: Column) -> Column:
    """What two sets of these sizes must share: 100 i >= PERCENT (a + b - i)."""
    return F.floor((PERCENT * (size_a + size_b) + 99 + PERCENT) / (100 + PERCENT))


def _sizes_fit(size_a: Column, size_b: Column) -> Column:
    return 100 * F.least(size_a, size_b) >= PERCENT * F.greatest(size_a, size_b)


def _whole_sets(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """number, size, grams of the classes given, from the text of a row with their first id (rows may repeat)."""
    find = F.arrow_udf(_all_fragments, "struct<digest:binary,grams:array<bigint>>")
    kept = classes.select("number", "size", F.col("first_id").alias("id"), F.col("digest").alias("wanted"))
    found = rows.join(kept, "id").select("number", "size", "wanted", find("text").alias("s"))
    return found.filter(F.col("s.digest") == F.col("wanted")).select("number", "size", F.col("s.grams").alias("grams"))


def held_by_others(sets: DataFrame) -> DataFrame:
    """number, gram, holders of the n-grams (from number, label, grams) that sets of several labels hold."""
    single = sets.select("number", "label", F.explode("grams").alias("gram"))
    holders = single.groupBy("gram").agg(
        F.count("*").alias("holders"), F.min("label").alias("low"), F.max("label").alias("high")
    ).filter("low < high").select("gram", "holders")
    return join_under_skew(single.select("number", "gram"), holders, ["gram"]).filter("holders is not null")


def _open_sets(sets: DataFrame, name: str) -> DataFrame:
    """number, label, size, ordered: sets that may join another label, with their shared n-grams, rarest first."""
    # a set whose row is repeated is still one set
    ordered = held_by_others(sets).groupBy("number").agg(F.sort_array(F.collect_set(F.struct("holders", "gram"))).alias("ordered"))
    enough = F.size("ordered") >= _least_overlap(F.col("size"))
    return landed(ordered.join(sets.select("number", "label", "size").distinct(), "number").filter(enough), name)


def _buckets(open_sets: DataFrame) -> DataFrame:
    """key, number, label, size, place, alone: the rarest n-grams of each set, where several labels meet.

    ``place`` is the n-gram's place in the set's whole order, unshared n-grams first;
    ``alone`` is how many in twenty of the set's n-grams no other set holds.
    """
    unshared = F.col("size") - F.size("ordered")
    reach = (F.col("size") - _least_overlap(F.col("size")) + 1 - unshared).cast("int")
    rarest = F.slice("ordered", F.lit(1), F.greatest(reach, F.lit(0)))
    members = open_sets.select("number", "label", "size", unshared.alias("unshared"), F.posexplode(rarest).alias("at", "entry"))
    members = members.select(
        F.col("entry.gram").alias("key"), "number", "label", "size", (F.col("unshared") + F.col("at")).cast("bigint").alias("place"),
        F.floor(20 * F.col("unshared") / F.col("size")).alias("alone"),
    )
    ends = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("size").alias("least_size"))
    met = join_under_skew(members, ends.filter("low < high"), ["key"]).filter("low is not null")
    # the smallest partner in the bucket already asks for so much after this place
    least = F.greatest(F.col("least_size"), _least_overlap(F.col("size")))
    enough = F.col("size") - F.col("place") >= _needed(F.col("size"), least)
    return met.filter(enough).select("key", "number", "label", "size", "place", "alone")


def _one_partner_each(buckets: DataFrame, turn: int) -> DataFrame:
    """a, b: every member with one member of another label that its n-grams lead to.

    Members with few n-grams of their own are asked first: in a group of near copies they
    are close to most others.
    """
    by_turn = lambda c: F.struct(c["alone"].alias("alone"), F.xxhash64(c["number"], F.lit(turn)).alias("by_turn"))
    own = F.struct("number", "label", "size", "alone")
    hubs = buckets.groupBy("key").agg(F.min_by(own, by_turn(own)).alias("hub"))
    met = join_under_skew(buckets, hubs, ["key"]).filter(
        (F.col("label") != F.col("hub.label")) & _sizes_fit(F.col("size"), F.col("hub.size"))
    )
    chosen = met.groupBy("number").agg(F.min_by("hub.number", by_turn(F.col("hub"))).alias("hub"))
    return chosen.select(F.least("number", "hub").alias("a"), F.greatest("number", "hub").alias("b")).distinct()


def _sketched(open_sets: DataFrame) -> DataFrame:
    """number, shared (how many n-grams are in ``ordered``) and these as the bits of ``SKETCH_WORDS`` longs, by their hash."""
    words = [
        F.expr(
            f"""aggregate(filter(ordered, x -> (shiftright(x.gram, 6) & {SKETCH_WORDS - 1}) = {k}), 0L,
                (bits, x) -> bits | shiftleft(1L, cast(x.gram & 63 AS int)))"""
        ).alias(f"bits{k}")
        for k in range(SKETCH_WORDS)
    ]
    return open_sets.select("number", F.size("ordered").alias("shared"), *words)


def _most_common() -> Column:
    """No pair shares more: each bit that one set alone has is at least one of its n-grams that the other lacks."""

    def lacking(own: str, other: str) -> Column:
        alone = [F.bit_count(F.col(f"bits{k}_{own}").bitwiseAND(F.bitwise_not(f"bits{k}_{other}"))) for k in range(SKETCH_WORDS)]
        return F.col(f"shared_{own}") - sum(alone[1:], alone[0])

    return F.least(lacking("a", "b"), lacking("b", "a"))


def _all_partners(buckets: DataFrame, open_sets: DataFrame) -> DataFrame:
    """a, b: all pairs of different labels that sizes, places and sketches allow, each in its first common bucket.

    In each bucket the label with the most members needs no pairs of its own: only the
    others are joined with all.
    """
    of_set = buckets.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("place", "key")))["key"].alias("keys"))
    of_set = of_set.join(_sketched(open_sets), "number")
    counts = buckets.groupBy("key", "label").agg(F.count("*").alias("members"))
    main = counts.groupBy("key").agg(F.max_by("label", F.struct("members", "label")).alias("main"))
    placed = join_under_skew(buckets.join(of_set, "number"), main, ["key"])
    columns = ("number", "label", "size", "place", "keys", "shared", *(f"bits{k}" for k in range(SKETCH_WORDS)))
    left = placed.filter("label != main").select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = placed.select("key", (F.col("label") == F.col("main")).alias("in_main"), *[F.col(c).alias(f"{c}_b") for c in columns])
    after = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    fits = (
        (F.col("label_a") != F.col("label_b"))
        & (F.col("in_main") | (F.col("number_a") < F.col("number_b")))
        & _sizes_fit(F.col("size_a"), F.col("size_b"))
        & (after >= _needed(F.col("size_a"), F.col("size_b")))
        & (_most_common() >= _needed(F.col("size_a"), F.col("size_b")))
        # both lists are in the global order
        & (left["key"] == F.array_intersect("keys_a", "keys_b")[0])
    )
    met = left.join(right, (left["key"] == right["key"]) & fits)
    return met.select(F.least("number_a", "number_b").alias("a"), F.greatest("number_a", "number_b").alias("b"))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough: overlaps counted fragment by fragment, and summed.

    ``sets`` holds number, size and ``ordered``, the n-grams that any other set holds.
    """
    grams = F.transform("ordered", lambda x: x["gram"])

    def part(k: int) -> Column:
        return F.filter(grams, lambda g: _fragment(g) == k)

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("number").alias(name), F.col("size").alias(f"size_{name}"), *[part(k).alias(f"{name}{k}") for k in range(FRAGMENTS)]
        )

    common = sum((F.size(F.array_intersect(f"a{k}", f"b{k}")) for k in range(FRAGMENTS)), F.lit(0))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", common.alias("common"))
    return met.filter(100 * F.col("common") >= PERCENT * (F.col("size_a") + F.col("size_b") - F.col("common"))).select("a", "b")


def _labelled(sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return sets.withColumn("label", F.col("number"))
    return sets.drop("label").join(labels.select(F.col("id").alias("number"), "label"), "number", "left").withColumn(
        "label", F.coalesce("label", "number")
    )


def joined(sets: DataFrame) -> DataFrame | None:
    """id, label (the smallest number reachable) of all linked sets; None without any. From number, size, grams."""
    whole = _open_sets(_labelled(sets, None), "open-sets")
    buckets, links, labels, turn = landed(_buckets(whole), "buckets"), None, None, 0
    while True:
        pairs = landed(_one_partner_each(buckets, turn), "pairs")
        asked = pairs.count()
        found = landed(linked(pairs, whole), "links")
        joined_now = found.count() if asked else 0
        if joined_now:
            links = found if links is None else links.unionByName(found)
            labels = components(links)
            buckets = landed(_mixed(_relabelled(buckets, labels)), "buckets")
        if joined_now <= LEAST_JOINED * asked:
            break
        turn += 1
    # sets whose n-grams still lead to another label, counted anew, and all their pairs
    left = whole.join(buckets.select("number").distinct(), "number", "left_semi")
    left = left.select("number", "size", F.transform("ordered", lambda x: x["gram"]).alias("grams"))
    still_open = _open_sets(_labelled(left, labels), "open-sets")
    last = landed(linked(landed(_all_partners(landed(_buckets(still_open), "buckets"), still_open), "pairs"), whole), "links")
    if not last.isEmpty():
        labels = components(last if links is None else links.unionByName(last))
    return labels


def _relabelled(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    return buckets if labels is None else _labelled(buckets, labels)


def _mixed(buckets: DataFrame) -> DataFrame:
    ends = buckets.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return join_under_skew(buckets, ends, ["key"]).filter("low is not null").drop("low", "high")


def similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable by links): one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), whole_text(text_column).alias("text"))
    sign = F.arrow_udf(_signed, "struct<size:bigint,digest:binary,grams:array<bigint>>")
    signed = landed(rows.select("id", sign("text").alias("s")).select("id", "s.*"), "signed")
    classes = signed.filter("digest is not null and id is not null").groupBy("digest", "size").agg(F.min("id").alias("first_id"))
    classes = landed(classes.withColumn("number", F.monotonically_increasing_id()), "classes")
    # by the first fragment alone most sets turn out to lack too many shared n-grams
    named = classes.select("number", "digest", F.col("first_id").alias("id"))
    first = landed(signed.join(named, ["digest", "id"]).select("number", "size", "grams"), "first-fragment")
    shared = held_by_others(_labelled(first, None)).groupBy("number").agg(F.count("*").alias("shared"))
    lacking = F.size("grams") - F.coalesce("shared", F.lit(0))
    going_on = first.join(shared, "number", "left").filter(lacking <= F.col("size") - _least_overlap(F.col("size"))).select("number")
    going_on = landed(classes.join(going_on, "number", "left_semi"), "going-on")
    sets = landed(_whole_sets(rows, going_on), "sets")
    labels = joined(sets)
    named = classes.select("digest", "number", "first_id")
    if labels is None:
        found = named.select("digest", F.col("first_id").alias("component"))
    else:
        of_label = named.join(labels.select(F.col("id").alias("number"), "label"), "number", "left").withColumn(
            "label", F.coalesce("label", "number")
        )
        least = of_label.groupBy("label").agg(F.min("first_id").alias("component"))
        found = join_under_skew(of_label.select("digest", "label"), least, ["label"]).select("digest", "component")
    out = join_under_skew(signed.select("id", "size", "digest"), found, ["digest"])
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_column), F.col("size").alias("n_shingles"), component.alias("component_id"))
