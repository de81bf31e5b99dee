"""Near-duplicates by odd sketches of MinHash samples.

A document's set is its distinct word shingles. Its MinHash sample is cut into bands for
finding candidates, and folded into an odd sketch: each sample flips one bit, so what two
samples share cancels out, and the number of ones in the XOR of two sketches estimates how
much they differ, most precisely where they differ little. Candidates whose sketches are
too far apart are dropped; the others are compared on their full sets.

Equal sets are one class from the start, and only its representative goes on. Buckets are
then taken in rounds: each set is compared with one other, the smallest id over all its
buckets first, then, in buckets whose members are still in different components, the
member with the most links. Once links have joined most of a bucket into one component,
only pairs of *different* components are left to compare. Of these, a set goes whose
shingles are too often its own to be 0.75 like any other, and a pair without a common
shingle among their rarest ones (as many as sets this similar cannot miss); all other
pairs are compared by size and sketch within the bucket, and by their sets where these
allow it. A round so costs one pair a set, however large a group of copies is, components
are only ever made of a round's new links between earlier components, and no candidate
pair that could join two components is left out.

With 32 bands of 4 samples a pair at the threshold of 0.75 meets in some band but for 5 in
a million; sketches are dropped below an estimate of 0.55, more than four and a half standard
errors away.

Cases: a text without words has an empty set and is linked with nothing; fewer words than
a shingle make one shingle of all; rows with the same id are one document, the first of
them stays; rows without id are linked with nothing and kept; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, landed, parted, small_batches, whole_text
from tidemark.operators.joins import join_under_skew

WIDTH = 5
TEXTS = 250
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
PERCENT = 75
LEAST_ESTIMATE = 0.55

_random = np.random.default_rng(7)
_FACTORS = (_random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1))
_SHIFTS = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_PLACES = _random.integers(0, 1 << 63, max(WIDTH, 1), dtype=np.uint64) | np.uint64(1)
_BAND_SEEDS = _random.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_SIGNATURE = "n_shingles:bigint,digest:binary,sketch:array<bigint>,bands:array<bigint>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """For each text the distinct 64-bit hashes of its word shingles, sorted.

    Each word of ``TEXTS`` texts is hashed once; what Arrow then holds for no array goes back, so that a worker that waits is small.
    """
    sets = []
    for at in range(0, len(texts), TEXTS):
        sets += _shingles(texts.slice(at, TEXTS))
    pa.default_memory_pool().release_unused()
    return sets


def _shingles(texts: pa.Array) -> list[np.ndarray]:
    words, which, ends = parted(texts)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(which) - WIDTH + 1, 0)
    every = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        every += _mixed(hashed + _PLACES[k])[which[k:k + n]]
    every = _mixed(every)
    sets, start = [], 0
    for end in ends.tolist():
        if end - start >= WIDTH:
            found = np.sort(every[start:end - WIDTH + 1])
            sets.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        else:
            whole = [words[w] for w in which[start:end]]
            sets.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(whole), seed=len(whole))] if whole else [], np.uint64))
        start = end
    return sets


def list_array(rows: list[np.ndarray]) -> pa.Array:
    """The rows as lists of longs."""
    cuts = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([*rows, np.empty(0, np.uint64)]).view(np.int64)))


def samples(found: np.ndarray) -> np.ndarray:
    """The least value of each permutation of a set's hashes; long sets in steps."""
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        np.minimum(least, (short[at:at + 4096, None] * _FACTORS + _SHIFTS).min(0), out=least)
    return least


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """One bit flipped per sample, as 64-bit words."""
    place = _mixed(least.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    odd = np.bincount(place.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = _BAND_SEEDS.copy()
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = _mixed(keys + column)
    return keys.view(np.int64)


def _signatures(texts: pa.Array) -> pa.Array:
    Recent.leave_to("near_duplicates")
    sizes, digests, sketches, bands = [], [], [], []
    for found in shingles(texts):
        sizes.append(len(found))
        if len(found):
            least = samples(found)
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            sketches.append(odd_sketch(least))
            bands.append(band_keys(least))
        else:
            digests.append(None), sketches.append(None), bands.append(None)
    lists = lambda rows: pa.array(rows, pa.list_(pa.int64()))
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists(sketches), lists(bands)],
        names=["n_shingles", "digest", "sketch", "bands"],
    )


def estimate(a: Column, b: Column) -> Column:
    """Similarity of the sets behind two odd sketches."""
    ones = sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    share = F.least(2.0 * ones / SKETCH_BITS, F.lit(0.999999))
    apart = -SKETCH_BITS / 2.0 * F.log(1.0 - share)
    return 1.0 - apart / (2.0 * SAMPLES)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b")]
        linked = []
        for a, b, x, y in zip(*columns):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= PERCENT * (len(x) + len(y) - both):
                linked.append((a, b))
        ends = list(zip(*linked)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ends], names=["a", "b"])


def _links(pairs: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough: by their sketches first, then by their sets."""
    left = reps.select(F.col("rep").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("sketch_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("sketch_b"))
    near = pairs.join(left, "a").join(right, "b").filter(
        (100 * F.least("size_a", "size_b") >= PERCENT * F.greatest("size_a", "size_b"))
        & (estimate(F.col("sketch_a"), F.col("sketch_b")) >= LEAST_ESTIMATE)
    )
    near = near.select("a", "b")
    full = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return landed(full.select("a", "b", "set_a", "set_b").mapInArrow(_confirmed, "a bigint, b bigint"), "links")


def _undecided(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """key, rep, label of the buckets whose members are in different components."""
    placed = shared.select("rep", "key").join(labels.toDF("rep", "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    ends = placed.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last")).filter("first < last")
    return join_under_skew(placed, ends, ["key"]).filter("first is not null").select("key", "rep", "label")


def _mixed_buckets(rows: DataFrame) -> DataFrame:
    """The rows of the buckets whose members are in different components, with the least size in the bucket."""
    ends = rows.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.min("size").alias("least_size"))
    return join_under_skew(rows, ends.filter("first < last").drop("last"), ["key"]).filter("first is not null").drop("first")


def _needed(size_a: Column, size_b: Column) -> Column:
    """How many shingles two sets of these sizes must share."""
    return F.floor((PERCENT * (size_a + size_b) + 99 + PERCENT) / (100 + PERCENT)).cast("int")


def _rarest(ordered: Column, size: Column, other_size: Column) -> Column:
    """The rarest shingles of a set: one that shares enough with it has one of these among its own rarest."""
    return F.slice(ordered, F.lit(1), F.greatest(F.lit(1), (size - _needed(size, other_size) + 1).cast("int")))


def _sharing(open_rows: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """The open rows that can still be similar enough to another: key, rep, label, size, common, rarest, sketch, bands.

    ``common`` counts a set's shingles that another open set has too: no two sets share
    more. Where that is too little even for the smallest set of the bucket, the row goes:
    so do the members that differ from a group's centre each in its own way. ``rarest``
    are the set's shingles that the fewest open sets have, in that order, as short hashes.
    """
    as_list = F.arrow_udf(lambda sets: pa.array([np.frombuffer(x, np.int64) for x in sets.to_pylist()], pa.list_(pa.int64())), "array<bigint>")
    still = open_rows.select(F.col("rep").alias("id")).distinct()
    single = landed(sets.join(still, "id", "left_semi").select("id", F.explode(as_list("hashes")).alias("shingle")), "open-shingles")
    holders = single.groupBy("shingle").agg(F.count("*").alias("holders"))
    of_set = join_under_skew(single, holders, ["shingle"]).groupBy(F.col("id").alias("rep")).agg(
        F.count("*").alias("found"), F.count_if(F.col("holders") > 1).alias("common"),
        F.sort_array(F.collect_list(F.struct("holders", "shingle"))).alias("ordered"),
    )
    known = reps.dropDuplicates(["rep"]).join(of_set, "rep")
    # an id that came with different texts has several sets: nothing is ruled out by its shingles
    one_set = F.col("found") == F.col("size")
    least = F.ceil(PERCENT * F.col("size") / 100)
    known = known.select(
        "rep", "size", F.when(one_set, F.col("common")).otherwise(F.col("size")).alias("common"), "sketch", "bands",
        F.when(one_set, F.transform(
            _rarest(F.col("ordered"), F.col("size"), least), lambda x: F.pmod(x["shingle"], F.lit(2147483647)).cast("int")
        )).alias("rarest"),
    )
    rows = _mixed_buckets(open_rows.join(known, "rep"))
    least_union = F.col("size") + F.greatest("least_size", "common") - F.col("common")
    rows = _mixed_buckets(rows.filter(100 * F.col("common") >= PERCENT * least_union).drop("least_size"))
    least = F.greatest(F.col("least_size"), F.ceil(PERCENT * F.col("size") / 100))
    return rows.withColumn("rarest", _rarest(F.col("rarest"), F.col("size"), least)).drop("least_size")


def components(links: DataFrame) -> DataFrame:
    """id, label (the smallest id reachable) of every id in a link.

    Each round an id takes the smallest label among its own and its neighbours', then that
    label's own label; labels meet after about as many rounds as the logarithm of the
    longest path.
    """
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = landed(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        named = labels.select(F.col("id").alias("b"), F.col("label").alias("next"))
        least = ends.join(named, "b").groupBy(F.col("a").alias("id")).agg(F.min("next").alias("least"))
        lower = labels.join(least, "id").select("id", "label", F.least("label", "least").alias("lower"))
        jump = labels.select(F.col("id").alias("lower"), F.col("label").alias("jumped"))
        new = landed(
            join_under_skew(lower, jump, ["lower"]).select("id", F.coalesce("jumped", "lower").alias("label"), F.col("label").alias("old")),
            "labels",
        )
        labels = new.select("id", "label")
        if not new.filter("label != old").limit(1).count():
            return labels


def united(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of ``components`` after more links: components of components, so only new links are followed."""
    if not links.limit(1).count():
        return labels
    of = lambda end: labels.select(F.col("id").alias(end), F.col("label").alias(f"of_{end}"))
    named = join_under_skew(join_under_skew(links.select("a", "b"), of("a"), ["a"]), of("b"), ["b"])
    between = named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a != b").distinct()
    merged = components(landed(between, "between"))
    # ids that had a label before, and those that a new link is the first of
    known = labels.unionByName(merged.select("id", F.col("id").alias("label")).join(labels, "id", "left_anti"))
    lower = merged.select(F.col("id").alias("label"), F.col("label").alias("lower"))
    return landed(join_under_skew(known, lower, ["label"]).select("id", F.coalesce("lower", "label").alias("label")), "labels")


def clusters(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable by links), kept; one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), whole_text(text_column).alias("text"))
    signed = landed(
        rows.select("id", F.arrow_udf(_signatures, f"struct<{_SIGNATURE}>")("text").alias("s")).select("id", "s.*"), "signatures"
    )
    # classes of equal sets
    named = signed.filter("digest is not null and id is not null")
    classes = landed(named.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    reps = landed(
        named.withColumnRenamed("id", "rep").join(classes, ["digest", "rep"], "left_semi").dropDuplicates(["rep", "digest"])
        .select("rep", F.col("n_shingles").alias("size"), "sketch", "bands"), "representatives",
    )
    # buckets of at least two
    members = reps.select("rep", F.explode("bands").alias("key"))
    ends = members.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    shared = landed(join_under_skew(members, ends, ["key"]).filter("low is not null"), "buckets")
    involved = shared.select(F.col("rep").alias("id")).distinct()
    as_set = F.arrow_udf(lambda texts: pa.array([s.tobytes() for s in shingles(texts)], pa.binary()), "binary")
    sets = landed(rows.join(involved, "id", "left_semi").dropDuplicates(["id", "text"]).select("id", as_set("text").alias("hashes")), "sets")
    # first each member with the smallest one of all its buckets
    star = shared.groupBy(F.col("rep").alias("b")).agg(F.min("low").alias("a")).filter("a < b").select("a", "b")
    links = _links(star, reps, sets)
    labels = components(links)
    # then, in what is still mixed, each with the one that has the most links in any of its buckets
    ends_of = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    mixed = landed(join_under_skew(_undecided(shared, labels), ends_of, ["rep"]).fillna(0, ["links"]), "mixed")
    most = mixed.groupBy("key").agg(F.max(F.struct("links", (-F.col("rep")).alias("low"), "label")).alias("most"))
    other = join_under_skew(mixed, most, ["key"]).filter("label != most.label")
    hubs = other.groupBy("rep").agg((-F.max("most")["low"]).alias("hub"))
    labels = united(labels, _links(hubs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct(), reps, sets))
    # then the pairs of different components that shared shingles, sizes and sketches allow, each in its first common band
    open_rows = landed(_sharing(_undecided(shared, labels), reps, sets), "open")
    columns = ("rep", "label", "size", "common", "rarest", "sketch", "bands")
    left = open_rows.select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = open_rows.select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
    most_common = F.least("common_a", "common_b")
    possible = (
        (F.col("rep_a") < F.col("rep_b")) & (F.col("label_a") != F.col("label_b"))
        & (100 * most_common >= PERCENT * (F.col("size_a") + F.col("size_b") - most_common))
        & (estimate(F.col("sketch_a"), F.col("sketch_b")) >= LEAST_ESTIMATE)
        & (left["key"] == F.array_min(F.array_intersect("bands_a", "bands_b")))
        & F.coalesce(F.arrays_overlap(
            _rarest(F.col("rarest_a"), F.col("size_a"), F.col("size_b")), _rarest(F.col("rarest_b"), F.col("size_b"), F.col("size_a"))
        ), F.lit(True))
    )
    apart = left.join(right, (left["key"] == right["key"]) & possible).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    labels = united(labels, _links(apart.distinct(), reps, sets))
    found = classes.join(labels.toDF("rep", "label"), "rep", "left").select("digest", F.coalesce("label", "rep").alias("component"))
    out = join_under_skew(signed.select("id", "n_shingles", "digest"), found, ["digest"])
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_column), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of one document of each group, with all columns."""
    gone = clusters(docs, id_column, text_column).filter("not kept").select(id_column).distinct()
    rest = docs.join(gone, id_column, "left_anti").select(F.struct(*docs.columns).alias("row"), F.col(id_column).alias("id"))
    # a row without id stands for itself
    own = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    return rest.withColumn("own", own).dropDuplicates(["id", "own"]).select("row.*")
