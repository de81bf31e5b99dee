"""The trie of conversations by collapsing whole sequences.

Identical sequences of turns become one weighted sequence with the list of the conversations
that end there. A sequence that is a proper prefix of another goes by an anti-join; what is
left are the leaves. The nodes of the trie are the prefixes of the weighted sequences,
aggregated, so a group of copies costs one path however many conversations it holds.

No text is shuffled: a turn is two hashes and a length, and a prefix is its depth with sums,
over its turns, of hashes of place and turn (128 bits). Sums are prefix sums, so a long
conversation is worked on by many tasks: turns are sorted by range over all conversations,
each task numbers and sums what it has, and only conversations cut by a range's border,
at most two per range, need what came before. A node's subtree sums come from its paths: what
all members weigh comes from the weighted sequences, what each node weighs once from the path
of the smallest conversation through it, which owns it and all of its own nodes below.

Cases: a null role or text is empty; a null turn comes first, and turns of the same number
come in the order of their hashes; repeated rows are turns of their own; rows without id
belong to no conversation; without any conversation there is no node, not even the root.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import landed, small_batches
from tidemark.operators.joins import ROW_BITS, join_under_skew

KEY = ["depth", "k1", "k2"]
GROUP, MOST_LEAD = 5, 8  # a group's first conversation lends the others up to so many turns
BLOCK = 4096  # ids of an end list gathered at a time
HALVES = ("s1", "s2", "s3", "s4")
LOW_HALF = (1 << 32) - 1
NO_PART = -1


@dataclass(frozen=True)
class Trie:
    """Frames of a trie.

    sequences: depth, k1, k2, conv_id (the smallest), weight, total (bytes), leaf;
    ends: depth, k1, k2, block, conv_ids (ascending, in blocks of bounded size);
    nodes: depth, k1, k2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.
    """

    sequences: DataFrame
    ends: DataFrame
    nodes: DataFrame


def _sum(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def ordered_turns(rows: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    """conv, part, place, t1, t2, bytes: turns sorted by range; places of a conversation in a part are gapless."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("conv"),
        F.col(turn_column).alias("turn"),
        F.xxhash64(text(role_column), text(text_column)).alias("t1"),
        F.xxhash64(F.lit(1), text(text_column), text(role_column)).alias("t2"),
        F.octet_length(text(text_column)).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    # the row as the last key lets a range's border fall between repeated rows too
    placed = turns.orderBy("conv", "turn", "t1", "t2", "row").select(
        "conv", "t1", "t2", "bytes", F.monotonically_increasing_id().alias("place")
    )
    return landed(placed, "turns").withColumn("part", F.shiftright("place", ROW_BITS))


def group_leads(conv: Column) -> tuple[Column, Column]:
    """Which conversation lends its first turns to this one, and how many of them at most."""
    return conv - conv % GROUP, F.crc32(conv.cast("string")) % (MOST_LEAD + 1)


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns at their place in the rebuilt conversations, and the conversations that have none.

    The first: conv, part, pos, length, cut, t1, t2, bytes, where a conversation is ``cut``
    if it lies in several parts. A lent turn goes to the part where its new conversation's
    own turns begin.
    """
    runs = turns.groupBy("conv", "part").agg(F.min("place").alias("first_place"), F.count("*").alias("rows"))
    within = Window.partitionBy("conv").orderBy("part")
    runs = runs.select(
        "*", _sum("rows", within.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.sum("rows").over(Window.partitionBy("conv")).alias("own_length"),
    )
    runs = landed(runs, "runs")
    convs = runs.filter("before = 0").select("conv", "own_length")
    base, lead = group_leads(F.col("conv"))
    asked = convs.select("*", base.alias("base"), F.when(base != F.col("conv"), lead).otherwise(0).alias("skipped"))
    lender = convs.select(F.col("conv").alias("base"), F.col("own_length").alias("base_length"))
    lent = F.least("skipped", F.coalesce("base_length", F.lit(0)))
    asked = asked.join(lender, "base", "left").select(
        "conv", "base", "skipped", lent.alias("lent"),
        (lent + F.greatest(F.col("own_length") - F.col("skipped"), F.lit(0))).alias("length"),
    )
    runs = runs.join(asked, "conv")
    holds_first = (F.col("before") <= F.col("skipped")) & (F.col("skipped") < F.col("before") + F.col("rows"))
    homes = runs.groupBy("conv", "base", "lent", "length").agg(
        F.coalesce(F.max(F.when(holds_first, F.col("part"))), F.lit(NO_PART)).alias("part"),
        (F.count("*") > 1).alias("cut"),
    )
    # at most eight conversations have the same base
    borrowers = homes.filter("lent > 0").groupBy(F.col("base").alias("conv")).agg(
        F.collect_list(F.struct("conv", "part", "length", "cut", "lent")).alias("borrowers")
    )
    known = runs.join(borrowers, "conv", "left").select(
        "conv", "part", "first_place", "before", "skipped", "lent", "length",
        (F.col("own_length") > F.col("rows")).alias("cut"), "borrowers",
    )
    pos = F.col("place") - F.col("first_place") + F.col("before")
    own = F.when(
        F.col("pos") >= F.col("skipped"),
        F.array(F.struct("conv", "part", "length", "cut", (F.col("pos") - F.col("skipped") + F.col("lent")).alias("pos"))),
    ).otherwise(F.array())
    passed_on = F.transform(
        F.filter(F.coalesce("borrowers", F.array()), lambda b: F.col("pos") < b["lent"]),
        lambda b: F.struct(
            b["conv"].alias("conv"), b["part"].alias("part"), b["length"].alias("length"), b["cut"].alias("cut"),
            F.col("pos").alias("pos"),
        ),
    )
    placed = turns.join(known, ["conv", "part"]).withColumn("pos", pos)
    rebuilt = placed.select("t1", "t2", "bytes", F.inline(F.concat(own, passed_on)))
    return rebuilt, homes.filter("length = 0").select("conv")


def _halves(first: Column, second: Column) -> list[Column]:
    parts = (F.shiftrightunsigned(first, 32), first.bitwiseAND(LOW_HALF), F.shiftrightunsigned(second, 32), second.bitwiseAND(LOW_HALF))
    return list(parts)


def _key(a: Column, b: Column) -> Column:
    """Two sums modulo 2^32 as one number."""
    return F.shiftleft(a.bitwiseAND(LOW_HALF), 32).bitwiseOR(b.bitwiseAND(LOW_HALF))


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """conv, depth, k1, k2, p1, p2, bytes, before, last: every prefix of every conversation but the empty one.

    ``p1`` and ``p2`` belong to the prefix one turn shorter, ``before`` counts its bytes.
    """
    pos, t1, t2 = F.col("pos"), F.col("t1"), F.col("t2")
    own = [h.alias(f"h{k}") for k, h in enumerate(_halves(F.xxhash64(pos, t1, t2), F.xxhash64(t2, pos, t1)), 1)]
    turns = rebuilt.select("conv", "part", "pos", "bytes", "cut", (pos + 1 == F.col("length")).alias("last"), *own)
    upto = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = landed(
        turns.select("*", *[F.sum(f"h{k}").over(upto).alias(s) for k, s in enumerate(HALVES, 1)], F.sum("bytes").over(upto).alias("upto")),
        "prefixes",
    )
    # conversations cut by a range's border: at most two for each part
    sums = [*HALVES, "upto"]
    cut = summed.filter("cut").groupBy("conv", "part").agg(*[F.max(s).alias(s) for s in sums])
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.select("conv", "part", *[_sum(s, earlier).alias(f"earlier_{s}") for s in sums])
    whole = summed.join(F.broadcast(carried), ["conv", "part"], "left").select(
        "conv", "pos", "bytes", "last", "h1", "h2", "h3", "h4",
        *[(F.col(s) + F.coalesce(f"earlier_{s}", F.lit(0))).alias(s) for s in sums],
    )
    s1, s2, s3, s4 = (F.col(s) for s in HALVES)
    h1, h2, h3, h4 = (F.col(f"h{k}") for k in range(1, 5))
    return whole.select(
        "conv", (F.col("pos") + 1).cast("bigint").alias("depth"), _key(s1, s2).alias("k1"), _key(s3, s4).alias("k2"),
        _key(s1 - h1, s2 - h2).alias("p1"), _key(s3 - h3, s4 - h4).alias("p2"),
        "bytes", (F.col("upto") - F.col("bytes")).alias("before"), "last",
    )


def weighted_sequences(steps: DataFrame, turnless: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal conversations as one: (depth, k1, k2, conv_id, weight, total), and their end lists in blocks."""
    none = F.lit(0).cast("bigint")
    whole = steps.filter("last").select("conv", *KEY, (F.col("before") + F.col("bytes")).alias("total")).unionByName(
        turnless.select("conv", *[none.alias(k) for k in KEY], none.alias("total"))
    )
    ends = landed(
        whole.groupBy(*KEY, F.floor(F.col("conv") / BLOCK).alias("block"))
        .agg(F.array_sort(F.collect_list("conv")).alias("conv_ids"), F.min("total").alias("total")),
        "ends",
    )
    sequences = ends.groupBy(*KEY).agg(
        F.min(F.col("conv_ids")[0]).alias("conv_id"), F.sum(F.size("conv_ids")).alias("weight"), F.min("total").alias("total")
    )
    return sequences, ends.drop("total")


def collapse(rebuilt: DataFrame, turnless: DataFrame) -> Trie:
    """The trie of conversations given as turns at their places (see ``rebuilt_turns``)."""
    steps = prefixes(rebuilt)
    sequences, ends = weighted_sequences(steps, turnless)
    sequences = landed(sequences, "sequences")
    root = [F.lit(0).cast("bigint").alias(k) for k in KEY]
    proper = steps.filter("not last").select(*KEY).distinct()
    proper = proper.unionByName(sequences.filter("depth > 0").limit(1).select(*root))
    leaves = sequences.join(proper, KEY, "left_anti").select(F.col("conv_id").alias("conv"), F.lit(1).alias("leaf"))
    heads = sequences.select(F.col("conv_id").alias("conv"), "weight", "total", F.col("depth").alias("length"), "k1", "k2")
    heads = landed(heads.join(leaves, "conv", "left").fillna(0, ["leaf"]), "heads")
    read = ["conv", "weight", "total", "leaf"]
    followed = join_under_skew(steps, heads.select(read), ["conv"]).filter("weight is not null").drop("last")
    empty = heads.select(
        *read, *root, F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
        F.lit(0).cast("bigint").alias("bytes"), F.lit(0).cast("bigint").alias("before"),
    )
    paths = landed(followed.unionByName(empty), "paths")
    nodes = landed(
        paths.groupBy(*KEY).agg(
            F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
            F.sum(F.col("weight") * (F.col("total") - F.col("before"))).alias("weighted"),
            F.min("before").alias("before"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        ),
        "nodes",
    )
    owners = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("before").alias("owned_from"))
    once = (
        join_under_skew(paths.select("conv", *KEY, "total", "before"), owners, ["conv"])
        .filter("owned_from is not null")
        .groupBy(*KEY).agg(F.sum(F.col("total") - F.greatest("before", "owned_from")).alias("once"))
    )
    inner = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = inner.agg(F.count("*").alias("children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    full = join_under_skew(nodes, parents, ["depth", "p1", "p2"]).join(once, KEY, "left").join(children, KEY, "left")
    result = full.select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"), (F.col("weighted") - F.coalesce("once", F.lit(0))).alias("saved_tokens"),
    )
    return Trie(sequences, ends, result)


def ends_digests(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256: a digest of each end list, ids ascending and joined by commas.

    A digest is sequential by nature; blocks come in order and are taken in one by one, so
    the longest list costs time in one task but no memory.
    """
    small_batches(ends.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, digest = None, None
        for batch in batches:
            done = []
            keys = zip(*[batch.column(k).to_pylist() for k in range(3)])
            for key, piece in zip(keys, batch.column(3).to_pylist()):
                if key != open_key:
                    if open_key is not None:
                        done.append((*open_key, digest.hexdigest()))
                    open_key, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
            yield packed(done)
        if open_key is not None:
            yield packed([(*open_key, digest.hexdigest())])

    def packed(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [(), (), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*KEY, "ends_sha256"])

    pieces = ends.select(*KEY, "block", F.array_join(F.col("conv_ids").cast("array<string>"), ",").alias("piece"))
    in_order = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "piece")
    return in_order.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")
