"""Language-model scoring by a probabilistic suffix tree.

A text's tokens are its words and an end, each a symbol of its own. Contexts are the one to
``DEPTH`` tokens before, and one of them becomes a state of the tree if its next-token
distribution departs from that of the next shorter context: its count times the divergence,
over next tokens seen at least ``seldom`` times after it, must reach ``gain``. A state keeps
the next tokens that differ from the shorter state; the others share what is left in the
proportions of the shorter state, so every distribution sums to one. A token is scored from
the longest state that is a suffix of what came before. Without context a token has its
share of the counts, and tokens never seen in training together have the share that tokens
seen once have (Good and Turing); like in the unigram base they count as one.

Everything counted and the tree are Spark tables that grow with the training texts: nothing
is ranked away. A run of tokens is counted where the run without its last token is seen
``least`` times and the run without its first one ``seldom`` times; others cannot pass the
test, so no state is lost. These two are looked up in bitmaps of fixed size, and so is, found by
a first pass over halves of hashes, what is itself seen ``seldom`` times; their false hits
cost work and change no count.

The logarithm of a token's probability is a sum: that of the token alone, for every suffix
that is a state its share left to the shorter one, and for every kept next token what it
differs by. So a text's score is a sum over the keys of the tree that occur in it. The
``CACHED`` keys and ``FREQUENT`` tokens that occur most go to the tasks. Others are looked up
by slices of the tree and of the tokens: what a part of the texts asks of a slice is one
row of the shuffle, and so is what the slice answers them.

Tokens and runs of tokens are known by 64 bits of hash; two alike would share their counts.

Cases: null text is the empty one, so its only token is the end; null ids count as
training; without training texts every token is an unseen one; repeated rows are scored
each and count each; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import collected, landed, parted, released, small_batches, whole_text

DEPTH = 3
FREQUENT = 150_000
CACHED = 1_200_000
SUMMED = 1_000_000
HANDED_ON = 100_000
ASKED = 1_000_000
TURNS = 2
SLICE = 250_000
COUNTED = 1_000_000
BITS = 26
# a dictionary that holds the distinct tokens of a file, so that they are written as their places in it
landed_tokens = partial(landed, **{"parquet.dictionary.page.size": str(8 << 20)})


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


END = hashes([b""])[0]


def coded(texts: pa.Array) -> pa.Array:
    """Hashes of each text's words in lower case, then of the empty one as its end."""
    words, which, ends = parted(texts)
    flat = hashes([*words, b""])[np.insert(which, ends, len(words))]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends + 1 + np.arange(len(ends))]), pa.int32()), pa.array(flat))


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return a ^ (a >> np.uint64(33))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def whole(context: np.ndarray, short: np.ndarray, k: int) -> np.ndarray:
    """The run whose first ``k`` tokens are the context, and whose last ones are ``short``."""
    return _mixed(context * np.uint64(0x9E3779B97F4A7C15) + _mixed(short) + np.uint64(k))


def runs(flat: np.ndarray, sizes: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For contexts of 1 to ``depth`` tokens: the text of each place, its context, context and token, these without the first."""
    starts = np.cumsum(sizes) - sizes
    every = np.insert(flat, starts, END).astype(np.int64).view(np.uint64)  # the end stands before a text
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(every)) - np.repeat(starts + np.arange(len(sizes)), sizes + 1)
    run = every
    for k in range(1, depth + 1):
        longer = np.zeros_like(run)
        longer[1:] = whole(run[:-1], run[1:], k)
        at = np.flatnonzero(place >= k)
        yield text[at], run[at - 1].view(np.int64), longer[at].view(np.int64), run[at].view(np.int64)
        run = longer


def state_key(context: np.ndarray) -> np.ndarray:
    """The key of a context as a state, other than that of the same run as a kept token."""
    return _mixed(context.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)).view(np.int64)


_TWO_BITS = ((np.uint64(1) << np.arange(64, dtype=np.uint64))[:, None] | (np.uint64(1) << np.arange(64, dtype=np.uint64))).ravel().view(np.int64)


class Bitmap:
    """Of the hashes in a table: true for all of them and for few others. Each has two bits of a cell, told by its upper half."""

    def __init__(self, cells: DataFrame) -> None:
        """From cell, bits."""
        found = collected(cells)
        self.cells = np.zeros(1 << (BITS - 6), np.int64)
        np.bitwise_or.at(self.cells, found["cell"].to_numpy(), found["bits"].to_numpy())

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> Bitmap:
        cell = F.shiftrightunsigned(F.col(column), 70 - BITS)
        bits = F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - BITS - 6 * k}) & 63 AS int))" for k in (0, 1)))
        return cls(keys.select(cell.alias("cell"), bits.alias("bits")).groupBy("cell").agg(F.bit_or("bits").alias("bits")))

    @staticmethod
    def placed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell and the bits of each key."""
        keys = keys.view(np.uint64)
        return (keys >> np.uint64(70 - BITS)).view(np.int64), _TWO_BITS[((keys >> np.uint64(58 - BITS)) & np.uint64(4095)).view(np.int64)]

    def has(self, keys: np.ndarray) -> np.ndarray:
        cells, bits = self.placed(keys)
        return self.cells[cells] & bits == bits


def _summed(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    """Counts by the first column; the others are functions of it. Only the last ones, as many as names, are handed on."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    _, first, n = np.unique(columns[0], return_index=True, return_counts=True)
    sent = columns[-len(names):]
    return pa.RecordBatch.from_arrays([*(pa.array(c[first]) for c in sent), pa.array(n.astype(np.int64))], names=[*names, "n"])


def _gathered(parts: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task, summed over ``SUMMED`` places at a time and handed on in small batches."""
    held: list[tuple[np.ndarray, ...]] = []

    def batches() -> Iterator[pa.RecordBatch]:
        summed = _summed(held, names)
        held.clear()
        for at in range(0, summed.num_rows, HANDED_ON):
            yield summed.slice(at, HANDED_ON)

    for part in parts:
        held.append(part)
        if sum(len(x[0]) for x in held) > SUMMED:
            yield from batches()
    if held:
        yield from batches()


def counts(training: DataFrame) -> DataFrame:
    """token, c: over the hashes in ``tokens``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gathered(((_flat(b.column(0))[0],) for b in batches if len(b)), ["token"])

    partial = training.select("tokens").mapInArrow(run, "token bigint, n bigint")
    return landed(partial.groupBy("token").agg(F.sum("n").alias("c")), "tokens")


@dataclass
class Words:
    """The most frequent tokens in order, their counts, and the sums over all tokens."""

    keys: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    once: int

    @property
    def unseen(self) -> float:
        """Probability of tokens never seen."""
        return min(max(self.once, 0.5) / (self.total + 1), 0.999)

    @property
    def each(self) -> float:
        """Probability of a token without context, per count of it."""
        return (1 - self.unseen) / max(self.total, 1)


class Places:
    """Where each of some ordered hashes stands; equal ranges of them, as many as keys at least, tell where to look."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.shift = keys, np.uint64(64 - max(len(keys).bit_length(), 1))
        of_range = np.bincount(self._ranges(keys), minlength=1 << (64 - int(self.shift)))
        self.starts = np.concatenate([[0], np.cumsum(of_range)]).astype(np.int32)

    def _ranges(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).astype(np.int64)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted one, or -1."""
        found, ranges = np.full(len(wanted), -1), self._ranges(wanted)
        at, end = self.starts[ranges], self.starts[ranges + 1]
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], wanted[left]
        while len(left):
            same = self.keys[at] == wanted
            found[left[same]] = at[same]
            at = at + 1
            more = ~same & (at < end)
            left, at, end, wanted = left[more], at[more], end[more], wanted[more]
        return found


def _slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    """Slices are equal ranges of the upper half of a key, which is a hash."""
    return ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def _cut(which: np.ndarray, slices: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each slice with the places where it is, in order."""
    # short numbers are ordered in one go
    order = np.argsort(which.astype(np.uint16) if slices <= 1 << 16 else which, kind="stable")
    ends = np.cumsum(np.bincount(which, minlength=slices))
    for k, (start, end) in enumerate(zip(np.concatenate([[0], ends]), ends)):
        if start < end:
            yield k, order[start:end]


def _ends(ordered: np.ndarray) -> np.ndarray:
    """Where another value begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]]))


def _small(values: np.ndarray) -> bytes:
    return pa.compress(values, codec="zstd", asbytes=True)


def _back(column: pa.Array, counts: list[int], kind: type) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    return [np.frombuffer(pa.decompress(x.as_buffer(), n * size, codec="zstd"), kind) for x, n in zip(column, counts)]


def _candidates(batches: Iterator[pa.RecordBatch], k: int, may: Callable[..., np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Runs, their contexts and these without the first token and with the last, where ``may`` allows it: ``SUMMED`` places at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if len(batch):
            *_, (_, context, own, short) = runs(*_flat(batch.column(0)), k)
            sent = may(own, context, short)
            held.append((own[sent], context[sent], short[sent]))
        if sum(len(x[0]) for x in held) > SUMMED:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            yield columns
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def seen_often(training: DataFrame, k: int, may: Callable[..., np.ndarray], places: int, seldom: int) -> Bitmap:
    """Runs that ``may`` allows and that are seen ``seldom`` times at least: by the upper half of their hash, so a few others too.

    Most runs are seen once or twice, and here one is sent as what it differs by from the one before, which is a few bytes.
    """
    slices = max(1, math.ceil(places / COUNTED))
    kinds = pa.schema([("halves", pa.binary()), ("n", pa.binary()), ("rows", pa.int64()), ("slice", pa.int64())])

    def sent_rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        halves = np.sort(np.concatenate(held))
        first = _ends(halves)
        n = np.minimum(np.diff(np.append(first, len(halves))), 255).astype(np.uint8)
        halves = halves[first]
        # the first half of each slice
        least = np.array([-(-(k << 32) // slices) for k in range(slices)], np.uint32)
        cuts = [*np.searchsorted(halves, least).tolist(), len(halves)]
        for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if start < end:
                steps = np.diff(halves[start:end], prepend=np.uint32(0))
                yield pa.RecordBatch.from_pylist(
                    [{"halves": _small(steps), "n": _small(n[start:end]), "rows": end - start, "slice": piece}], kinds
                )

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for own, _, _ in _candidates(batches, k, may):
            held.append((own.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
            if sum(map(len, held)) > 2 * SUMMED:
                yield from sent_rows(held)
                held.clear()
        if held:
            yield from sent_rows(held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves, counts = [], []
        for batch in batches:
            rows = batch.column("rows").to_pylist()
            halves += [np.cumsum(steps, dtype=np.uint32) for steps in _back(batch.column("halves"), rows, np.uint32)]
            counts += _back(batch.column("n"), rows, np.uint8)
        found = np.concatenate(halves)
        order = np.argsort(found)
        found = found[order]
        first = _ends(found)
        n = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), first)
        cells, bits = Bitmap.placed(found[first][n >= seldom].astype(np.uint64) << np.uint64(32))
        first = _ends(cells)
        bits = np.bitwise_or.reduceat(bits, first) if len(first) else bits
        yield pa.RecordBatch.from_arrays([pa.array(cells[first]), pa.array(bits)], names=["cell", "bits"])

    sent = training.select("tokens").mapInArrow(seen, "halves binary, n binary, rows bigint, slice bigint")
    return Bitmap(sent.groupBy("slice").applyInArrow(summed, "cell bigint, bits bigint"))


def runs_seen(training: DataFrame, k: int, may: Callable[..., np.ndarray], places: int, seldom: int) -> DataFrame:
    """context, short, n, run: how often a token follows each ``k`` of them, where ``may`` allows it and at least ``seldom`` times.

    Runs are cut into slices of at most ``COUNTED`` of the ``places`` on average, by their context and, as one context may
    have many tokens after it, a part of these. What a task has seen of a slice, half ``SUMMED`` runs at a time, is one row
    of the shuffle, contexts in order and compressed.
    """
    slices = max(1, math.ceil(places / COUNTED))
    parts = max(1, slices // 16)

    def together(own: np.ndarray, context: np.ndarray, short: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        upper = np.uint64(0xFFFFFFFF00000000)
        # a run that another one parts in this order has two partial counts
        order = np.argsort((context.view(np.uint64) & upper) | (own.view(np.uint64) & ~upper))
        first = _ends(own[order])
        at = order[first]
        return own[at], context[at], short[at], np.add.reduceat(n[order], first, dtype=np.int32) if len(first) else n

    def sent_rows(_: np.ndarray, context: np.ndarray, short: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = _slice_of(short, parts).view(np.uint64)
        for piece, of in _cut(_slice_of(_mixed(context.view(np.uint64) + _mixed(part)), slices), slices):
            yield pa.RecordBatch.from_pylist(
                [{"context": _small(context[of]), "short": _small(short[of]), "n": _small(n[of]), "rows": len(of), "slice": piece}], kinds
            )

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        for columns in _candidates(batches, k, may):
            columns.append(np.ones(len(columns[0]), np.int32))
            held = together(*(columns if held is None else map(np.concatenate, zip(held, columns))))
            if len(held[0]) > SUMMED // 2:
                yield from sent_rows(*held)
                held = None
        if held is not None:
            yield from sent_rows(*held)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            counts = batch.column("rows").to_pylist()
            for held, name, kind in zip(pieces, ("context", "short", "n"), (np.int64, np.int64, np.int32)):
                held += _back(batch.column(name), counts, kind)
        context, short, n = (np.concatenate(held).astype(np.int64, copy=False) for held in pieces)
        run = whole(context.view(np.uint64), short.view(np.uint64), k).view(np.int64)
        order = np.argsort(run)
        first = _ends(run[order])
        n = np.add.reduceat(n[order], first) if len(first) else n
        often = n >= seldom
        at = order[first][often]
        out = pa.RecordBatch.from_arrays([pa.array(x) for x in (context[at], short[at], n[often], run[at])], names=["context", "short", "n", "run"])
        for start in range(0, len(out), HANDED_ON):
            yield out.slice(start, HANDED_ON)

    kinds = pa.schema([("context", pa.binary()), ("short", pa.binary()), ("n", pa.binary()), ("rows", pa.int64()), ("slice", pa.int64())])
    sent = training.select("tokens").mapInArrow(seen, "context binary, short binary, n binary, rows bigint, slice bigint")
    return sent.groupBy("slice").applyInArrow(summed, "context bigint, short bigint, n bigint, run bigint")


def grow(
    training: DataFrame, counted: DataFrame, words: Words, least: int = 20, seldom: int = 3, gain: float = 20.0, part: float = 3.0,
    weight: float = 4.0, depth: int = DEPTH,
) -> DataFrame:
    """key, value, n, state: what each state leaves to the shorter one, and what each kept next token differs by."""
    session = training.sparkSession
    shorter = counted.select(F.col("token").alias("run"), F.col("c").alias("n"), (F.col("c") * F.lit(words.each)).alias("p"))
    model = []
    for k in range(1, depth + 1):
        sent = session.sparkContext.broadcast((Bitmap.of(shorter.filter(F.col("n") >= least), "run"), Bitmap.of(shorter.filter(F.col("n") >= seldom), "run")))

        def may(own: np.ndarray, context: np.ndarray, short: np.ndarray, sent=sent) -> np.ndarray:
            before, last = sent.value
            at = np.flatnonzero(before.has(context))
            return at[last.has(short[at])]

        # few runs with the longest contexts are seen but once, so these are counted at once
        of_them = [session.sparkContext.broadcast(seen_often(training, k, may, words.total, seldom))] if k < depth else []

        def may_count(own: np.ndarray, context: np.ndarray, short: np.ndarray, may=may, of_them=of_them) -> np.ndarray:
            at = np.flatnonzero(of_them[0].value.has(own)) if of_them else np.arange(len(own))
            return at[may(own[at], context[at], short[at])]

        often = landed(runs_seen(training, k, may_count, words.total, seldom), "runs")
        for used in (sent, *of_them):
            used.destroy()
        totals = shorter.filter(F.col("n") >= least).select(F.col("run").alias("context"), F.col("n").alias("total"))
        p = shorter.select(F.col("run").alias("short"), F.col("p").alias("p_short"))
        each = landed(
            often.join(totals, "context").join(p, "short")
            .withColumn("part", F.col("n") * F.log(F.col("n") / F.col("total") / F.col("p_short")))
            .withColumn("p_own", (F.col("n") + weight * F.col("p_short")) / (F.col("total") + weight)), "tested",
        )
        released(often)
        if model:
            released(shorter)
        keeps = F.abs("part") >= part
        states = each.groupBy("context").agg(
            F.sum("part").alias("gain"), F.first("total").alias("total"), F.count_if(keeps).alias("kept"),
            (F.greatest(1 - F.coalesce(F.sum(F.when(keeps, F.col("p_own"))), F.lit(0.0)), F.lit(1e-12))
             / F.greatest(1 - F.coalesce(F.sum(F.when(keeps, F.col("p_short"))), F.lit(0.0)), F.lit(1e-12))).alias("left"),
        ).filter((F.col("gain") >= gain) & (F.col("kept") > 0))
        states = landed(states.select("context", "total", "left"), "states")
        told = each.join(states.select("context", "left"), "context", "left").withColumn("kept", keeps & F.col("left").isNotNull())
        own = F.when(F.col("kept"), F.col("p_own")).otherwise(F.col("p_short") * F.coalesce("left", F.lit(1.0)))
        differs = F.when(F.col("kept"), F.log10(F.col("p_own") / F.col("p_short") / F.col("left")))
        shorter = landed(told.select("run", "n", own.alias("p"), differs.alias("differs")), "shorter")
        released(each)
        key = F.arrow_udf(lambda c: pa.array(state_key(c.to_numpy(zero_copy_only=False).astype(np.int64))), "bigint")
        model.append(states.select(key("context").alias("key"), F.log10("left").alias("value"), F.col("total").alias("n"), F.lit(True).alias("state")))
        model.append(landed(shorter.filter("differs is not null").select(F.col("run").alias("key"), F.col("differs").alias("value"), "n", F.lit(False).alias("state")), "kept"))
    every = model[0]
    for more in model[1:]:
        every = every.union(more)
    tree = landed(every, "tree")
    released(*model, *([shorter] if model else []))
    return tree


def held_out(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 7 == 2, F.lit(False))


def learned(counted: DataFrame) -> Words:
    n, v, once = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum((F.col("c") == 1).cast("bigint")), F.lit(0))
    ).first()
    top = collected(counted.orderBy(F.desc("c"), "token").limit(FREQUENT))
    keys, own = top["token"].to_numpy().astype(np.int64), top["c"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    return Words(keys[order], own[order], int(n), int(v), int(once))


_EXCHANGED = {
    "slice": pa.int64(), "part": pa.int64(), "rows": pa.list_(pa.int64()), "sizes": pa.list_(pa.int32()),
    "keys": pa.list_(pa.int64()), "found": pa.list_(pa.float64()),
}
_EXCHANGED_COLUMNS = "slice bigint, part bigint, rows array<bigint>, sizes array<int>, keys array<bigint>, found array<double>"
_ANSWERED_COLUMNS = "part bigint, rows array<bigint>, found array<double>"


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([columns.get(n)], kind) for n, kind in _EXCHANGED.items()], names=list(_EXCHANGED))


def looked_up(
    asked: DataFrame, tree: DataFrame, names: tuple[str, ...] = ("value",), terms: Callable[[np.ndarray], tuple[np.ndarray, ...]] = lambda x: (x,)
) -> DataFrame:
    """row, value: for parts of each row, the sum of the values of its keys that are in the tree. From row, further.

    With ``names``, as many sums: of each of the ``terms`` that they make of a value. The tree is cut into slices of about
    ``SLICE`` keys, and a task reads a slice before what is asked of it, a part at a time. A part is consecutive rows with
    ``ASKED`` keys; its answers meet again, so a row comes out once or twice for each of the ``TURNS`` in which slices are
    asked: what a turn has shuffled goes before the next.
    """
    slices = max(1, math.ceil(tree.count() / SLICE))

    def questions(held: list[tuple[np.ndarray, np.ndarray]], turn: int) -> Iterator[pa.RecordBatch]:
        rows, keys = (np.concatenate(c) for c in zip(*held))
        for k, at in _cut(_slice_of(keys, slices), slices):
            if k % TURNS != turn:
                continue
            mine = rows[at]
            first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            yield _row(slice=k, part=rows[0], rows=mine[first], sizes=np.diff(np.append(first, len(mine))), keys=keys[at])

    def ask(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            keys, sizes = _flat(batch.column(1))
            if len(keys):
                held.append((np.repeat(batch.column(0).to_numpy(), sizes), keys))
            if sum(len(keys) for _, keys in held) > ASKED:
                yield from questions(held, turn)
                held.clear()
        if held:
            yield from questions(held, turn)

    def spread(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def cut() -> Iterator[pa.RecordBatch]:
            keys, values = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in (0, 1))
            for k, at in _cut(_slice_of(keys, slices), slices):
                if k % TURNS == turn:
                    yield _row(slice=k, keys=keys[at], found=values[at])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) > ASKED:
                yield from cut()
                held.clear()
        if held:
            yield from cut()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, pieces = None, []
        for batch in batches:
            slice_of, part = (batch.column(c).to_pylist() for c in (0, 1))
            lists = [[batch.column(c)[i].values for c in range(2, 6)] for i in range(len(batch))]
            for k, p, (rows, sizes, sought, found) in zip(slice_of, part, lists):
                if k != current:
                    current, pieces, places, values = k, [], Places(np.empty(0, np.int64)), terms(np.empty(0))
                sought = sought.to_numpy(zero_copy_only=False)
                if p is None:
                    pieces.append((sought.copy(), found.to_numpy(zero_copy_only=False).copy()))
                    continue
                if pieces:
                    keys, values = (np.concatenate(c) for c in zip(*pieces))
                    order = np.argsort(keys)
                    pieces, places, values = [], Places(keys[order]), terms(values[order])
                at = places.of(sought)
                here = np.flatnonzero(at >= 0)
                if len(here):
                    at, row_of = at[here], np.repeat(np.arange(len(rows)), sizes.to_numpy(zero_copy_only=False))[here]
                    first = _ends(row_of)
                    sums = np.stack([np.add.reduceat(v[at], first) for v in values], 1).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p]), pa.array([rows.to_numpy(zero_copy_only=False)[row_of[first]]], pa.list_(pa.int64())),
                         pa.array([sums], pa.list_(pa.float64()))], names=["part", "rows", "found"],
                    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def summed() -> pa.RecordBatch:
            rows, found = (np.concatenate(c) for c in zip(*held))
            each, at = np.unique(rows, return_inverse=True)
            sums = [pa.array(np.bincount(at, of, len(each))) for of in found.reshape(-1, len(names)).T]
            return pa.RecordBatch.from_arrays([pa.array(each), *sums], names=["row", *names])

        for batch in batches:
            for i, p in enumerate(batch.column(0).to_pylist()):
                if held and (p != current or sum(len(x) for x, _ in held) > ASKED):
                    yield summed()
                    held = []
                current = p
                held.append(tuple(batch.column(c)[i].values.to_numpy(zero_copy_only=False).copy() for c in (1, 2)))
        if held:
            yield summed()

    schema, found = "row bigint, " + ", ".join(f"{name} double" for name in names), None
    for turn in range(min(TURNS, slices)):
        pieces = tree.select("key", "value").mapInArrow(partial(spread, turn=turn), _EXCHANGED_COLUMNS)
        questions_of = asked.select("row", "further").mapInArrow(partial(ask, turn=turn), _EXCHANGED_COLUMNS)
        # null first: a slice's keys stand before what is asked of it
        met = pieces.union(questions_of).repartition("slice").sortWithinPartitions("slice", F.col("part").asc_nulls_first())
        answers = met.mapInArrow(answer, _ANSWERED_COLUMNS)
        sums = landed(answers.repartition("part").sortWithinPartitions("part").mapInArrow(add, schema), "answers")
        found = sums if found is None else found.union(sums)
    return found


def scored(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", cached: int = CACHED, depth: int = DEPTH
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per row of ``docs``."""
    session = docs.sparkSession
    small_batches(session)
    rows = landed_tokens(docs.select(
        F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.monotonically_increasing_id().alias("row"),
        F.arrow_udf(coded, "array<bigint>")(whole_text(text_column)).alias("tokens"),
    ), "coded")
    training = rows.filter(~F.col("held_out"))
    counted = counts(training)
    words = learned(counted)
    tree = grow(training, counted, words, depth=depth)
    bitmaps = [Bitmap.of(tree.filter(F.col("state") == of), "key") for of in (True, False)]
    tree = tree.select("key", "value", "n")
    top = collected(tree.orderBy(F.desc("n"), "key").limit(cached))
    keys = top["key"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    sent = session.sparkContext.broadcast((words, Places(words.keys), Places(keys[order]), top["value"].to_numpy().astype(float)[order], *bitmaps))
    kinds = {
        "n_tokens": pa.int64(), "known": pa.int64(), "logs": pa.float64(), "score": pa.float64(),
        "rare": pa.list_(pa.int64()), "further": pa.list_(pa.int64()),
    }
    schema = "struct<n_tokens:bigint,known:bigint,logs:double,score:double,rare:array<bigint>,further:array<bigint>>"

    def listed(values: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
        order = np.argsort(text.astype(np.uint16) if n <= 1 << 16 else text, kind="stable")
        cut = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values[order], pa.int64()))

    def run(lists: pa.Array) -> pa.Array:
        words, frequent, cached, values, states, others = sent.value
        n = len(lists)
        if not n:
            return pa.array([], pa.struct(list(kinds.items())))
        flat, sizes = _flat(lists)
        text = np.repeat(np.arange(n), sizes)
        at = frequent.of(flat)
        known = at >= 0
        own = words.counts[at[known]]
        by_text = lambda t, x: np.bincount(t, x, n)
        score = by_text(text[known], np.log10(own * words.each))
        further, texts = [], []
        for places, context, whole, _ in runs(flat, sizes, depth):
            key = state_key(context)
            may = states.has(key)
            # only a state keeps next tokens
            after = whole[may]
            kept = others.has(after)
            for key, where in ((key[may], places[may]), (after[kept], places[may][kept])):
                at = cached.of(key)
                here = at >= 0
                score += by_text(where[here], values[at[here]])
                further.append(key[~here])
                texts.append(where[~here])
        columns = [
            pa.array(sizes), pa.array(np.bincount(text[known], minlength=n)), pa.array(by_text(text[known], np.log10(own + 1.0))),
            pa.array(score), listed(flat[~known], text[~known], n), listed(np.concatenate(further), np.concatenate(texts), n),
        ]
        return pa.StructArray.from_arrays(columns, names=list(kinds))

    first = landed(rows.select("id", "held_out", "row", F.arrow_udf(run, schema)("tokens").alias("s")).select("id", "held_out", "row", "s.*"), "scores")
    released(rows)
    deep = looked_up(first, tree).groupBy("row").agg(F.sum("value").alias("deeper"))
    each = words.each
    # how many are known, and the logarithms for the base and for the score
    sums = ("more", "more_logs", "inner")
    rare = looked_up(
        first.select("row", F.col("rare").alias("further")), counted.select(F.col("token").alias("key"), F.col("c").cast("double").alias("value")),
        sums, lambda c: (np.ones(len(c)), np.log10(c + 1), np.log10(c * each)),
    )
    found = rare.groupBy("row").agg(*[F.sum(name).alias(name) for name in sums])
    found = found.withColumn("more", F.col("more").cast("bigint"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    unseen = F.col("n_tokens") - F.col("known") - zero("more")
    return first.drop("rare", "further").join(found, "row", "left").join(deep, "row", "left").select(
        F.col("id").alias(id_column), "held_out", "n_tokens", (F.col("known") + zero("more")).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + zero("more_logs") - F.col("n_tokens") * F.lit(math.log10(words.total + words.distinct + 1))).alias("base_score"),
        (F.col("score") + zero("deeper") + zero("inner") + unseen * F.lit(math.log10(words.unseen))).alias("score"),
    )
