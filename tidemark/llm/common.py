"""What the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_folder, shared_folder

# Arrow batches to Python stay small whatever the length of a text.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1000
REMEMBERED_BYTES = 96 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Bound what one Python call holds, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def whole_text(column: str = "text") -> Column:
    """The text, or the empty one for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def landed(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write once to the shared folder and read back: work done before is never done again, on any executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.option("compression", "zstd").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collected(df: DataFrame) -> pa.Table:
    """The rows on the driver; what their query has shuffled goes."""
    with _shuffles_freed(df.sparkSession):
        return df.toArrow()


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Once a query has ended, what it has shuffled is of no use."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def released(*frames: DataFrame) -> None:
    """Delete what ``landed`` wrote; only for frames that nothing is read from any more."""
    for df in frames:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            delete_folder(df.sparkSession, folder)


def parted(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words in lower case (A-Z), told apart by the white space of ASCII: each once, which of them stands at each
    place of all texts, and the place after each text's last one."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
    ends = before[np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))]
    words = flat.filter(real).cast(pa.binary()).dictionary_encode()
    return _as_bytes(words.dictionary), words.indices.to_numpy(zero_copy_only=False), ends


def _as_bytes(words: pa.Array) -> list[bytes]:
    """What ``to_pylist`` gives for byte strings without null, cut from their buffer at once."""
    _, offsets, data = words.buffers()
    if not len(words):
        return []
    cuts = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


def strung(pieces: list[bytes], which: np.ndarray, ends: np.ndarray) -> pa.Array:
    """For each text the pieces of its places put together; ``ends`` are the places after its last one."""
    return joined(pa.array(pieces, pa.binary()).take(pa.array(which)), ends)


def joined(flat: pa.Array, ends: np.ndarray) -> pa.Array:
    """Byte strings put together: those up to each of ``ends``, from the one before."""
    _, offsets, data = flat.buffers()
    starts = np.frombuffer(offsets, np.int32, len(flat) + 1) if len(flat) else np.zeros(1, np.int32)
    cuts = starts[np.concatenate([[0], ends]).astype(np.int64)]
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cuts.tobytes()), data or pa.py_buffer(b"")])


def _held(keys: Collection, values: Collection) -> int:
    """Bytes of all these objects and their places in a table."""
    return sum(map(getsizeof, keys)) + sum(map(getsizeof, values)) + 100 * len(keys)


class Recent(dict):
    """A worker's repeated words, bounded by bytes; what is ``keep``-t beyond them starts it afresh.

    One process serves many operators in turn, so the memories of an ``owner`` give way
    as soon as another one keeps something, or says that it begins.
    """

    _all: list[Recent] = []

    def __init__(self, owner: str, share: float = 1.0) -> None:
        super().__init__()
        self.owner, self.most, self.held = owner, int(share * REMEMBERED_BYTES), 0
        Recent._all.append(self)

    def keep(self, key, value):
        self._take_over()
        size = _held((key,), (value,))
        if self.held + size > self.most:
            self.clear()
        self.held += size
        self[key] = value
        return value

    def keep_all(self, new: dict) -> None:
        """Keep what is not yet held, sized up at once; where it does not fit beside the rest, that goes."""
        size = _held(new, new.values())
        if size > self.most:
            for key, value in new.items():
                self.keep(key, value)
            return
        if self.held + size > self.most:
            self.clear()
        self._take_over()
        self.held += size
        self.update(new)

    def _take_over(self) -> None:
        if self.held == 0:
            Recent.leave_to(self.owner)

    @classmethod
    def leave_to(cls, owner: str) -> None:
        """Only this operator's memories stay; for one that keeps none, before its work."""
        for other in cls._all:
            if other.owner != owner and other:
                other.clear()

    def has_room(self, new: dict) -> bool:
        return self.held + _held(new, new.values()) <= self.most

    def clear(self) -> None:
        super().clear()
        self.held = 0
