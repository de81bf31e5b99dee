"""Packing by concatenation and fixed cuts.

All documents stand in one row, each with a closing id. Every task tokenises its
documents once, writes the ids with their start inside the task, and so a task's total is
known; prefix sums over the tasks' totals, one number each, turn those starts into places
in the whole row. Windows of fixed length are then cut at multiples of it, and each piece
carries its boundary record: document, start in the document, length, window and offset.
Only the last window can be shorter. Nothing is shuffled.

Cases: null text is the empty one, so the document is its closing id alone; an empty table
has no pieces; documents with the same or no id are packed as they come; a text of any
length is cut into as many pieces as it needs; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Recent, landed, parted, small_batches, strung, whole_text

SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # all but the apostrophe, which starts endings like 's
PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch  # letters that composing and lower case leave as they are


class WordIds:
    """Ids of white-space separated words, as unsigned 32-bit integers; known words are looked up."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # what the steps before the model make of a plain word is the word itself
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words: dict[bytes, bytes] = Recent("packing", 1.5)

    def of(self, texts: list[str], closing: int) -> list[bytes]:
        return self.coded(pa.array(texts, pa.string()), closing).to_pylist()

    def coded(self, texts: pa.Array, closing: int) -> pa.Array:
        """The vocabulary drops white space and no token crosses it, nor the place where signs follow a
        letter or digit, so words and the signs after them can be encoded one by one."""
        words, which, ends = parted(texts)
        found = list(map(self.words.get, words))
        new = self._new([word for word, ids in zip(words, found) if ids is None])
        pieces = [new[word] if ids is None else ids for word, ids in zip(words, found)]
        self.words.keep_all(new)
        each = np.insert(which, ends, len(words))  # the closing id
        return strung([*pieces, np.uint32(closing).tobytes()], each, ends + 1 + np.arange(len(ends)))

    def _new(self, missing: list[bytes]) -> dict[bytes, bytes]:
        bare = {word: _bare(word) for word in missing}
        parts = {core for core in bare.values() if core} | {word[len(core):] for word, core in bare.items() if len(core) < len(word)}
        new: dict[bytes, bytes] = {}
        plain, other = [], []
        known = {}
        for part in parts:
            ids = self.words.get(part)
            if ids is not None:
                known[part] = ids
            else:
                text = part.decode()
                (plain if PLAIN(text) else other).append(text)
        for at in range(0, len(plain), 1000):
            words = plain[at:at + 1000]
            coded = self.model.encode(" ".join(words), add_special_tokens=False)
            ids, ends = np.array(coded.ids, np.uint32).tobytes(), np.cumsum(np.bincount(coded.word_ids, minlength=len(words)))
            cuts = [0, *(4 * ends).tolist()]
            new.update((word.encode(), ids[a:b]) for word, a, b in zip(words, cuts, cuts[1:]))
        for at in range(0, len(other), 1000):
            words = other[at:at + 1000]
            coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
            new.update((word.encode(), array("I", c.ids).tobytes()) for word, c in zip(words, coded))
        known.update(new)
        for word, core in bare.items():
            if word not in new:
                new[word] = (known[core] if core else b"") + known[word[len(core):]]
        return new


def _bare(word: bytes) -> bytes:
    """The word without the signs after it; itself where what stands before them is no letter or digit,
    or would be none once composed and in lower case, as some letters turn into a letter and a mark."""
    core = word.rstrip(SIGNS)
    if len(core) < len(word) and core and not core[-1:].isalnum():
        last = core[-4:].decode(errors="ignore")[-1:]
        if not (last.isalpha() and unicodedata.normalize("NFC", last).lower()[-1].isalpha()):
            return word
    return core


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenized(docs: DataFrame, path: str, closing: int, id_column: str, text_column: str) -> DataFrame:
    """doc, part (the task), start (of the document in its task, in tokens), tokens, ids."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc"), whole_text(text_column).alias("text"))
    schema = T.StructType(
        [rows.schema["doc"]]
        + [T.StructField(c, T.LongType()) for c in ("part", "start", "tokens")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = word_ids(path).coded(batch.column("text"), closing)
            tokens = pc.binary_length(ids).to_numpy().astype(np.int64) // 4
            starts = total + np.cumsum(tokens) - tokens
            total += int(tokens.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(np.full(len(ids), part)), pa.array(starts), pa.array(tokens),
                 ids],
                names=["doc", "part", "start", "tokens", "ids"],
            )

    return rows.mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, window: int = 4096, closing: int = 2, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: the id column, start, length, doc_tokens, sequence_id, offset, and ids (packed
    little-endian unsigned 32-bit)."""
    coded = landed(tokenized(docs, path, closing, id_column, text_column), "packing")
    placed = coded.join(F.broadcast(_bases(coded)), "part")
    piece: Any = F.struct  # fields below
    at = F.col("base") + F.col("start")
    first, last = F.floor(at / window), F.floor((at + F.col("tokens") - 1) / window)

    def cut(w):
        begin = F.greatest(w * window, F.col("at"))
        end = F.least((w + 1) * window, F.col("at") + F.col("tokens"))
        return piece(
            (begin - F.col("at")).alias("start"),
            (end - begin).alias("length"),
            w.alias("sequence_id"),
            (begin - w * window).alias("offset"),
            F.substring("ids", ((begin - F.col("at")) * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"),
        )

    pieces = placed.select("doc", "tokens", at.alias("at"), first.alias("first"), last.alias("last"), "ids").select(
        F.col("doc").alias(id_column),
        F.col("tokens").alias("doc_tokens"),
        F.inline(F.transform(F.sequence("first", "last"), cut)),
    )
    return pieces.select(id_column, "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


def _bases(coded: DataFrame) -> DataFrame:
    """Tokens before each task: prefix sums over one total per task, so of a size bounded by their number."""
    totals = coded.groupBy("part").agg(F.sum("tokens").alias("total"))
    session, sums, base = coded.sparkSession, [], 0
    for part, total in sorted(map(tuple, totals.collect())):
        sums.append((part, base))
        base += total
    return session.createDataFrame(sums, "part bigint, base bigint")
