"""Byte-level BPE by prefix dynamic programming.

Every prefix of a byte string has exactly one token that can end its encoding: the token
whose own predecessor, the last token of the prefix before it, stays apart from it when
the two are merged on their own. ``Prefixes`` keeps that token for every prefix, so

* the encoding is read backwards from the last prefix;
* appending bytes computes the new prefixes only;
* replacing bytes keeps all prefixes before the change, and after it stops as soon as a
  longest token's worth of prefixes ends as it did before.

Texts are cut by the vocabulary's pattern first and each match is encoded by itself.

Cases: null text is the empty one and has no ids; null ids decode to no bytes; a match of
any length takes time in proportion to it; a column that already has the result's name is
replaced; repeated rows give repeated results; ids outside the vocabulary are an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, joined, small_batches, strung, whole_text

TAIL = 3
SHORT = tuple(range(TAIL - 1, 0, -1))


class Vocabulary:
    """Ranks of byte strings, and which tokens can stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks.keys()))
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) >= TAIL:
                lengths.setdefault(token[-TAIL:], set()).add(len(token))
        # by the last bytes, longest first: in running text the long token is the likelier one
        self.lengths = {tail: (*sorted(found, reverse=True), *SHORT) for tail, found in lengths.items()}
        self.longest = max(map(len, ranks), default=1)
        self.apart: dict[int, bool] = Recent("bpe")

    def merged(self, data: bytes) -> list[bytes]:
        """Merge by lowest rank, leftmost first; for the few bytes of two tokens."""
        parts, rank, never = [data[i:i + 1] for i in range(len(data))], self.ranks.get, 1 << 60
        ranked = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranked and (best := min(ranked)) < never:
            at = ranked.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranked[at]
            if at:
                ranked[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranked):
                ranked[at] = rank(parts[at] + parts[at + 1], never)
        return parts

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes gives these two tokens back."""
        key = left << 32 | right
        known = self.apart.get(key)
        if known is None:
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.apart.keep(key, self.merged(a + b) == [a, b])
        return known


class Prefixes:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data = vocabulary, b""
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> Prefixes:
        start = len(self.data)
        self.data += data
        self._reach(start, len(self.data))
        return self

    def follow(self, data: bytes) -> Prefixes:
        """Become another byte string; the prefixes that both have are kept."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        del self.last[same:]
        self.data = data[:same]
        return self.append(data[same:])

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes start..stop; the number of prefixes computed anew."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        same = done = 0
        for end in range(start + 1, len(self.data) + 1):
            self._reach(end - 1, end)
            token = self.last[-1]
            done += 1
            # only prefixes wholly after the change may agree with those of before
            same = same + 1 if end > start + len(new) and token == old[end - shift - 1] else 0
            if same >= self.vocabulary.longest:
                self.last += old[end - shift:]
                break
        return done

    def ids(self) -> list[int]:
        found, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return found[::-1]

    def _reach(self, start: int, stop: int) -> None:
        """Last tokens of the prefixes longer than ``start``, up to ``stop``."""
        v, data, last = self.vocabulary, self.data, self.last
        rank, apart, lengths = v.ranks.get, v.apart.get, v.lengths.get
        for end in range(start + 1, stop + 1):
            for length in lengths(data[max(end - TAIL, 0):end], SHORT):
                before = end - length
                if before < 0 or (token := rank(data[before:end])) is None:
                    continue
                if not before:
                    break
                known = apart(last[before - 1] << 32 | token)
                if known or known is None and v.stay_apart(last[before - 1], token):
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")
            last.append(token)


class Codec:
    """Whole texts to ids and back; words that return are looked up."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.kind = "H" if max(ranks.values(), default=0) < 1 << 16 else "I"
        self.dtype = np.uint16 if self.kind == "H" else np.uint32
        self.bytes_of = pa.array([self.vocabulary.bytes_of.get(i) for i in range(max(ranks.values(), default=-1) + 1)], pa.binary())
        self.words: dict[bytes, bytes] = Recent("bpe", 1.5)  # each with the space before it
        self.inner: dict[str, bytes] = Recent("bpe", 0.5)  # matches without one

    def _coded(self, matches: Iterable[str]) -> dict[str, bytes]:
        """Ids of each match; in order, so that each shares most prefixes with the one before it."""
        at, found = Prefixes(self.vocabulary), {}
        for data, match in sorted((match.encode(), match) for match in matches):
            found[match] = np.array(at.follow(data).ids(), self.dtype).tobytes()
        return found

    def _matches(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of which each starts a match."""
        cut = [self.pattern.findall(text) for text in texts]
        found: dict[str, bytes] = {}
        for match in set().union(*cut):
            known = self.words.get(match[1:].encode()) if match[0] == " " else self.inner.get(match)
            if known is not None:
                found[match] = known
        new = self._coded(set().union(*cut) - found.keys())
        found.update(new)
        self.inner.keep_all({match: ids for match, ids in new.items() if match[0] != " " and len(match) < 64})
        return [b"".join(map(found.__getitem__, matches)) for matches in cut]

    def encode(self, text: str) -> bytes:
        """Ids as packed integers."""
        return self.encode_all(pa.array([text], pa.string()))[0].as_py()

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as packed integers.

        A space between two other characters always starts a match, so the words of a text
        can be encoded one by one, each with the space before it and each once. Words next to
        further white space are joined with it again and left to the pattern.
        """
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().cast(pa.binary()).dictionary_encode()
        words, which = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).copy()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        starts = np.concatenate([[0], ends])[:-1]
        pieces = list(map(self.words.get, words))
        missing, white = [], np.zeros(len(words), bool)
        for at, ids in enumerate(pieces):
            if ids is None:
                word = words[at].decode()
                if not word or word[0].isspace() or word[-1].isspace():
                    white[at] = True
                else:
                    missing.append((at, word))
        new = self._matches([" " + word for _, word in missing])
        for (at, _), ids in zip(missing, new):
            pieces[at] = ids
        self.words.keep_all({words[at]: pieces[at] for at, word in missing if len(word) < 64})
        # what stands next to white space, and the first word of a text, which has no space before it
        apart: list[tuple[int, int]] = []
        first, of = set(starts.tolist()), np.searchsorted(ends, (special := self._apart(white[which], starts, ends)), side="right")
        for at, text in zip(special.tolist(), of.tolist()):
            begin, end = int(starts[text]), int(ends[text])
            if white[which[at]]:
                begin, end = max(at - 1, begin), min(at + 2, end)
            else:
                begin, end = at, at + 1
            if apart and begin < apart[-1][1] and apart[-1][0] >= int(starts[text]):
                apart[-1] = (apart[-1][0], max(apart[-1][1], end))
            else:
                apart.append((begin, end))
        joined = [("" if begin in first else " ") + " ".join(words[k].decode() for k in which[begin:end].tolist()) for begin, end in apart]
        nothing = len(pieces)
        for k, (begin, end) in enumerate(apart):
            which[begin:end] = nothing
            which[begin] = nothing + 1 + k
        return strung([b"" if ids is None else ids for ids in pieces] + [b"", *self._matches(joined)], which, ends)

    @staticmethod
    def _apart(white: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of white words and of first words, in order."""
        marked = white.copy()
        marked[starts[starts < ends]] = True
        return np.flatnonzero(marked)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bytes of each text, whose ids end at the given places."""
        tokens = self.bytes_of.take(pa.array(flat))
        if tokens.null_count:
            raise KeyError("ids outside the vocabulary")
        return joined(tokens, ends)

    def lists(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's ids end."""
        packed = self.encode_all(texts)
        ends = np.cumsum(pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64)) // np.dtype(self.dtype).itemsize
        data = packed.buffers()[2]
        return np.frombuffer(data, self.dtype, int(ends[-1]) if len(ends) else 0).astype(np.int32), ends


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def _listed(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))


def encode(docs: DataFrame, path: str, pattern: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """All columns, and ``ids``: the text's token ids."""
    small_batches(docs.sparkSession)

    def ids_of(texts: pa.Array) -> pa.Array:
        flat, ends = codec(path, pattern).lists(texts)
        return _listed(flat, ends)

    return docs.withColumn(ids_column, F.arrow_udf(ids_of, "array<int>")(whole_text(text_column)))


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ids stand for."""

    def bytes_of(lists: pa.Array) -> pa.Array:
        coder = codec(path, pattern)
        return pa.array([coder.decode(ids or ()) for ids in lists.to_pylist()], pa.binary())

    return F.arrow_udf(bytes_of, "binary")(ids)


def round_trip(docs: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """All columns, ``ids`` and ``decoded``, the bytes they stand for; each text goes to Python once."""
    small_batches(docs.sparkSession)

    def both(texts: pa.Array) -> pa.Array:
        coder = codec(path, pattern)
        flat, ends = coder.lists(texts)
        return pa.StructArray.from_arrays([_listed(flat, ends), coder.decode_all(flat, ends)], names=["ids", "decoded"])

    schema = "struct<ids:array<int>,decoded:binary>"
    rows = docs.drop("ids", "decoded").select(F.struct("*").alias("row"), F.arrow_udf(both, schema)(whole_text(text_column)).alias("both"))
    return rows.select("row.*", "both.*")
