"""Bounded-space best-fit packing of token sequences."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Tokens of a sequence, open bins of a task, id behind each document.
SEQUENCE, OPEN_BINS, END = 2048, 512, 0
#: A word or a stretch of white space longer than this goes through the slower library, whose merges stay near-linear.
LONG_RUN = 1000
#: Bytes of ids handed to Spark at a time.
BATCH_BYTES = 8 << 20


class BestFit:
    """Online best fit over a fixed number of open bins; a bitset has a one for each free space that some open bin has."""

    def __init__(self, size: int = SEQUENCE, bins: int = OPEN_BINS):
        self.size, self.bins, self.open, self.made = size, bins, 0, 0
        self.spaces = 0
        self.by_space: dict[int, list[int]] = {}

    def _take(self, space: int) -> int:
        held = self.by_space[space]
        bin_ = held.pop()
        if not held:
            self.spaces ^= 1 << space
        self.open -= 1
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to ``size`` tokens."""
        fits = self.spaces >> length
        if fits:  # the least free space that is enough
            space = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(space)
        else:
            if self.open >= self.bins:  # the fullest closes
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            space, bin_, self.made = self.size, self.made, self.made + 1
        left = space - length
        if left:
            self.by_space.setdefault(left, []).append(bin_)
            self.spaces |= 1 << left
            self.open += 1
        return bin_, self.size - space


def _bytes_of_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of a byte-level BPE file of ``tokenizers``, special tokens not added.  With ``added`` the ids are those of
    ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``, which recognises the added tokens of the file in a text;
    without it such a token is text like any other.

    The vocabulary is read from that file; ordinary text is encoded with ``tiktoken`` from the same vocabulary (four times as fast,
    the same ids: a test compares both), text with very long words or white space, or with an added token, with
    ``tokenizers`` itself.
    """

    def __init__(self, path: str, pattern: str, added: bool = False):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        chars = _bytes_of_chars()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not added
        self.added = [t["content"] for t in spec["added_tokens"]] if added else []

    def ids(self, text: str) -> np.ndarray:
        words = text.split()
        longest = max(map(len, words), default=0)
        if any(t in text for t in self.added) or longest > LONG_RUN or len(text) - sum(map(len, words)) > 2 * len(words) + LONG_RUN:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, added: bool = False) -> Encoder:
    return Encoder(path, pattern, added)


def cut(length: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only one longer than ``size`` is cut, and its first piece is the shorter one."""
    first = length % size or min(length, size)
    return [(0, first), *((at, size) for at in range(first, length, size))]


def pack(docs: DataFrame, tokenizer: str, pattern: str, size: int = SEQUENCE, bins: int = OPEN_BINS, end: int = END) -> DataFrame:
    """Pieces of the rows of ``docs`` (doc_id, text) in sequences of at most ``size`` tokens.

    Columns: doc_id, piece (from 0), start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.  ``tokenizer`` is a
    byte-level file of the library tokenizers and ``pattern`` the expression that splits text before its merges.  An added token
    of the file that a text holds has the id of that token, as in ``tokenizers``.  Each document is followed by the id ``end``.

    Every task packs its documents as they come with best fit over ``bins`` open bins, in bounded memory and without a shuffle; a
    repeated task gives the same sequences, as it reads the same rows.  What stays open at the end of a task is one partly filled set
    of bins for each input split, not for each document.  Null and empty texts are documents of the one id ``end``; repeated rows and
    null ids are packed each on its own; an empty table gives an empty result; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer, pattern, added=True), BestFit(size, bins)
        first_id = TaskContext.get().partitionId() << 40
        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode.ids(text.as_py() or ""), np.uint32(end)).astype("<u4", copy=False)
                for piece, (start, length) in enumerate(cut(len(ids), size)):
                    bin_, offset = packer.place(length)
                    rows.append((doc_id, piece, start, length, ids[start : start + length].tobytes(), first_id + bin_, offset))
                    held += 4 * length
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(work, "doc_id bigint, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint")
