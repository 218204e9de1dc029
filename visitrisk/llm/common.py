"""Helpers that several operators share: stored tables, row keys, Arrow batches and word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.scratch import application_folder
from visitrisk.sources.folders import remove

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that a task works on at a time; arrays of eight times that size live next to them.
BLOCK_BYTES = 1 << 20

_WHERE = np.arange(256)
LOWER = np.where((_WHERE >= 65) & (_WHERE <= 90), _WHERE + 32, _WHERE).astype(np.uint8)
# A byte of a lower-cased word [^\x00-\x2F\x3A-\x60\x7B-\x7F]+: a digit, a letter or part of a wider character.
WORD_BYTE = ((_WHERE >= 48) & (_WHERE <= 57)) | ((_WHERE >= 97) & (_WHERE <= 122)) | (_WHERE >= 128)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def clean_up(spark: SparkSession) -> None:
    """Removes what :func:`stored` wrote in this application. For when its results have been written."""
    remove(spark, application_folder(spark, "llm"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    This fixes the rows and cuts the lineage, and a lost executor costs no more than its running tasks.
    """
    path = f"{application_folder(df.sparkSession, 'llm')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_TYPES = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def columns(text: str) -> T.StructType:
    """A schema from ``name type`` pairs with commas between; needs no session, so modules can hold it."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (pair.split() for pair in text.split(","))])


def extended(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """``schema`` with ``fields`` added; a field replaces one of the same name."""
    taken = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema if f.name.lower() not in taken] + list(fields))


def extended_batch(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """Like :func:`extended`, for the rows."""
    taken = {name.lower() for name in columns}
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n.lower() not in taken]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + list(columns.values()), names=[n for n, _ in kept] + list(columns))


def joined(pieces: list[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate(pieces) if pieces else np.zeros(0, kind)


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """UTF-8 bytes and offsets of consecutive texts, up to ``limit`` bytes or one text at a time; NULL is empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if texts.null_count:  # the bytes of a NULL need not be empty
        lengths = np.where(texts.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        data = np.concatenate([data[o : o + n] for o, n in zip(offsets[:-1], lengths, strict=True)])
        offsets = np.concatenate([[0], np.cumsum(lengths)])
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def slices(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with up to ``limit`` bytes of ``text``, or one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends, row = np.cumsum(sizes), 0
    while row < batch.num_rows:
        last = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + limit, "right")))
        yield batch.slice(row, last - row)
        row = last


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.size = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size or not self.size:
            self.size = max(n, 1 << 16)
            factors = np.empty((2, self.size), np.uint64)
            factors[:, 0], factors[0, 1:], factors[1, 1:] = 1, self.base, self.inverse
            self.up, self.down = np.multiply.accumulate(factors, axis=1)
        return self.up[:n], self.down[:n]


BYTES, WORDS = Powers(0x9E3779B97F4A7C15), Powers(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of a block of texts: byte ranges, 64-bit hashes and the number of the text each is in.

    ``low`` maps each byte to the one it is compared by, ``inside`` tells which of these are part of a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, low: np.ndarray = LOWER, inside: np.ndarray = WORD_BYTE) -> None:
        self.low, n = low[data], len(data)
        inside = inside[self.low]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        first, last = offsets[:-1], offsets[1:] - 1
        before[first[first < n]] = False
        after[last[last >= first]] = False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        up, down = BYTES.upto(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1)

    def windows(self, n: int) -> np.ndarray:
        """A hash for each run of ``n`` words, from the first word on; runs across texts are 0."""
        k = len(self.hashes) - n + 1
        if k <= 0:
            return np.zeros(0, np.uint64)
        up, down = WORDS.upto(len(self.hashes))
        sums = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(self.hashes * up, out=sums[1:])
        found = mixed((sums[n:] - sums[:k]) * down[:k])
        found[self.text[:k] != self.text[n - 1 :]] = 0
        return found

    def joined(self, at: int, n: int) -> bytes:
        """The ``n`` words from word ``at`` on, with one space between."""
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.starts[at : at + n], self.ends[at : at + n], strict=True))


class HashSet:
    """Which of many hashes are in a small set: a bit table first, then a binary search."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sorted = np.unique(hashes.astype(np.uint64))
        self.shift = np.uint64(64 - min(26, max(10, (16 * len(self.sorted)).bit_length())))
        self.table = np.zeros(1 << int(64 - self.shift), bool)
        self.table[self.sorted >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` of those in the set, and their positions in ``sorted``."""
        at = np.flatnonzero(self.table[hashes >> self.shift])
        place = np.searchsorted(self.sorted, hashes[at])
        same = self.sorted[np.minimum(place, len(self.sorted) - 1)] == hashes[at] if len(self.sorted) else np.zeros(len(at), bool)
        return at[same], place[same]
