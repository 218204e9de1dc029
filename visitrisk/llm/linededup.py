"""Line dedup: winnowed line hashes find the runs of lines that occur before, and later copies are deleted.

A run is a sequence of lines with words (other lines in between don't count) of at least ``min_words`` words.
The shortest such run from each line, and the shortest that ends at each line, are its *windows*. Every repeated run
is a union of windows, from its first line to its last. Without ``both_ends`` there are only those that start at a
line, and a repeated run keeps its last lines where these have fewer words than a window needs.
Winnowing keeps, for each window, only its line with the smallest hash as fingerprint (the last of equal
ones). Equal windows keep equal lines, so a repeated run always has a repeated fingerprint. Fingerprints are
joined by hash; where one repeats, the windows that extend it both ways are compared by a 128-bit hash.
A line is deleted if it lies in a window equal to one that begins earlier, in the order of document id, text
hash and line; thus one copy of every run stays.

Lines are compared by their words (``[^\\x20\\x09-\\x0D]+``). A line without words goes with a window around it.
Defined cases: NULL texts stay NULL and empty ones empty; NULL document ids come first; rows repeated in full count
as one document and get one result; of rows with one id and different texts each is a document; input columns named
like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import columns, extended, extended_batch, slices, stored

MIN_WORDS = 50

RESULT = columns("n_lines long, n_removed long, removed_words long")
_WINDOW = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("content", T.BinaryType())])
PRINTS = T.StructType([*columns("doc_id long, text_hash long, fingerprint long"), T.StructField("windows", T.ArrayType(_WINDOW))])


def lines_with_words(text: str | None) -> tuple[list[bytes], list[int], list[int]]:
    """All lines, the numbers of those with words, and how many words these have."""
    lines = (text or "").encode().split(b"\n")
    counts = [len(line.split()) for line in lines]
    return lines, [i for i, n in enumerate(counts) if n], [n for n in counts if n]


def _windows(sums: np.ndarray, min_words: int, both_ends: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of each window."""
    last = np.searchsorted(sums, sums[:-1] + min_words) - 1
    first = np.flatnonzero(last < len(sums) - 1)
    last = last[first]
    if both_ends:
        begin = np.searchsorted(sums, sums[1:] - min_words, "right") - 1
        end = np.flatnonzero(begin >= 0)
        first, last = np.unique(np.stack([np.concatenate([first, begin[end]]), np.concatenate([last, end])]), axis=1)
    return first, last


def fingerprints(docs: DataFrame, min_words: int = MIN_WORDS, both_ends: bool = True) -> DataFrame:
    """One row per winnowed line of each document, with the windows whose minimum it is."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows, prints, windows = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                lines, at, counts = lines_with_words(text)
                first, last = _windows(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), min_words, both_ends)
                if not len(first):
                    continue
                plain = [b" ".join(lines[i].split()) for i in at]
                hashes = [xxhash.xxh3_64_intdigest(x) for x in plain]
                found: dict[int, list] = {}
                for a, b in zip(first.tolist(), last.tolist(), strict=True):
                    least = min(range(b, a - 1, -1), key=hashes.__getitem__)
                    found.setdefault(least, []).append({"first": at[a], "last": at[b], "content": xxhash.xxh3_128_digest(b"\n".join(plain[a : b + 1]))})
                for k, own in found.items():
                    rows.append(row)
                    prints.append(hashes[k] - (1 << 63))
                    windows.append(own)
            part = batch.take(pa.array(rows, pa.int64()))
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("content", pa.binary())]))
            yield pa.record_batch([part.column("doc_id"), part.column("text_hash"), pa.array(prints, pa.int64()), pa.array(windows, kind)], names=["doc_id", "text_hash", "fingerprint", "windows"])

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([docs.schema["doc_id"], *PRINTS.fields[1:]])
    return keyed.mapInArrow(cut, schema)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, both_ends: bool = True) -> DataFrame:
    """doc_id, text_hash and runs (first and last line) of the windows that begin earlier elsewhere.

    Both joins are by a hash that may be hot; each side has an exchange of its own, so adaptive execution can
    split it. What is counted is reduced before its shuffle.
    """
    prints = stored(fingerprints(docs, min_words, both_ends), "prints")
    twice = prints.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint", F.xxhash64("fingerprint").alias("__own"))
    windows = (
        prints.withColumn("__own", F.xxhash64("fingerprint"))
        .join(twice, ["fingerprint", "__own"], "left_semi")
        .select("doc_id", "text_hash", F.inline("windows"))
    )
    windows = stored(windows, "windows")
    place = F.struct("doc_id", "text_hash", "first")
    firsts = windows.groupBy("content").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select("content", F.xxhash64("content").alias("__own"), "earliest")
    later = windows.withColumn("__own", F.xxhash64("content")).join(firsts, ["content", "__own"]).filter(~place.eqNullSafe(F.col("earliest")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, both_ends: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, any more) with the later copies of repeated runs cut out of ``text``, and RESULT.

    ``n_lines`` counts lines with words before the cut. A document whose whole text goes keeps its row, with
    the empty text.
    """
    runs = repeated_runs(docs, min_words, both_ends).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("runs").alias("__runs"))
    match = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__hash"))
    rows = docs.join(runs, match, "left").drop("__doc", "__hash")
    schema = extended(docs.schema, T.StructField("text", T.StringType()), *RESULT)
    return rows.mapInArrow(_cut, schema)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole)):
        texts, n_lines, n_removed, words = [], [], [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("__runs").to_pylist(), strict=True):
            lines, at, counts = lines_with_words(text)
            gone = {i for run in runs or () for i in range(run["first"], run["last"] + 1)}
            size = dict(zip(at, counts, strict=True))
            texts.append(text if not gone else b"\n".join(x for i, x in enumerate(lines) if i not in gone).decode())
            n_lines.append(len(at))
            n_removed.append(sum(i in size for i in gone))
            words.append(sum(size.get(i, 0) for i in gone))
        yield extended_batch(batch.drop_columns(["__runs"]), text=pa.array(texts, pa.string()), n_lines=pa.array(n_lines, pa.int64()), n_removed=pa.array(n_removed, pa.int64()), removed_words=pa.array(words, pa.int64()))
