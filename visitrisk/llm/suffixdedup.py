"""Suffix-array dedup: byte strings of ``threshold`` bytes that occur in an earlier document are removed.

Every place of a text begins a suffix, which is ordered through its first ``threshold`` bytes only (its *window*), by
digits, the most significant first. A group of suffixes that agree so far and lie in one document only is finished;
what is left after the last digit in groups of several documents is exactly the repeated windows.

* Digit 1 is the least hash of ``GRAM`` bytes in the window. Windows next to each other mostly have the same, so a
  row is a *stretch* of up to ``STRETCH`` windows with one digit 1, not a window.
* Digit 2 is all bytes of the stretch. Windows of equal stretches are equal, so an equal stretch in an earlier
  document settles all of them at once.
* Digit 3 is the bytes that up to ``CORE`` windows next to each other have in common, cut at fixed distances from the
  gram of digit 1, so that equal windows have equal ones. It is looked at for the first of equal stretches where another
  stretch has the same digit 1, and finishes most windows around a place where near copies differ.
* Digit 4 is the window itself, by 128 bits of hash.

Each digit is one aggregation with partial results before its shuffle, so a string that very many documents share is
reduced in the tasks, and the joins back have an exchange on each side, which adaptive execution can split.

A document's place in the order is its doc_id; a byte goes if an equal window that covers it is in a document with a
smaller one. Bytes are those of the text in UTF-8; what is left need not be UTF-8, so it is binary. Defined cases:
NULL texts are empty; texts shorter than a window keep all; NULL document ids count as one id before all others; rows of one
id are one document, repeated or not; input columns named like an output are replaced. Texts are worked on 1 MB
at a time, apart from the last step, which needs about six times the bytes of a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import BLOCK_BYTES, BYTES, columns, extended, extended_batch, mixed, slices, stored, text_blocks
from visitrisk.scratch import application_folder
from visitrisk.sources.folders import remove

THRESHOLD = 50
#: Bytes of a gram whose least hash is digit 1.
GRAM = 20
#: Most windows in a stretch; one bit of a long for each.
STRETCH = 62
#: Most windows that digit 3 looks at together.
CORE = 8

_SIZE_BITS = 6
_ALL = -1
_FIRST_ID = -(1 << 63)
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

RESULT = T.StructType(
    [
        *columns("n_bytes long, n_removed long, n_spans long"),
        T.StructField("spans", T.ArrayType(columns("start long, length long"))),
        T.StructField("kept", T.BinaryType()),
    ]
)
CORES = columns("core long, doc long, at long, span long, windows long")
WINDOWS = columns("head long, tail long, doc long, span long, number int")


def _pieces(texts: pa.Array, threshold: int, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, its first byte, data and offsets of texts or parts of a long one, whose windows are in one part each."""
    row = 0
    for data, offsets in text_blocks(texts, limit):
        for at in range(0, len(data), limit) if len(data) > limit else (0,):
            if len(data) > limit:
                part = data[at : at + limit + threshold - 1]
                yield row, at, part, np.array([0, len(part)])
            else:
                yield row, 0, data, offsets
        row += len(offsets) - 1


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return values if done == width else np.minimum(values[: len(values) - (width - done)], values[width - done :])


def stretches(data: np.ndarray, offsets: np.ndarray, threshold: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, number of windows and digit 1 of the stretches, in order."""
    n = len(data) - threshold + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = BYTES.upto(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up, out=sums[1:])
    digits = least(mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]), threshold - gram + 1)
    change = np.ones(n, bool)
    change[1:] = digits[1:] != digits[:-1]
    inside = np.ones(n, bool)
    for end in offsets[1:-1]:
        inside[max(0, end - threshold + 1) : end] = False
    begins = offsets[1:-1]
    change[begins[begins < n]] = True
    change[1:] |= inside[1:] != inside[:-1]
    begin = np.flatnonzero(change)
    size = np.diff(np.append(begin, n))
    begin, size = begin[inside[begin]], size[inside[begin]]
    parts = -(-size // STRETCH)
    if len(parts) and parts.max() > 1:
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, size = np.repeat(begin, parts) + step * STRETCH, np.minimum(np.repeat(size, parts) - step * STRETCH, STRETCH)
    return begin, size, digits[begin]


def _span(data: bytes, begin: int, size: int, threshold: int) -> int:
    """Digit 2: a hash of all bytes of a stretch."""
    return xxhash.xxh3_64_intdigest(data[begin : begin + size + threshold - 1]) - (1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_ID)).alias("doc"), F.col("text").cast("string").alias("text"))


def digits(docs: DataFrame, threshold: int, gram: int, spans: bool) -> DataFrame:
    """One row per stretch: digit 1 and its document; with ``spans`` also its place and digit 2."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            for row, zero, data, offsets in _pieces(batch.column("text"), threshold):
                begin, size, digit = stretches(data, offsets, threshold, gram)
                text = np.searchsorted(offsets, begin, "right") - 1
                out = [digit.view(np.int64), doc[text + row]]
                if spans:
                    whole = data.tobytes()
                    out.append((begin - offsets[text] + zero) << _SIZE_BITS | (size - 1))
                    out.append(np.array([_span(whole, b, k, threshold) for b, k in zip(begin.tolist(), size.tolist(), strict=True)], np.int64))
                yield pa.record_batch([pa.array(x) for x in out], names=["digit", "doc", "at", "span"][: len(out)])

    return _keyed(docs).mapInArrow(find, columns("digit long, doc long" + (", at long, span long" if spans else "")))


def _lists(lists: pa.ListArray) -> tuple[list[int], dict[str, np.ndarray]]:
    """Bounds of each row's list of structs, and the structs' fields for all rows; NULL is an empty list."""
    counts = pa.compute.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    fields = {flat.type[i].name: x.to_numpy(zero_copy_only=False) for i, x in enumerate(flat.flatten())}
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).tolist(), fields


def _own(texts: list[bytes], bounds: list[int], fields: dict[str, np.ndarray], threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which stretches are of their row's text, not of another with its id; begin and number of windows of all."""
    begin, size = fields["at"] >> _SIZE_BITS, (fields["at"] & 63) + 1
    ends, hashed = (begin + size - 1 + threshold).tolist(), xxhash.xxh3_64_intdigest
    starts, spans = begin.tolist(), fields["span"].tolist()
    fine = [
        hashed(data[starts[i] : ends[i]]) - (1 << 63) == spans[i] for data, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True) for i in range(a, b)
    ]
    return np.array(fine, bool), begin, size


def _lists_of(asked: DataFrame) -> DataFrame:
    """One row per document with the list of its rows of ``asked`` (doc, at, span, any more).

    To be written before :func:`_asked` joins it, so that both sides of the join have an exchange of their own.
    """
    fields = [c for c in asked.columns if c != "doc"]
    return asked.groupBy("doc").agg(F.collect_list(F.struct(*fields)).alias("asked"))


def _asked(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Texts with the lists of their documents."""
    lists = lists.withColumnRenamed("doc", "__doc")
    return _keyed(docs).join(lists, F.col("doc") == F.col("__doc")).select("doc", "text", "asked")


def _numbers(windows: np.ndarray, size: np.ndarray, fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretch and number of the windows whose bits are set, of stretches that are ``fine``."""
    of = np.repeat(np.arange(len(size)), np.where(fine, size, 0))
    number = np.arange(len(of)) - np.searchsorted(of, of)
    asked = (windows[of] >> number & 1).astype(bool)
    return of[asked], number[asked]


def _grams(data: bytes, begins: np.ndarray, threshold: int, gram: int) -> list[int]:
    """Where the least gram of each window that begins at ``begins`` is, from there."""
    up, down = BYTES.upto(threshold + 1)
    values = _VALUES[np.frombuffer(data, np.uint8)[begins[:, None] + np.arange(threshold)]]
    sums = np.zeros((len(begins), threshold + 1), np.uint64)
    np.cumsum(values * up[:threshold], axis=1, out=sums[:, 1:])
    return mixed((sums[:, gram:] - sums[:, : threshold - gram + 1]) * down[: threshold - gram + 1]).argmin(axis=1).tolist()


def cores(docs: DataFrame, lists: DataFrame, threshold: int, gram: int) -> DataFrame:
    """Digit 3 of the stretches in ``lists`` (at, span), with a bit for each window it is of.

    A gram may be in a stretch several times; a window that holds two of them has a digit for each.
    """
    room = threshold - gram

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_64_intdigest
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
            bounds, fields = _lists(batch.column("asked"))
            fine, begins, sizes = _own(texts, bounds, fields, threshold)
            of, number, bits, content = [], [], [], []
            for data, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
                own = a + np.flatnonzero(fine[a:b])
                places = _grams(data, begins[own], threshold, gram) if len(own) else []
                for i, begin, size, place in zip(own.tolist(), begins[own].tolist(), sizes[own].tolist(), places, strict=True):
                    whole = data[begin : begin + size - 1 + threshold]
                    least = whole[place : place + gram]
                    while 0 <= place <= size - 1 + room:
                        # Windows that begin up to ``room`` bytes before the gram hold it.
                        for low in range(max(0, place - size + 1) // CORE * CORE, min(place, room) + 1, CORE):
                            last, first = place - low, place - min(low + CORE - 1, room)
                            of.append(i)
                            number.append(max(first, 0))
                            bits.append(min(last, size - 1) - max(first, 0) + 1)
                            content.append(hashed(whole[last : first + threshold]) - (1 << 63))
                        place = whole.find(least, place + 1)
            of = np.array(of, np.int64)
            doc = np.repeat(batch.column("doc").to_numpy(), np.diff(bounds))
            windows = ((np.int64(1) << np.array(bits, np.int64)) - 1) << np.array(number, np.int64)
            parts = [np.array(content, np.int64), doc[of], fields["at"][of], fields["span"][of], windows]
            yield pa.record_batch([pa.array(x) for x in parts], names=CORES.names)

    return _asked(docs, lists).mapInArrow(cut, CORES)


def windows(docs: DataFrame, lists: DataFrame, threshold: int) -> DataFrame:
    """Digit 4 of the windows in ``lists`` (at, span, windows)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
            bounds, fields = _lists(batch.column("asked"))
            fine, begin, size = _own(texts, bounds, fields, threshold)
            of, number = _numbers(fields["windows"], size, fine)
            row = np.repeat(np.arange(len(texts)), np.diff(bounds))[of]
            places = (begin[of] + number).tolist()
            content = b"".join([xxhash.xxh3_128_digest(texts[r][k : k + threshold]) for r, k in zip(row.tolist(), places, strict=True)])
            head, tail = np.frombuffer(content, np.int64).reshape(-1, 2).T
            parts = [head, tail, batch.column("doc").to_numpy()[row], fields["span"][of], number.astype(np.int32)]
            yield pa.record_batch([pa.array(np.ascontiguousarray(x)) for x in parts], names=WINDOWS.names)

    return _asked(docs, lists).mapInArrow(cut, WINDOWS)


def _written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written and read back. Shuffle files of the work go at its end, so that those of one digit are there at a time."""
    session, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = session.conf.get(setting, "false")
    session.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        session.conf.set(setting, before)
    return session.read.schema(df.schema).parquet(path)


def _several(rows: DataFrame, *key: str) -> DataFrame:
    """The keys that several documents have, with the least document."""
    found = rows.groupBy(*key).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    return found.filter("least < most").select(*key, "least")


def repeated(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """doc, at and span of the stretches with windows that an earlier document has, and ``windows``, a bit for each.

    What a step wrote goes once nothing reads it any more, so that the disk holds little besides a step's own shuffle.
    """
    gram = max(min(gram, threshold // 2), threshold - STRETCH, 1)
    work = f"{application_folder(docs.sparkSession, 'llm')}/suffixes-{uuid4().hex}"

    def write(name: str, df: DataFrame, *done: str) -> DataFrame:
        out = _written(df, f"{work}/{name}")
        for read in done:
            remove(docs.sparkSession, f"{work}/{read}")
        return out

    shared = write("digits", _several(digits(docs, threshold, gram, spans=False), "digit").select("digit"))
    found = write("stretches", digits(docs, threshold, gram, spans=True).join(shared, "digit", "left_semi"), "digits")
    spans = found.groupBy("digit", "span").agg(F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("last"))
    spans = write("spans", spans.select("digit", "span", F.col("first.doc").alias("doc"), "first.at", "last"))

    again = spans.filter("last > doc").select("digit", "span", F.col("doc").alias("least"))
    whole = found.join(again, ["digit", "span"]).filter("doc > least").select("doc", "at", "span", F.lit(_ALL).cast("long").alias("windows"))
    whole = write("whole", whole)

    asked = spans.join(_several(spans, "digit"), "digit", "left_semi").select("doc", "at", "span")
    lists = write("asked", _lists_of(asked), "spans")
    parts = write("cores", cores(docs, lists, threshold, gram), "asked")
    parts = parts.join(_several(parts, "core").select("core"), "core", "left_semi")
    lists = write("open", _lists_of(parts.groupBy("doc", "at", "span").agg(F.bit_or("windows").alias("windows"))), "cores")
    alone = write("windows", windows(docs, lists, threshold), "open")
    later = alone.join(_several(alone, "head", "tail"), ["head", "tail"]).filter("doc > least")
    bits = write("bits", later.groupBy("doc", "span").agg(F.bit_or(F.expr("shiftleft(1L, number)")).alias("windows")), "windows")
    part = write("part", found.join(bits, ["doc", "span"]).select("doc", "at", "span", "windows"), "bits", "stretches")
    return whole.unionByName(part)


def dedup(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text, any more) with RESULT: bytes, removed bytes, maximal removed spans, and the bytes kept.

    Reads ``docs`` five times; pass stored rows.
    """
    found = repeated(docs, threshold, gram).groupBy("doc").agg(F.collect_list(F.struct("at", "span", "windows")).alias("__found"))
    found = stored(found, "repeated").withColumnRenamed("doc", "__doc")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
            begin, end, first = removed(texts, *_lists(batch.column("__found")), threshold)
            kept = []
            for data, a, b in zip(texts, first[:-1].tolist(), first[1:].tolist(), strict=True):
                edges = [0, *np.stack([begin[a:b], end[a:b]], axis=1).ravel().tolist(), len(data)]
                kept.append(data if a == b else b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            n_bytes = np.array([len(data) for data in texts], np.int64)
            yield extended_batch(
                batch.drop_columns(["__found"]),
                n_bytes=pa.array(n_bytes),
                n_removed=pa.array(n_bytes - np.array([len(x) for x in kept], np.int64)),
                n_spans=pa.array(np.diff(first)),
                spans=pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays([pa.array(begin), pa.array(end - begin)], names=["start", "length"])),
                kept=pa.array(kept, pa.binary()),
            )

    docs = docs.withColumn("text", F.col("text").cast("string"))
    rows = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_ID)))
    rows = rows.join(found, F.col("__key") == F.col("__doc"), "left").drop("__key", "__doc")
    return rows.mapInArrow(cut, extended(docs.schema, *RESULT))


def removed(texts: list[bytes], bounds: list[int], fields: dict[str, np.ndarray], threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the maximal spans that repeated windows cover, and the first span of each text."""
    fine, begin, size = _own(texts, bounds, fields, threshold)
    zero = np.concatenate([[0], np.cumsum([len(data) + 1 for data in texts])]).astype(np.int64)  # a byte between texts
    at = np.repeat(zero[:-1], np.diff(bounds)) + begin
    every = fields["windows"] == _ALL
    of, number = _numbers(fields["windows"], size, fine & ~every)
    marks = np.zeros(zero[-1] + 1, np.int32)
    np.add.at(marks, np.concatenate([at[fine & every], at[of] + number]), 1)
    np.add.at(marks, np.concatenate([(at + size - 1)[fine & every], at[of] + number]) + threshold, -1)
    gone = np.cumsum(marks) > 0
    edges = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    if len(gone) and gone[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    first = np.searchsorted(starts, zero)
    own = np.repeat(zero[:-1], np.diff(first))
    return starts - own, ends - own, first
