"""Benchmark decontamination: hashed word windows of the benchmark, looked up in every window of every text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. An item's windows are its
runs of 13 words; an item of fewer words, but not none, is one window. Rolling hashes of the same lengths
slide over each text; a hash that is in the broadcast set is verified word by word.

Defined cases: NULL and empty texts have no words and are never contaminated; an item without words has no
windows; a NULL item id counts as the empty string; repeated rows are each judged alike; an empty benchmark
hits nothing; input columns named like an output are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import HashSet, Words, columns, extended, extended_batch, stored, text_blocks

WINDOW = 13
#: Windows that one broadcast holds, about 150 bytes each. A larger benchmark is scanned for in slices of this size.
BROADCAST_WINDOWS = 200_000

RESULT = columns("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, clean_text string")
HITS = columns("doc_id long, text_hash long, at int, n int, item string")

Run = tuple[int, int, str]


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per item and distinct window: item (text), n, hash, words (joined by a space)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, row = batch.column("item"), 0
            for data, offsets in text_blocks(batch.column("text")):
                words, out = Words(data, offsets), []
                first = np.searchsorted(words.text, np.arange(len(offsets)))
                for k, (begin, end) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    n = min(window, end - begin)
                    hashes = words.windows(n) if n else ()
                    out += [(items[row + k].as_py(), n, int(hashes[i].view(np.int64)), words.joined(i, n)) for i in range(begin, end - n + 1) if n]
                row += len(offsets) - 1
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                yield pa.record_batch([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array([w.decode() for w in columns[3]], pa.string())], names=["item", "n", "hash", "words"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "item string, n int, hash long, words string").distinct()


class Lookup:
    """The windows of one broadcast: a hash set per window length, and the items of each window's words."""

    def __init__(self, rows: Iterable[tuple[str, int, int, str]]) -> None:
        self.items: dict[bytes, list[str]] = defaultdict(list)
        by_length: dict[int, list[int]] = defaultdict(list)
        for item, n, hashed, words in rows:
            by_length[n].append(hashed)
            self.items[words.encode()].append(item)
        self.sets = {n: HashSet(np.array(h, np.int64).view(np.uint64)) for n, h in by_length.items()}

    def runs(self, words: Words) -> Iterator[Run]:
        """First word, length and item of each verified window."""
        for n, known in self.sets.items():
            for at in known.find(words.windows(n))[0]:
                for item in self.items.get(words.joined(at, n), ()):
                    yield int(at), n, item


def judged(words: Words, data: np.ndarray, offsets: np.ndarray, runs: Iterable[Run]) -> list[pa.Array]:
    """The columns of RESULT for a block of texts. Contaminated: some word hit, and at least one in twenty."""
    texts = len(offsets) - 1
    edge = np.zeros(len(words.starts) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for at, n, item in runs:
        edge[at] += 1
        edge[at + n] -= 1
        items[int(words.text[at])].add(item)
    hit = np.cumsum(edge[:-1]) > 0
    n_hit = np.bincount(words.text[hit], minlength=texts)
    clean = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    for k in items:
        own = np.flatnonzero(hit & (words.text == k))
        breaks = np.flatnonzero(np.diff(own) > 1)
        at, kept = offsets[k], []
        for first, last in zip(np.append(own[:1], own[breaks + 1]), np.append(own[breaks], own[-1:]), strict=True):
            kept.append(data[at : words.starts[first]].tobytes())
            at = words.ends[last]
        clean[k] = b"".join([*kept, data[at : offsets[k + 1]].tobytes()]).decode()
    digests = {k: hashlib.sha256(",".join(sorted(found)).encode()).hexdigest() for k, found in items.items()}
    none = hashlib.sha256(b"").hexdigest()
    n_items = [len(items.get(k, ())) for k in range(texts)]
    contaminated = (n_hit > 0) & (20 * n_hit >= words.counts)
    return [pa.array(words.counts), pa.array(n_hit), pa.array(n_items, pa.int64()), pa.array([digests.get(k, none) for k in range(texts)]), pa.array(contaminated), pa.array(clean)]


def _results(batches: Iterable[pa.RecordBatch], windows: Broadcast | None, dropped: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Runs come from all windows in one broadcast, or else from the column ``__runs``."""
    lookup = windows and Lookup(windows.value)
    for batch in batches:
        row = 0
        for data, offsets in text_blocks(batch.column("text")):
            part = batch.slice(row, len(offsets) - 1)
            words = Words(data, offsets)
            columns = dict(zip(RESULT.names, judged(words, data, offsets, lookup.runs(words) if lookup else _runs_of(words, part)), strict=True))
            columns["clean_text"] = pa.array(columns["clean_text"].to_pylist(), mask=part.column("text").is_null().to_numpy(zero_copy_only=False))
            part = part.select([n for n in part.schema.names if n not in dropped])
            yield extended_batch(part, **{n: c for n, c in columns.items() if n not in dropped})
            row += len(offsets) - 1


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS, texts: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, any more) with RESULT: counts, the digest of the items found, the verdict and the
    text without the words hit. ``texts=False`` leaves out both texts.

    One scan without shuffle, as long as the benchmark's windows fit one broadcast. Beyond that, there is one
    scan per slice of them; verified hits meet by document, and no task holds more than one slice.
    """
    spark = docs.sparkSession
    dropped = () if texts else ("text", "clean_text")
    windows = stored(benchmark_windows(benchmark, window), "windows")
    slices = -(-windows.count() // broadcast_windows) or 1

    def sent(k: int):
        return spark.sparkContext.broadcast([tuple(r) for r in windows.filter(F.pmod("hash", F.lit(slices)) == k).toLocalIterator()])

    if slices == 1:
        rows, whole = docs, sent(0)
    else:
        keyed, hits, whole = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), None, None
        for k in range(slices):
            part = sent(k)
            found = stored(_hits(keyed, part), "hits")
            part.unpersist()
            hits = found if hits is None else hits.unionByName(found)
        runs = hits.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.collect_set(F.struct("at", "n", "item")).alias("__runs"))
        match = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__hash"))
        rows = docs.join(runs, match, "left").drop("__doc", "__hash")
        dropped = (*dropped, "__runs")
    kept = [f for f in rows.schema if f.name not in dropped]
    schema = extended(T.StructType(kept), *[f for f in RESULT if f.name not in dropped])
    return rows.mapInArrow(lambda batches: _results(batches, whole, dropped), schema)


def _runs_of(words: Words, part: pa.RecordBatch) -> Iterator[Run]:
    first = np.searchsorted(words.text, np.arange(part.num_rows))
    for begin, runs in zip(first, part.column("__runs").to_pylist(), strict=True):
        yield from ((int(begin) + r["at"], r["n"], r["item"]) for r in runs or ())


def _hits(keyed: DataFrame, windows: Broadcast) -> DataFrame:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(windows.value)
        for batch in batches:
            row = 0
            for data, offsets in text_blocks(batch.column("text")):
                words = Words(data, offsets)
                first = np.searchsorted(words.text, np.arange(len(offsets) - 1))
                found = [(int(k := words.text[at]) + row, at - int(first[k]), n, item) for at, n, item in lookup.runs(words)]
                rows, at, n, item = zip(*found, strict=True) if found else ((), (), (), ())
                part = batch.take(pa.array(rows, pa.int64()))
                yield pa.record_batch([part.column("doc_id"), part.column("text_hash"), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(item, pa.string())], names=HITS.names)
                row += len(offsets) - 1

    return keyed.mapInArrow(scan, T.StructType([keyed.schema["doc_id"], *HITS.fields[1:]]))
