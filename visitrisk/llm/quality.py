"""Quality rules: rule statistics of whole texts, two base rules, and an isolation forest on the statistics.

**Statistics.** Words are ``[^\\x20\\x09-\\x0D]+``. ``word_chars``: code points in words. ``n_symbols``: characters
of ``[#*$%&|<>]``. ``n_dup_lines``: lines with a word that equal an earlier line. ``n_repeat_words``: words in
five-word windows found twice or more in the text, the first occurrence included.

**Base rules.** A text fails with fewer than 10 words, or if over a fifth of its words are repeated.

**Forest.** Each tree splits a random ``PER_TREE`` of the documents that pass the base rules by random statistics at random
places; documents that few splits set apart are anomalies. The score is 2^(-mean path / expected path).
Trees are grown from a bounded sample by hash of the id, as the method has it; every document is scored.

**Threshold.** Labelled rows are scored, too. The threshold is the score that best tells quality 0 from
quality 1 among those that refuse at most ``REFUSED_GOOD`` of the quality-1 rows; without both kinds of label
nothing is refused.

Defined cases: NULL and empty texts have no words and fail; rows without id are judged like others but are
not sampled; repeated rows are judged alike; input columns named like an output are replaced by it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrisk.llm.common import columns, extended, extended_batch, stored

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5
TREES = 100
PER_TREE = 256
SEED = 42
REFUSED_GOOD = 0.002
#: Scores lie in 0..1; thresholds are sought on this grid.
GRID = 1000

COUNTS = columns("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_distinct long")


def counts(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS for one text."""
    data = (text or "").encode()
    words = data.split()
    word_chars = len(text or "") - (len(data) - len(data.translate(None, SPACES)))
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    repeated = 0
    found = Counter(zip(*(islice(words, i, None) for i in range(WINDOW)), strict=False))
    if len(found) < len(words) - WINDOW + 1:
        hit = np.zeros(len(words) + 1, np.int64)
        for at, window in enumerate(zip(*(islice(words, i, None) for i in range(WINDOW)), strict=False)):
            if found[window] > 1:
                hit[at] += 1
                hit[at + WINDOW] -= 1
        repeated = int((np.cumsum(hit) > 0).sum())
    return len(words), word_chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), len(set(words))


def with_counts(docs: DataFrame, texts: bool = True) -> DataFrame:
    """``docs`` (text, any more) with COUNTS. ``texts=False`` leaves out the text."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([counts(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, len(COUNTS))
            own = {f.name: pa.array(found[:, i]) for i, f in enumerate(COUNTS)}
            yield extended_batch(batch if texts else batch.drop_columns(["text"]), **own)

    kept = docs.schema if texts else docs.drop("text").schema
    return docs.mapInArrow(add, extended(kept, *COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics(found: np.ndarray) -> np.ndarray:
    """Symbols per character, characters per word and variety of words from rows of COUNTS.

    Short texts vary more, so the second is drawn to its usual value with fewer words; the third is kept
    comparable over lengths. Repetition is left to the base rule: within it, it does not tell quality apart.
    """
    n, chars, symbols, _, _, _, distinct = found.astype(np.float64).T
    words = np.maximum(n, 1)
    return np.column_stack([symbols / np.maximum(chars, 1), (chars / words - 5) * np.minimum(1, np.sqrt(words / 200)), np.minimum(1, distinct / words + np.log1p(words) / 20)])


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among ``n`` values in a binary tree."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def grow(rows: np.ndarray, random: np.random.Generator) -> Tree:
    """Feature (-1 for a leaf), split value, left child (the right one follows), and path length if it is a leaf."""
    limit, nodes, open_ = int(np.ceil(np.log2(max(2, len(rows))))), [], [(0, rows, 0)]
    nodes.append([-1, 0.0, 0, 0.0])
    while open_:
        at, own, depth = open_.pop()
        low, high = (own.min(axis=0), own.max(axis=0)) if len(own) else (np.zeros(rows.shape[1]),) * 2
        free = np.flatnonzero(high > low)
        if depth >= limit or len(own) < 2 or not len(free):
            nodes[at][3] = depth + float(average_path(len(own)))
            continue
        feature = int(random.choice(free))
        value = float(random.uniform(low[feature], high[feature]))
        left = own[:, feature] < value
        nodes[at][:3] = feature, value, len(nodes)
        open_ += [(len(nodes), own[left], depth + 1), (len(nodes) + 1, own[~left], depth + 1)]
        nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
    feature, value, child, path = zip(*nodes, strict=True)
    return np.array(feature), np.array(value), np.array(child), np.array(path)


def anomaly(rows: np.ndarray, trees: list[Tree], sample: int) -> np.ndarray:
    """Isolation score of each row: 0.5 is average, towards 1 is anomalous."""
    total = np.zeros(len(rows))
    for feature, value, child, path in trees:
        at = np.zeros(len(rows), np.int64)
        while (inner := feature[at] >= 0).any():
            k = np.flatnonzero(inner)
            at[k] = child[at[k]] + (rows[k, feature[at[k]]] >= value[at[k]])
        total += path[at]
    return 2 ** (-total / len(trees) / max(1e-9, float(average_path(sample)))) if trees else total


def fit(counted: DataFrame, trees: int = TREES, per_tree: int = PER_TREE) -> tuple[list[Tree], int]:
    """The forest, from about ``trees * per_tree`` rows of ``counted`` (doc_id, COUNTS) that pass the base rules."""
    rows = counted.filter(~base_failed() & F.col("doc_id").isNotNull()).select("doc_id", *COUNTS.names)
    share = trees * per_tree / max(1, rows.count())
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1_000_000
    sample = rows.filter(draw < share).distinct().toPandas().sort_values(["doc_id", *COUNTS.names])
    if sample.empty:
        return [], 1
    values, random = statistics(sample[COUNTS.names].to_numpy()), np.random.default_rng(SEED)
    size = min(per_tree, len(values))
    return [grow(values[random.choice(len(values), size, replace=False)], random) for _ in range(trees)], size


def scored(counted: DataFrame, forest: tuple[list[Tree], int]) -> DataFrame:
    """``counted`` with ``anomaly``."""
    sent = counted.sparkSession.sparkContext.broadcast(forest)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = statistics(np.column_stack([batch.column(n).to_numpy() for n in COUNTS.names]))
            yield extended_batch(batch, anomaly=pa.array(anomaly(values, *sent.value)))

    return counted.mapInArrow(add, extended(counted.schema, *columns("anomaly double")))


def threshold(rows: DataFrame, labels: DataFrame, refused_good: float = REFUSED_GOOD) -> float:
    """The score from which on a document is refused, from a histogram of all labelled rows."""
    cell = F.floor(F.col("anomaly") * GRID).cast("int")
    good = labels.filter("quality IS NOT NULL").select("doc_id", (F.col("quality") > 0).alias("good"))
    bins = rows.filter(~base_failed()).select("doc_id", cell.alias("cell")).join(good, "doc_id").groupBy("cell", "good").count().collect()
    found = np.zeros((2, GRID + 2))
    for r in bins:
        found[int(r["good"]), min(GRID, r["cell"])] += r["count"]
    bad, good = found[:, ::-1].cumsum(axis=1)[:, ::-1]  # rows that score so much or more
    if not bad[0] or not good[0]:
        return np.inf
    gain = np.where(good <= refused_good * good[0], bad / bad[0] - good / good[0], -1)
    return (len(gain) - 1 - int(gain[::-1].argmax())) / GRID if gain.max() > 0 else np.inf


def judge(docs: DataFrame, labels: DataFrame, refused_good: float = REFUSED_GOOD) -> DataFrame:
    """doc_id, COUNTS, base_failed, anomaly and kept for every row of ``docs`` (doc_id, text)."""
    counted = stored(with_counts(docs.select("doc_id", F.col("text").cast("string").alias("text")), texts=False), "counted")
    rows = stored(scored(counted, fit(counted)), "scored")  # read for the threshold and for the result
    limit = threshold(rows, labels, refused_good)
    return rows.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))
