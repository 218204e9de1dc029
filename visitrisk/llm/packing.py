"""Packing by optimal length buckets: a dynamic program over the global length histogram, then token-budget batches.

Sequences of a bucket are padded to its upper boundary. The program chooses at most ``buckets`` boundaries
with the least total padding over all sequences; it is exact, and its input is the histogram alone, of at
most ``max_tokens`` rows. In a bucket, batches of ``budget // boundary`` sequences follow each other.

The place of a sequence in its bucket comes from counts per shard and a row number within the shard, so
batches are full across shards and no task holds a bucket. Rows are dealt to shards by hash of id and piece;
the number of shards follows the input.

Texts longer than ``max_tokens`` are cut into pieces of that length, and the rest; none is lost. Lengths are
UTF-8 bytes (byte-level tokens) unless another column is given. Defined cases: NULL and empty texts have
no token and are not packed; equal lengths share a bucket; repeated rows are packed each; input columns
named like an output play no part, as only id and length are carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitrisk.llm.common import stored

MAX_TOKENS = 4096
BUCKETS = 16
BUDGET = 65_536
ROWS_PER_SHARD = 20_000


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, tokens: Column | None = None) -> DataFrame:
    """doc_id, piece (from 0), start and n_tokens of each piece of the texts of ``docs``."""
    size = (F.octet_length(F.col("text").cast("string")) if tokens is None else tokens).cast("long")
    rows = docs.select("doc_id", size.alias("size")).filter("size > 0")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(max_tokens).cast("long")))
    rows = rows.select("doc_id", "size", start.alias("start"))
    return rows.select("doc_id", (F.col("start") / max_tokens).cast("int").alias("piece"), "start", F.least(F.col("size") - F.col("start"), F.lit(max_tokens)).cast("int").alias("n_tokens"))


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """The upper boundaries, ascending, of at most ``buckets`` buckets with the least padding.

    Only lengths that occur can be boundaries, and the longest is one. Of equally good choices it takes the
    smallest last boundaries.
    """
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[x] for x in lengths], np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    n = len(lengths)
    # padded[j]: least tokens, with padding, of the first j lengths. Padding alone differs by a constant.
    padded = np.concatenate([[0], np.full(n, np.iinfo(np.int64).max // 4)])
    choices = []
    for _ in range(min(buckets, n)):
        after, choice = padded.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            cost = padded[:j] + (rows[j] - rows[:j]) * lengths[j - 1]
            i = int(cost.argmin())
            if cost[i] < after[j]:
                after[j], choice[j] = cost[i], i
        padded = after
        choices.append(choice)
    found, j = [], n
    for choice in reversed(choices):
        if j and choice[j] >= 0:
            found.append(int(lengths[j - 1]))
            j = int(choice[j])
    return found[::-1]


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, budget: int = BUDGET, tokens: Column | None = None, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with bucket_tokens (padded length), batch_id (unique over all
    buckets) and slot (place in the batch, from 0). ``slots * bucket_tokens`` of a batch never exceeds
    ``budget``, unless one sequence alone does."""
    rows = stored(pieces(docs, max_tokens, tokens), "pieces")
    histogram = {r["n_tokens"]: r["count"] for r in rows.groupBy("n_tokens").count().collect()}
    upper = boundaries(histogram, buckets)
    if not upper:
        return rows.select("*", F.lit(0).alias("bucket_tokens"), F.lit(0).cast("long").alias("batch_id"), F.lit(0).alias("slot"))
    held = {b: sum(n for x, n in histogram.items() if a < x <= b) for a, b in zip([0, *upper], upper, strict=False)}
    capacity = {b: max(1, budget // b) for b in upper}
    first_batch = dict(zip(upper, np.concatenate([[0], np.cumsum([-(-held[b] // capacity[b]) for b in upper])]).tolist(), strict=False))
    of = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("bucket_tokens")]
    bucket = F.lit(None).cast("int")
    for b in reversed(upper):
        bucket = F.when(F.col("n_tokens") <= b, b).otherwise(bucket)
    shards = -(-sum(histogram.values()) // rows_per_shard)
    # A row's own place breaks ties of id and piece: repeated rows go to shards of their own.
    dealt = rows.withColumn("bucket_tokens", bucket).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    dealt = stored(dealt, "dealt")
    counts = dealt.groupBy("bucket_tokens", "shard").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket_tokens").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("bucket_tokens", "shard", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("bucket_tokens", "shard").orderBy("doc_id", "piece")) - 1
    placed = dealt.withColumn("within", within).join(offsets, ["bucket_tokens", "shard"])
    place = F.col("offset") + F.col("within")
    return placed.select(
        "doc_id", "piece", "start", "n_tokens", "bucket_tokens",
        (of(first_batch) + F.floor(place / of(capacity))).cast("long").alias("batch_id"),
        F.pmod(place, of(capacity)).cast("int").alias("slot"),
    )
