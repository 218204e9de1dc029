"""Ordinal encoding of categories as a mapping table ``(feature, value, code)``.

Fitting numbers the sorted distinct values of every column 0..n-1. Transforming looks each value up;
a value that was not fitted becomes -1.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitrisk.scratch import checkpointed
from visitrisk.spec import ENCODED_SUFFIX

# Fixed value: the code of a value that was not fitted.
UNKNOWN = -1

# Smallest feature first: codes up to the first sum go into the tasks with the plan, up to the second
# into broadcast joins.
INLINE_BYTES = 4 << 20
BROADCAST_BYTES = 128 << 20
ROW_OVERHEAD_BYTES = 64

# So many of the most frequent values of a feature, by a sketch, count as common. Values are sketched by
# their hash, so their length plays no part.
COMMON_VALUES = 1000
SKETCHED = 10_000


def _pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "feature", "value").filter(F.col("value").isNotNull())


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes of the values of ``columns`` in ``df``, in code-point order of the text.

    One scan reduces all columns to distinct values before the first shuffle, a second one sorts them by
    range (its bounds are sampled from the first one's result). The numbering is spread as well: values are range-partitioned
    by (feature, value), numbered inside each partition, and shifted by the count of the same
    feature's values in the partitions before. So no feature needs to fit into one task.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, value string, code int")
    # Range bounds come from a sample, so the partitions are fixed before they are counted.
    ranges = checkpointed(
        _pairs(df, columns)
        .distinct()
        .repartitionByRange("feature", "value")
        .sortWithinPartitions("feature", "value")
        .select(
            "feature",
            "value",
            F.monotonically_increasing_id().alias("position"),
        )
    ).withColumn("block", F.shiftright("position", 33))

    earlier = Window.partitionBy("feature").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range partition plus one per feature: small enough to broadcast by
    # construction, whatever the number of values.
    starts = (
        ranges.groupBy("feature", "block")
        .agg(F.min("position").alias("first"), F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    code = F.col("before") + F.col("position") - F.col("first")
    return ranges.join(F.broadcast(starts), ["feature", "block"]).select(
        "feature", "value", code.cast("int").alias("code")
    )


def _sizes(codes: DataFrame) -> dict[str, int]:
    """Bytes of each feature's codes: one row per feature."""
    size = F.sum(F.octet_length("value") + ROW_OVERHEAD_BYTES).alias("bytes")
    return {r["feature"]: r["bytes"] for r in codes.groupBy("feature").agg(size).collect()}


def _within(sizes: dict[str, int], columns: Sequence[str], limit: int) -> list[str]:
    """The columns, smallest first, whose codes stay within ``limit`` bytes in sum."""
    chosen, used = [], 0
    for column in sorted(columns, key=lambda c: sizes.get(c, 0)):
        used += sizes.get(column, 0)
        if used > limit:
            break
        chosen.append(column)
    return chosen


def _labels(codes: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Values by code, for the columns whose codes are 0..n-1. Only for columns measured to be small."""
    by_code: dict[str, dict[int, str]] = {}
    for row in codes.filter(F.col("feature").isin(list(columns))).collect():
        by_code.setdefault(row["feature"], {})[row["code"]] = row["value"]
    return {
        feature: [values[i] for i in range(len(values))]
        for feature, values in by_code.items()
        if set(values) == set(range(len(values)))
    }


def _index_inline(
    df: DataFrame, labels: dict[str, list[str]], codes: dict[str, list[int]], name: str = "__index"
) -> tuple[DataFrame, dict[str, Column]]:
    """Look up many small features in one projection; a chain of joins would copy each wide row per join.

    A label's code is its position, or what ``codes`` has there.
    """
    columns = list(labels)
    indexer = StringIndexerModel.from_arrays_of_labels(
        list(labels.values()), columns, [f"{name}_{i}" for i in range(len(columns))], handleInvalid="keep"
    )
    found = {}
    for i, c in enumerate(columns):
        at = F.col(f"{name}_{i}").cast("int")
        code = F.get(F.expr(f"array({', '.join(map(str, codes[c]))})"), at) if c in codes else at
        # The indexer gives every other value, NULL too, the index after the last label.
        found[c] = F.when(at < len(labels[c]), code)
    return indexer.transform(df), found


def _hot(df: DataFrame, columns: Sequence[str]) -> dict[str, list[int]]:
    """Hashes of the most frequent values of each column: one pass, at most ``COMMON_VALUES`` a column.

    Which values are taken changes no result, only where their rows go.
    """
    tops = [
        F.expr(f"approx_top_k(xxhash64(CAST(`{c}` AS STRING)), {COMMON_VALUES}, {SKETCHED})").alias(f"t{i}")
        for i, c in enumerate(columns)
    ]
    found = df.agg(*tops).first()
    return {c: [x["item"] for x in found[f"t{i}"] or [] if x["item"] is not None] for i, c in enumerate(columns)}


def _among(value: str, hashes: Sequence[int]) -> Column:
    return F.expr(f"xxhash64(`{value}`) IN ({', '.join(f'{h}L' for h in hashes)})") if hashes else F.lit(False)


def _lookup(codes: DataFrame, feature: str, value: str, code: str) -> DataFrame:
    return codes.filter(F.col("feature") == feature).select(
        F.col("value").alias(value), F.col("code").alias(code)
    )


def _find_common(
    result: DataFrame, codes: DataFrame, hot: dict[str, list[int]], inline_bytes: int
) -> tuple[DataFrame, dict[str, Column]]:
    """The codes of common values: inside one projection while their bytes allow it, else by broadcast joins."""
    common = codes.filter(reduce(or_, [(F.col("feature") == c) & _among("value", hot[c]) for c in hot]))
    sizes = _sizes(common)
    inline = _within(sizes, list(sizes), inline_bytes)
    labels: dict[str, list[str]] = {}
    numbers: dict[str, list[int]] = {}
    for row in common.filter(F.col("feature").isin(inline)).collect() if inline else []:
        labels.setdefault(row["feature"], []).append(row["value"])
        numbers.setdefault(row["feature"], []).append(row["code"])
    found: dict[str, Column] = {}
    if labels:
        result, found = _index_inline(result, labels, numbers, "__common_index")
    for i, column in enumerate(c for c in sizes if c not in labels):
        value, code = f"__common_value_{i}", f"__common_code_{i}"
        lookup = F.broadcast(_lookup(common, column, value, code))
        result = result.join(lookup, F.col(column) == F.col(value), "left").drop(value)
        found[column] = F.col(code)
    return result, found


def _find_rare(
    result: DataFrame, df: DataFrame, codes: DataFrame, hot: dict[str, list[int]]
) -> tuple[DataFrame, dict[str, Column]]:
    """The codes of all other values of the large columns, by the same four shuffles however many there are.

    The other values of a row are its key, by two hashes of 64 bits. Pairs of key and value, without the
    wide rows, meet the codes in one join; the codes found are gathered by key, and the wide rows are
    shuffled once to meet them. A key depends on content alone, so a rerun of a task cannot change it; rows with
    the same values share a key. Rows without such a value need no partner and are spread by a hash of
    task and row.
    """
    columns = list(hot)
    rare = [F.when(~_among(c, hot[c]), F.col(c)) for c in columns]
    # A hash skips NULLs, so each value is preceded by whether there is one.
    marked = [x for r in rare for x in (r.isNull(), r)]
    keys = [F.xxhash64(F.lit(seed), *marked).alias(k) for seed, k in enumerate(("__key_0", "__key_1"))]

    values = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    narrow = values.select(*keys, *[r.alias(f"__rare_{i}") for i, r in enumerate(rare)])
    named = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__rare_{i}").alias("value")) for i, c in enumerate(columns)])
    )
    pairs = narrow.select("__key_0", "__key_1", named.alias("pair")).select("__key_0", "__key_1", "pair.*")
    met = pairs.filter(F.col("value").isNotNull()).join(
        codes.filter(F.col("feature").isin(columns)).hint("merge"), ["feature", "value"]
    )
    gathered = met.groupBy("__key_0", "__key_1").agg(
        *[F.max(F.when(F.col("feature") == c, F.col("code"))).alias(f"__rare_code_{i}") for i, c in enumerate(columns)]
    )

    some = reduce(or_, [r.isNotNull() for r in rare])
    alone = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in df.columns])
    keyed = result.select(
        "*", F.when(some, keys[0]).otherwise(alone).alias("__row_0"), F.when(some, keys[1]).alias("__row_1")
    )
    same = (F.col("__row_0") == F.col("__key_0")) & (F.col("__row_1") == F.col("__key_1"))
    joined = keyed.join(gathered.hint("merge"), same, "left").drop("__key_0", "__key_1", "__row_0", "__row_1")
    return joined, {c: F.col(f"__rare_code_{i}") for i, c in enumerate(columns)}


def encode(
    df: DataFrame,
    codes: DataFrame,
    columns: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    inline_bytes: int = INLINE_BYTES,
    unfitted: Sequence[str] = (),
) -> DataFrame:
    """Replace each of ``columns`` by ``<column>_ENCODED``; every row stays, once.

    Values are compared as text on every way. The size of each feature's codes is measured. The smallest
    are looked up by an indexer inside one projection, larger ones by a broadcast join, and those beyond
    the limits by shuffles of narrow pairs and one of the rows, whatever the number of such columns. Before
    the latter, the common values of a column (they may be a third of all rows) are looked up apart, at most
    ``COMMON_VALUES`` a column. Large columns are read twice, so ``df`` must have the same rows each time.

    A column of which ``codes`` has no value at all is an error, as codes of another table or half-written
    ones would give -1 everywhere; ``unfitted`` names the columns that may lack codes.
    """
    sizes = _sizes(codes)
    missing = [c for c in columns if c not in sizes and c not in unfitted]
    if missing:
        raise ValueError(f"there are no codes of {missing}")
    fitted = [c for c in columns if c in sizes]
    small = _within(sizes, fitted, broadcast_bytes)
    large = [c for c in fitted if c not in small]
    labels = _labels(codes, _within(sizes, small, inline_bytes))

    others = [c for c in df.columns if c not in columns]
    texts = {c: F.col(c).cast("string").alias(c) for c in columns}
    result = df.select(*[texts.get(c, F.col(f"`{c}`")) for c in df.columns])
    found = dict.fromkeys(columns, F.lit(None).cast("int"))
    if labels:
        result, indexed = _index_inline(result, labels, {})
        found.update(indexed)
    for i, column in enumerate(c for c in small if c not in labels):
        value, code = f"__value_{i}", f"__code_{i}"
        lookup = F.broadcast(_lookup(codes, column, value, code))
        result = result.join(lookup, F.col(column) == F.col(value), "left").drop(value)
        found[column] = F.col(code)
    if large:
        hot = _hot(df, large)
        result, common = _find_common(result, codes, hot, inline_bytes)
        result, rare = _find_rare(result, df, codes, hot)
        found.update({c: F.coalesce(common[c], rare[c]) if c in common else rare[c] for c in large})
    encoded = [F.coalesce(found[c], F.lit(UNKNOWN)).alias(c + ENCODED_SUFFIX) for c in columns]
    return result.select(*others, *encoded)


def write_codes(codes: DataFrame, path: str) -> None:
    """One folder per feature, so that a lookup reads only its own feature.

    Fitted codes are still range-partitioned by (feature, value): each task writes few folders.
    """
    codes.write.mode("overwrite").partitionBy("feature").parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema("value string, code int, feature string").parquet(path)
    return stored.select("feature", "value", "code")
