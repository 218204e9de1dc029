import hashlib

import pytest
from pyspark.sql import functions as F

from visitrisk.functions.split import TEST, TRAIN, split_key, split_label


def labels(df):
    return {r["id"]: r["data_split"] for r in df.select("id", split_label("id")).collect()}


def test_key_is_the_hash_of_seed_and_id(spark):
    row = spark.range(17, 18).select(split_key("id").alias("k")).first()
    assert row["k"] == int(hashlib.md5(b"42:17").hexdigest()[:8], 16) / 2**32


def test_partitioning_does_not_move_rows(spark):
    ids = spark.range(2000)
    assert labels(ids) == labels(ids.repartition(3)) == labels(ids.orderBy(F.col("id").desc()))


def test_disjoint_complete_and_a_fifth(spark):
    found = labels(spark.range(20000))
    assert set(found.values()) == {TRAIN, TEST}
    assert len(found) == 20000
    assert abs(sum(v == TEST for v in found.values()) / 20000 - 0.2) < 0.01


def test_seed_changes_the_split(spark):
    both = spark.range(1000).select(split_label("id").alias("a"), split_label("id", seed=7).alias("b"))
    assert 0 < both.filter("a != b").count() < 1000


@pytest.mark.parametrize("share", [0.0, 1e-9, 0.2, 0.5, 0.999, 1 - 2.0**-32, 1.0])
def test_label_is_the_key_below_the_share(spark, share):
    ids = spark.range(3000).withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    below = F.when(split_key("id") < share, TEST).otherwise(TRAIN)
    assert ids.filter(split_label("id", share) != below).isEmpty()


def test_rows_without_an_id_are_on_both_sides(spark):
    rows = spark.range(2000).select(F.lit(None).cast("int").alias("none"), F.col("id").alias("at"))
    sides = rows.groupBy(split_label("none", instead="at")).count().collect()
    assert len(sides) == 2 and abs(min(r["count"] for r in sides) / 2000 - 0.2) < 0.05
