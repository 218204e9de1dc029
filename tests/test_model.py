from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from visitrisk.operators import model as boost
from visitrisk.operators import trees
from visitrisk.operators.encode import write_codes
from visitrisk.operators.matrix import FEATURES, assembler, feature_matrix
from visitrisk.spec import FeatureSpec

SPEC = FeatureSpec(("b",), ("c",), ("n",), target="label", id="id", event_time="at")
PARAMS = boost.BoostParams(rounds=6, max_depth=3, step=0.3)


def learnable(spark, rows=1200):
    unit = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return (
        spark.range(0, rows, numPartitions=4)
        .withColumn("b", (F.col("id") % 2).cast("int"))
        .withColumn("c_ENCODED", (F.col("id") % 5).cast("int"))
        .withColumn("n", unit)
        .withColumn("label", 20.0 * F.col("b") + 3 * F.col("c_ENCODED") + 10 * F.col("n"))
        .withColumn("data_split", F.when(F.col("id") % 7 == 0, "TEST").otherwise("TRAIN"))
    )


@pytest.fixture(scope="module")
def trained(spark):
    return boost.train(learnable(spark), SPEC.model_features, PARAMS)


def test_defaults():
    p = boost.BoostParams()
    assert (p.rounds, p.max_depth, p.step, p.row_share, p.column_share, p.seed, p.patience) == (
        1400,
        6,
        0.0769,
        0.958,
        0.707,
        42,
        50,
    )


@pytest.mark.parametrize(
    ("errors", "patience", "expected"),
    [
        ([5, 4, 3, 2], 2, (4, False)),
        ([5, 3, 4, 4, 1], 2, (2, True)),
        ([5, 3, 4, 2, 3, 3], 2, (4, True)),
        ([5, 3, 4, 2, 3], 2, (4, False)),
        ([1], 1, (1, False)),
        ([1, 1, 1], 2, (1, True)),
    ],
)
def test_patience(errors, patience, expected):
    assert boost.rounds_to_keep(errors, patience) == expected


def test_better_than_the_mean(spark, trained):
    found = {r["dataset"]: r for r in trained.metrics.collect()}
    assert set(found) == {"TRAIN", "VALIDATION"}
    spread = learnable(spark).filter("data_split = 'TEST'").agg(F.stddev_pop("label")).first()[0]
    assert found["VALIDATION"]["rmse"] < spread / 2
    assert found["VALIDATION"]["r2"] > 0.7


def test_same_rows_and_seed_give_the_same_model(spark, trained):
    again = boost.train(learnable(spark), SPEC.model_features, PARAMS)
    rows = learnable(spark)
    first = trained.pipeline.transform(rows).select("id", "prediction").collect()
    assert sorted(first) == sorted(again.pipeline.transform(rows).select("id", "prediction").collect())


def test_fewer_rounds_are_a_prefix(spark, trained):
    short = boost.train(learnable(spark), SPEC.model_features, replace(PARAMS, rounds=2)).pipeline.stages[1]
    long = trained.pipeline.stages[1]
    assert [t.toDebugString.split("\n")[1:] for t in short.trees] == [
        t.toDebugString.split("\n")[1:] for t in long.trees[:2]
    ]
    assert list(long.treeWeights) == [1.0] + [0.3] * 5


@pytest.mark.parametrize("patience", [2, 4])
def test_stops_early_and_fits_no_more_than_the_patience_after_the_best_round(spark, patience):
    noise = learnable(spark, 400).withColumn("label", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) * 1.0)
    trained = boost.train(noise, SPEC.model_features, replace(PARAMS, rounds=40, patience=patience, step=1.0))
    best = trained.validation_errors.index(min(trained.validation_errors)) + 1
    assert len(trained.validation_errors) == len(trained.training_errors) == best + patience < 40
    assert trained.pipeline.stages[1].getNumTrees == best
    measured = {r["dataset"]: r["rmse"] for r in trained.metrics.collect()}
    assert measured["VALIDATION"] == pytest.approx(min(trained.validation_errors) ** 0.5)
    assert measured["TRAIN"] == pytest.approx(trained.training_errors[best - 1] ** 0.5)


def test_a_tree_splits_on_its_drawn_columns_only(spark):
    params = replace(PARAMS, column_share=0.34, rounds=6)
    model = boost.train(learnable(spark), SPEC.model_features, params).pipeline.stages[1]
    drawn = [boost.drawn_columns(3, params, i) for i in range(6)]
    used = [{int(x.split(" ")[0]) for x in t.toDebugString.split("feature ")[1:]} for t in model.trees]
    assert all(u <= set(d) for u, d in zip(used, drawn)) and len({tuple(d) for d in drawn}) > 1
    assert any(used)


@pytest.mark.parametrize("penalty", [0.0, 1.0, 50.0])
def test_leaves_are_shrunk_by_the_penalty(spark, penalty):
    params = replace(PARAMS, rounds=1, max_depth=1, row_share=1.0, column_share=1.0, leaf_penalty=penalty)
    rows = learnable(spark)
    trained = boost.train(rows, SPEC.model_features, params)
    expected = {r["b"]: r["s"] / (r["n"] + penalty) for r in rows.filter("data_split = 'TRAIN'").groupBy("b").agg(F.sum("label").alias("s"), F.count("*").alias("n")).collect()}
    for r in trained.pipeline.transform(rows).groupBy("b").agg(F.min("prediction").alias("low"), F.max("prediction").alias("high")).collect():
        assert r["low"] == r["high"] == pytest.approx(expected[r["b"]])


def test_a_round_is_one_pass_a_level_and_one_more(spark):
    jobs = {}
    for rounds in (2, 5):
        spark.sparkContext.setJobGroup(f"rounds {rounds}", "boosting")
        boost.train(learnable(spark), SPEC.model_features, replace(PARAMS, rounds=rounds))
        jobs[rounds] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds {rounds}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[5] - jobs[2] == 3 * (PARAMS.max_depth + 1)


def test_the_first_tree_is_that_of_all_values(spark):
    """With few values a column, bins lose nothing: the tree is the one MLlib fits to the same rows."""
    names = ["b", "c_ENCODED", "n"]
    rows = learnable(spark).withColumn("n", F.floor(F.col("n") * 40) / 8)
    params = replace(PARAMS, rounds=1, max_depth=4, row_share=1.0, column_share=1.0, leaf_penalty=0.0)
    ours = boost.train(rows, names, params).pipeline.transform(rows).select("id", "prediction").collect()
    vectors = assembler(names).transform(rows)
    plain = DecisionTreeRegressor(featuresCol=FEATURES, labelCol="label", maxDepth=4, maxBins=256).fit(vectors.filter("data_split = 'TRAIN'"))
    expected = dict(plain.transform(vectors).select("id", "prediction").collect())
    assert {r["id"]: r["prediction"] for r in ours} == pytest.approx(expected)
    assert len(set(expected.values())) > 8


def test_odd_features_are_binned_as_they_are_scored(spark):
    """NaN, NULL, infinite and repeated values: errors from the residuals are those of the stored model."""
    odd = F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 7 == 1, None).when(F.col("id") % 11 == 0, float("inf"))
    odd = odd.when(F.col("id") % 13 == 0, float("-inf")).when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("n"))
    rows = learnable(spark).withColumn("n", odd).unionByName(learnable(spark, 300))
    trained = boost.train(rows, SPEC.model_features, replace(PARAMS, bins=16, column_share=1.0, keep_best=False))
    measured = {r["dataset"]: r["rmse"] for r in trained.metrics.collect()}
    assert measured["TRAIN"] == pytest.approx(trained.training_errors[-1] ** 0.5)
    assert measured["VALIDATION"] == pytest.approx(trained.validation_errors[-1] ** 0.5)


def test_passes_over_parts_of_a_level_give_the_same_model(spark, trained):
    parts = boost.train(learnable(spark), SPEC.model_features, replace(PARAMS, histogram_mb=0))
    assert parts.training_errors == pytest.approx(trained.training_errors)


def test_cut_points_use_all_rows(spark):
    rows = spark.range(100_000).select(F.col("id").alias("many"), (F.col("id") >= 99_999).cast("int").alias("seldom"), F.lit(3).alias("one"))
    many, seldom, one = trees.cut_points(rows, ["many", "seldom", "one"], 256)
    assert np.abs(many - np.arange(1, 256) * 100_000 / 256).max() < 25
    assert seldom.tolist() == [0.5] and one.tolist() == []


@pytest.mark.parametrize("rows", ["data_split = 'TEST'", "id >= 0"])
def test_training_rows_without_a_label_are_an_error(spark, rows):
    bad = learnable(spark).withColumn("label", F.when(F.col("id") != 5, F.col("label"))).filter(rows)
    with pytest.raises(ValueError, match="training rows"):
        boost.train(bad, SPEC.model_features, PARAMS)


def test_scores_keep_ids_and_stored_order(spark, trained):
    codes = spark.createDataFrame([("c", str(i), i) for i in range(5)], "feature string, value string, code int")
    cleaned = learnable(spark).select("n", "id", F.col("c_ENCODED").cast("string").alias("c"), "b")
    scored = boost.score(cleaned, SPEC, trained.pipeline, codes)
    expected = trained.pipeline.transform(learnable(spark)).select("id", "prediction")
    assert sorted(scored.collect()) == sorted(expected.collect())


def test_a_feature_the_model_needs_is_an_error(spark, trained):
    codes = spark.createDataFrame([("c", "0", 0)], "feature string, value string, code int")
    cleaned = spark.createDataFrame([(1, 1, "0")], "id int, b int, c string")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        boost.score(cleaned, SPEC, trained.pipeline, codes)


def test_matrix_order_and_nan(spark):
    codes = spark.createDataFrame([("c", "0", 0)], "feature string, value string, code int")
    cleaned = spark.createDataFrame([(float("nan"), "0", 1, 7)], "n double, c string, b int, id int")
    matrix = feature_matrix(cleaned, SPEC, codes, keep=["id"])
    assert matrix.columns == ["id", "b", "c_ENCODED", "n"]
    vector = assembler(SPEC.model_features).transform(matrix).first()[FEATURES].toArray()
    assert vector[:2].tolist() == [1.0, 0.0] and vector[2] != vector[2]


def test_saved_model_scores_alike(spark, trained, tmp_path):
    codes = spark.createDataFrame([("c", "0", 0)], "feature string, value string, code int")
    write_codes(codes, boost.codes_path(str(tmp_path), "v1"))
    boost.save_model(trained.pipeline, str(tmp_path), "v1")
    pipeline, loaded = boost.load_model(spark, str(tmp_path), "v1")
    assert boost.feature_names(pipeline) == list(SPEC.model_features) == trained.feature_names
    assert loaded.collect() == codes.collect()
    rows = learnable(spark)
    assert (
        pipeline.transform(rows).agg(F.sum("prediction")).first()
        == trained.pipeline.transform(rows).agg(F.sum("prediction")).first()
    )


def test_latest_version(spark, trained, tmp_path):
    path = str(tmp_path)
    for version, day in (("0010", 3), ("0011", 5), ("0010", 4)):
        boost.register_version(boost.version_rows(trained.metrics, version, datetime(2024, 1, day)), path)
    versions = boost.read_versions(spark, path)
    assert versions.count() == 4
    assert tuple(boost.latest_version(versions).first()) == ("0011", datetime(2024, 1, 5))
    assert boost.latest_version(versions.filter("false")).first()["model_version"] is None
