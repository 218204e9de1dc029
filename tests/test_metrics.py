import math

import numpy as np
import pytest

from visitrisk.operators import metrics


def measured(spark, pairs):
    rows = spark.createDataFrame([("s", y, p) for y, p in pairs], "side string, y double, p double")
    return metrics.regression_metrics(rows, "y", "p", "side").first()


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(50, 20, 500), rng.normal(50, 20, 500)
    row = measured(spark, [(float(a), float(b)) for a, b in zip(y, p)])
    assert row["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row["mae"] == pytest.approx(np.mean(np.abs(y - p)))
    assert row["r2"] == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


@pytest.mark.parametrize(
    ("pairs", "r2"), [([(3.0, 3.0)] * 4, 1.0), ([(3.0, 4.0)] * 4, 0.0), ([(1.0, 1.0)], math.nan)]
)
def test_constant_label(spark, pairs, r2):
    found = measured(spark, pairs)["r2"]
    assert found == r2 or (math.isnan(found) and math.isnan(r2))


def test_pairs_without_label_do_not_count(spark):
    assert measured(spark, [(1.0, 2.0), (3.0, 3.0), (None, 9.0), (4.0, None)])["mae"] == 0.5
    row = measured(spark, [(1.0, 1.0), (2.0, None)])
    assert (row["n"], row["skipped"], row["rmse"]) == (1, 1, 0)
    row = measured(spark, [(2.0, None)])
    assert (row["n"], row["skipped"], row["rmse"]) == (0, 1, None)


def test_counts(spark):
    rows = spark.createDataFrame([("TRAIN",)] * 3 + [("TEST",)] * 2, "data_split string")
    assert tuple(metrics.split_counts(rows).first()) == (5, 3, 2)
    assert tuple(metrics.split_counts(rows.filter("false")).first()) == (0, 0, 0)
    assert metrics.row_count(rows).first()["records"] == 5
