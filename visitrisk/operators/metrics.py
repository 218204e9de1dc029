"""Counts and error measures, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrisk.functions.split import SPLIT, TEST, TRAIN


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records"))


def split_counts(extract: DataFrame) -> DataFrame:
    """Total, train and test rows together."""
    return extract.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(SPLIT) == TRAIN).alias("train"),
        F.count_if(F.col(SPLIT) == TEST).alias("test"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, by: str) -> DataFrame:
    """RMSE, MAE and R² for each value of ``by``, the ``n`` rows they rest on, and the ``skipped`` rows.

    Skipped are rows whose label or prediction is NULL; a group of nothing else has NULL errors. R² of
    a constant label is 1 for a perfect prediction and 0 otherwise; of fewer than two rows, NaN.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    known = y.isNotNull() & p.isNotNull()
    grouped = df.groupBy(by).agg(
        F.count_if(known).alias("n"),
        F.count_if(~known).alias("skipped"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(F.when(known, y)).alias("variance"),
    )
    r2 = (
        F.when(F.col("n") < 2, F.lit(float("nan")))
        .when(F.col("variance") > 0, 1 - F.col("mse") / F.col("variance"))
        .when(F.col("mse") == 0, 1.0)
        .otherwise(0.0)
    )
    return grouped.select(by, F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"), "n", "skipped")
