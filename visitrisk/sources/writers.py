"""Writers. A run replaces its own dated folder as a whole, so running it again changes nothing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from visitrisk.functions.split import SPLIT
from visitrisk.operators.extract import features_only, ids_only
from visitrisk.sources.layout import CSV_OPTIONS, RUN_DATE, SCORE_DAY, in_partition
from visitrisk.spec import FeatureSpec


def write_training(extract: DataFrame, base: str, run_day: date) -> None:
    """Train and test rows in one pass, as partitions of the run's folder."""
    path = in_partition(base, RUN_DATE, run_day)
    extract.write.mode("overwrite").partitionBy(SPLIT).parquet(path)


def write_scoring(extract: DataFrame, base: str, day: date) -> None:
    """Ids and features together. Everything else is derived from this dataset."""
    extract.write.mode("overwrite").parquet(in_partition(base, SCORE_DAY, day))


# A file with line breaks inside text is read by one task, so no file may grow large.
CSV_ROWS_PER_FILE = 1_000_000


def _csv(df: DataFrame, path: str, header: bool, rows_per_file: int = CSV_ROWS_PER_FILE) -> None:
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS).option("header", header)
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)


def write_ids_csv(complete: DataFrame, spec: FeatureSpec, path: str) -> None:
    _csv(ids_only(complete, spec), path, header=True)


def write_feature_csv(
    complete: DataFrame,
    spec: FeatureSpec,
    path: str,
    with_id: bool = False,
    rows_per_file: int = CSV_ROWS_PER_FILE,
) -> None:
    """Features in model order, without a header; the id before them with ``with_id``.

    A scorer elsewhere needs the id in each record to return ``id,prediction``: records of two files
    cannot be paired by position.
    """
    rows = complete.select(spec.id, *spec.raw_features) if with_id else features_only(complete, spec)
    _csv(rows, path, header=False, rows_per_file=rows_per_file)


def write_feature_json(complete: DataFrame, spec: FeatureSpec, path: str) -> None:
    """Id and features, one record per line."""
    complete.select(spec.id, *spec.raw_features).write.mode("overwrite").json(path)


def write_predictions_csv(scored: DataFrame, path: str, with_id: bool = True) -> None:
    """``id,prediction`` per line, or the prediction alone."""
    id_column, prediction = scored.columns
    _csv(scored if with_id else scored.select(prediction), path, header=False)


def write_predictions_json(scored: DataFrame, path: str) -> None:
    """One record with id and prediction per line."""
    scored.write.mode("overwrite").json(path)
