"""Scoring run: extract yesterday's visits, score them with the latest model."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.functions.days import yesterday
from visitrisk.operators.extract import scoring_extract
from visitrisk.operators.model import latest_version, load_model, read_versions, score
from visitrisk.sources.folders import exists, remove
from visitrisk.sources.layout import SCORE_DAY, in_partition
from visitrisk.sources.readers import read_feature_csv, read_feature_json, read_scoring
from visitrisk.sources.writers import (
    write_feature_csv,
    write_ids_csv,
    write_predictions_csv,
    write_predictions_json,
    write_scoring,
)
from visitrisk.spec import FeatureSpec

log = logging.getLogger(__name__)


def extract_scoring_set(
    visits: DataFrame, spec: FeatureSpec, as_of: date, base: str, exports: str | None = None
) -> int:
    """Write yesterday's cleaned visits and return their number; with none, write nothing.

    ``exports`` also gets CSV taken from the written dataset: the ids, and the features with and without
    the id before them. An earlier run's files of a day that has no visits now are removed.
    """
    day = yesterday(as_of)
    extract = scoring_extract(visits, spec, as_of)
    if extract.isEmpty():
        log.warning("no visits on %s", day)
        for folder in (base, exports):
            if folder is not None:
                remove(visits.sparkSession, in_partition(folder, SCORE_DAY, day))
        return 0
    write_scoring(extract, base, day)
    complete = read_scoring(visits.sparkSession, base, day)
    if exports is not None:
        folder = in_partition(exports, SCORE_DAY, day)
        write_ids_csv(complete, spec, f"{folder}/ids")
        write_feature_csv(complete, spec, f"{folder}/features")
        write_feature_csv(complete, spec, f"{folder}/keyed_features", with_id=True)
    return complete.count()


def run_scoring(
    visits: DataFrame,
    spec: FeatureSpec,
    as_of: date,
    scoring: str,
    models: str,
    versions: str,
    predictions: str,
    exports: str | None = None,
) -> str | None:
    """Write ``(id, prediction)`` of yesterday's visits; returns the version used, None without visits."""
    spark = visits.sparkSession
    day = yesterday(as_of)
    if extract_scoring_set(visits, spec, as_of, scoring, exports) == 0:
        remove(spark, in_partition(predictions, SCORE_DAY, day))
        return None
    version = _newest(spark, versions)
    pipeline, codes = load_model(spark, models, version)
    scored = score(read_scoring(spark, scoring, day), spec, pipeline, codes)
    scored.write.mode("overwrite").parquet(in_partition(predictions, SCORE_DAY, day))
    return version


def _newest(spark: SparkSession, versions: str) -> str:
    newest = latest_version(read_versions(spark, versions)).first()["model_version"] if exists(spark, versions) else None
    if newest is None:
        raise ValueError("no model version is registered")
    return newest


def score_files(
    spark: SparkSession,
    spec: FeatureSpec,
    features: str,
    models: str,
    versions: str,
    predictions: str,
    format: str = "csv",
    id_type: T.DataType | None = None,
    lines: bool = False,
    multi_line: bool = False,
) -> str:
    """Score files of cleaned features with the model trained last; returns its version.

    ``features`` are CSV without a header or JSON (an array of records or one record per file, or one
    record per line with ``lines``); CSV text with line breaks needs ``multi_line``. With ``id_type`` records begin with, or hold, the id, and ``predictions`` gets
    ``id,prediction`` CSV lines, or JSON records for JSON; without it, one prediction per line.
    A record that does not fit is an error.
    """
    if format == "json":
        rows = read_feature_json(spark, features, spec, id_type, lines)
    else:
        rows = read_feature_csv(spark, features, spec, id_type, multi_line)
    version = _newest(spark, versions)
    pipeline, codes = load_model(spark, models, version)
    keyed = rows if id_type is not None else rows.withColumn(spec.id, F.lit(None).cast("string"))
    scored = score(keyed, spec, pipeline, codes)
    if format == "json" and id_type is not None:
        write_predictions_json(scored, predictions)
    else:
        write_predictions_csv(scored, predictions, with_id=id_type is not None)
    return version
