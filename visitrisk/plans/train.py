"""Training run: extract, encode, boost, measure, register."""

from __future__ import annotations

import logging
from datetime import date, datetime, time

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from visitrisk.functions.split import SPLIT, TRAIN
from visitrisk.operators.encode import fit_codes, read_codes, write_codes
from visitrisk.operators.extract import LOOKBACK_DAYS, training_extract
from visitrisk.operators.matrix import feature_matrix
from visitrisk.operators.metrics import split_counts
from visitrisk.operators.model import (
    LABEL,
    BoostParams,
    Trained,
    codes_path,
    register_version,
    save_model,
    train,
    version_rows,
)
from visitrisk.sources.folders import remove
from visitrisk.sources.layout import RUN_DATE, in_partition
from visitrisk.sources.readers import read_training
from visitrisk.sources.writers import write_training
from visitrisk.spec import FeatureSpec

log = logging.getLogger(__name__)


def extract_training_set(
    visits: DataFrame, spec: FeatureSpec, as_of: date, base: str, lookback_days: int = LOOKBACK_DAYS
) -> Row | None:
    """Write the run's train and test rows and count what was written; None when there are none."""
    extract = training_extract(visits, spec, as_of, lookback_days)
    if extract.isEmpty():
        log.warning("no labelled visits in the %d days before %s", lookback_days, as_of)
        remove(visits.sparkSession, in_partition(base, RUN_DATE, as_of))
        return None
    write_training(extract, base, as_of)
    # Counting the written files reads their footers only.
    counts = split_counts(read_training(visits.sparkSession, base, as_of)).first()
    log.info("training set of %s: %s", as_of, counts)
    return counts


def train_model(
    cleaned: DataFrame, spec: FeatureSpec, codes_folder: str, params: BoostParams = BoostParams()
) -> Trained:
    """Fit the codes on the train side and store them, encode both sides, boost."""
    found = spec.available(cleaned.columns)
    train_side = cleaned.filter(F.col(SPLIT) == TRAIN)
    write_codes(fit_codes(train_side, found.categorical), codes_folder)
    codes = read_codes(cleaned.sparkSession, codes_folder)
    labelled = cleaned.withColumnRenamed(spec.target, LABEL)
    matrix = feature_matrix(labelled, found, codes, keep=[LABEL, SPLIT])
    return train(matrix, found.model_features, params)


def run_training(
    visits: DataFrame,
    spec: FeatureSpec,
    as_of: date,
    version: str,
    training: str,
    models: str,
    versions: str,
    params: BoostParams = BoostParams(),
    trained_at: datetime | None = None,
) -> Trained | None:
    """Everything from visits to a registered model version; None when there is nothing to train on.

    ``trained_at`` is the start of ``as_of`` unless given: no step reads a clock.
    """
    if extract_training_set(visits, spec, as_of, training) is None:
        return None
    cleaned = read_training(visits.sparkSession, training, as_of)
    trained = train_model(cleaned, spec, codes_path(models, version), params)
    save_model(trained.pipeline, models, version)
    register_version(version_rows(trained.metrics, version, trained_at or datetime.combine(as_of, time())), versions)
    return trained
