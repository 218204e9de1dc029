"""Load run: turn a day's predictions into rows of the score table."""

from __future__ import annotations

import logging
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from visitrisk.functions import cleaning
from visitrisk.functions.days import yesterday
from visitrisk.operators.reports import scores_on
from visitrisk.operators.scores import (
    MODEL_VERSION,
    append_scores,
    clear_owned,
    create_score_table,
    finish_pending,
    pair_scores,
    pairing_counts,
    read_score_table,
    rejected_scores,
    replace_scores,
    score_rows,
)
from visitrisk.sources.layout import SCORE_DAY, in_partition
from visitrisk.sources.readers import read_ids_csv, read_predictions_csv
from visitrisk.spec import FeatureSpec

log = logging.getLogger(__name__)


def load_scores(
    spark: SparkSession,
    spec: FeatureSpec,
    as_of: date,
    version: str | None,
    predictions: str,
    table: str,
    scored_at: datetime | None = None,
) -> int:
    """Store the predictions of a scoring run, replacing an earlier load of the same day and version.

    ``version`` None, from a scoring run without visits, stores nothing: a day without visits has no
    scores, so those an earlier run of that day left are removed. Scores made elsewhere stay.
    """
    if version is None:
        clear_owned(spark, table, yesterday(as_of))
        return 0
    scored = spark.read.parquet(in_partition(predictions, SCORE_DAY, yesterday(as_of)))
    return replace_scores(score_rows(scored, spec, as_of, version, scored_at=scored_at), spec, table, owned=True)


def load_external_scores(
    spark: SparkSession,
    spec: FeatureSpec,
    as_of: date,
    version: str,
    ids: str,
    predictions: str,
    table: str,
    scored_at: datetime | None = None,
    id_type: str = "string",
) -> int:
    """The same for scores made elsewhere: an ids CSV and an ``id,prediction`` CSV, paired by id.

    Rows are added to what the table holds; a score it already holds stays, a NULL it holds is filled.
    A prediction that is no number is loaded as NULL. These, and ids and predictions that do not pair,
    are counted in the log.
    """
    text = read_predictions_csv(spark, predictions, "prediction", spec.id, id_type)
    checked = rejected_scores(text, "prediction").first()
    if checked["rejected"]:
        log.warning("%d of %d predictions are no numbers", checked["rejected"], checked["read"])
    numbers = text.select(spec.id, cleaning.score("prediction").alias("prediction"))
    asked = read_ids_csv(spark, ids, spec.id, id_type)
    counts = pairing_counts(asked, numbers, spec.id).first().asDict()
    if any(n for name, n in counts.items() if name != "ids"):
        log.warning("pairing of ids and predictions: %s", counts)
    rows = score_rows(pair_scores(asked, numbers, spec.id), spec, as_of, version, scored_at=scored_at)
    finish_pending(spark, table)
    create_score_table(spark, spec, table)
    stored = _stored(spark, spec, as_of, version, table)
    return append_scores(rows, stored, spec, table) or stored.count()


def _stored(spark: SparkSession, spec: FeatureSpec, as_of: date, version: str, table: str) -> DataFrame:
    rows = scores_on(read_score_table(spark, spec, table), yesterday(as_of))
    return rows.filter(rows[MODEL_VERSION] == version)
