"""Clean feature sets for training and for scoring: filter, then one projection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrisk.functions import cleaning, days
from visitrisk.functions.split import SEED, SPLIT, TEST_SHARE, split_label
from visitrisk.spec import FeatureSpec

# Fixed value: days of history a training run looks back.
LOOKBACK_DAYS = 15


def _cleaned(spec: FeatureSpec) -> list:
    return (
        [cleaning.flag(c) for c in spec.boolean]
        + [cleaning.category(c) for c in spec.categorical]
        + [cleaning.number(c) for c in spec.numeric]
    )


def clean_for_training(visits: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Cleaned features in model order, then the target."""
    return visits.select(*_cleaned(spec), spec.target)


def clean_for_scoring(visits: DataFrame, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The id and columns to ``keep``, then cleaned features in model order. Needs no target."""
    return visits.select(spec.id, *keep, *_cleaned(spec))


def labelled_since(visits: DataFrame, spec: FeatureSpec, first: date) -> DataFrame:
    return visits.filter(F.col(spec.target).isNotNull() & days.since(visits, spec, first))


def training_extract(
    visits: DataFrame,
    spec: FeatureSpec,
    as_of: date,
    lookback_days: int = LOOKBACK_DAYS,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Labelled visits of the lookback, cleaned, each marked TRAIN or TEST in ``data_split``."""
    recent = labelled_since(visits, spec, as_of - timedelta(days=lookback_days))
    return recent.select(*_cleaned(spec), spec.target, split_label(spec.id, test_share, seed, spec.event_time))


def one_split(extract: DataFrame, side: str) -> DataFrame:
    """The rows of one side, without the marker."""
    return extract.filter(F.col(SPLIT) == side).drop(SPLIT)


def scoring_extract(visits: DataFrame, spec: FeatureSpec, as_of: date) -> DataFrame:
    """Yesterday's visits, cleaned, with their id."""
    day = days.yesterday(as_of)
    return clean_for_scoring(visits.filter(days.during(visits, spec, day)), spec)


def ids_only(extract: DataFrame, spec: FeatureSpec) -> DataFrame:
    return extract.select(spec.id)


def features_only(extract: DataFrame, spec: FeatureSpec) -> DataFrame:
    return extract.select(*spec.raw_features)
