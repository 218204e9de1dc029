"""The report queries on the score table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitrisk.operators.scores import SCORE, SCORE_DATE, SCORED_AT
from visitrisk.spec import FeatureSpec


def scores_on(scores: DataFrame, day: date) -> DataFrame:
    """The scores of one day; reads that day's partition only."""
    return scores.filter(F.col(SCORE_DATE) == F.lit(day.isoformat()).cast("date"))


def scores_of(scores: DataFrame, spec: FeatureSpec, visit_id: str) -> DataFrame:
    """All scores of one visit, the latest first."""
    return scores.filter(F.col(spec.id.upper()) == visit_id).orderBy(F.col(SCORED_AT).desc())


def daily_average(scores: DataFrame) -> DataFrame:
    """Average score and number of scores of each day, the latest day first."""
    return (
        scores.groupBy(SCORE_DATE)
        .agg(F.avg(SCORE).alias("avg_score"), F.count("*").alias("num_scored"))
        .orderBy(F.col(SCORE_DATE).desc())
    )


def preview(scores: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at."""
    return scores.limit(rows)
