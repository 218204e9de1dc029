"""Day filters as half-open ranges on the raw column, so that they reach the parquet scan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitrisk.spec import FeatureSpec


def yesterday(as_of: date) -> date:
    return as_of - timedelta(days=1)


def _midnight(df: DataFrame, column: str, day: date) -> Column:
    # A literal of the column's own type: a cast on the column side would stop the pushdown.
    return F.lit(day.isoformat()).cast(df.select(column).schema[0].dataType)


def _partition(df: DataFrame, spec: FeatureSpec) -> str | None:
    name = spec.day_partition
    return name if name and name.lower() in {c.lower() for c in df.columns} else None


def since(df: DataFrame, spec: FeatureSpec, first: date) -> Column:
    """Visits from the start of ``first`` on, without an upper end."""
    condition = F.col(spec.event_time) >= _midnight(df, spec.event_time, first)
    partition = _partition(df, spec)
    if partition:
        condition &= F.col(partition) >= _midnight(df, partition, first)
    return condition


def during(df: DataFrame, spec: FeatureSpec, day: date) -> Column:
    """Visits of one calendar day."""
    start = _midnight(df, spec.event_time, day)
    end = _midnight(df, spec.event_time, day + timedelta(days=1))
    condition = (F.col(spec.event_time) >= start) & (F.col(spec.event_time) < end)
    partition = _partition(df, spec)
    if partition:
        condition &= F.col(partition) == _midnight(df, partition, day)
    return condition
