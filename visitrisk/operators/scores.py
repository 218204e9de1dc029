"""Score rows: pair with ids, complete, add to the table once, join back to visits."""

from __future__ import annotations

from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.functions import cleaning
from visitrisk.functions.days import yesterday
from visitrisk.sources.folders import exists, mark, move, remove, remove_if_empty, subfolders
from visitrisk.spec import FeatureSpec

# Columns of the score table after the id, and the version of an unnamed model.
SCORE = "PREDICTED_FRAUD_SCORE"
MODEL_VERSION = "MODEL_VERSION"
SCORE_DATE = "SCORE_DATE"
SCORED_AT = "SCORED_AT"
CREATED_AT = "CREATED_AT"
UNKNOWN_VERSION = "unknown"

# Readers of a table skip folders that begin so: what is to be published, and which days and versions a run has stored.
PENDING = "_pending"
OWNED = "_owned"


def score_table_schema(spec: FeatureSpec) -> T.StructType:
    return T.StructType(
        [
            T.StructField(spec.id.upper(), T.StringType()),
            T.StructField(SCORE, T.FloatType()),
            T.StructField(MODEL_VERSION, T.StringType()),
            T.StructField(SCORE_DATE, T.DateType()),
            T.StructField(SCORED_AT, T.TimestampNTZType()),
            T.StructField(CREATED_AT, T.TimestampNTZType()),
        ]
    )


def _single(ids: DataFrame, predictions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Each id once with how often it came; each predicted id once with its least and greatest value."""
    value = next(c for c in predictions.columns if c != key)
    number = F.col(value)
    if dict(predictions.dtypes)[value] in ("double", "float"):
        number = F.when(~F.isnan(value), F.col(value))
    every = ids.groupBy(key).agg(F.count("*").alias("times"))
    single = predictions.groupBy(F.col(key).alias("__key")).agg(F.max(number).alias(value), F.min(number).alias("__least"))
    return every, single


def pair_scores(ids: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Each id that has a prediction, once, with it.

    Pairs by key, never by position: row numbers differ between two files as soon as their partitions
    do. Both sides may repeat an id (a file delivered twice); of its values the greatest number counts,
    NaN never. NULL ids pair with nothing. Both sides are reduced before their only shuffle, and the
    join uses the partitioning of that. What does not pair is counted by :func:`pairing_counts`.
    """
    every, single = _single(ids, predictions, key)
    paired = every.filter(F.col(key).isNotNull()).join(single, F.col(key) == F.col("__key"))
    return paired.select(key, next(c for c in predictions.columns if c != key))


def pairing_counts(ids: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """One row: distinct ids, rows repeating one, rows with a NULL id on either side, ids without a prediction,
    predicted ids that are not among the ids, and ids with several different values."""
    value = next(c for c in predictions.columns if c != key)
    every, single = _single(ids, predictions, key)
    both = every.join(single.withColumn("__given", F.lit(True)), F.col(key) == F.col("__key"), "full")
    given, asked = F.col("__given").isNotNull(), F.col("times").isNotNull()
    null_id, null_key = asked & F.col(key).isNull(), given & F.col("__key").isNull()
    return both.agg(
        F.count_if(asked & ~null_id).alias("ids"),
        F.coalesce(F.sum(F.when(~null_id, F.col("times") - 1)), F.lit(0)).alias("repeated"),
        (F.coalesce(F.sum(F.when(null_id, F.col("times"))), F.lit(0)) + F.count_if(null_key)).alias("null_ids"),
        F.count_if(asked & ~given & ~null_id).alias("without_prediction"),
        F.count_if(given & ~asked & ~null_key).alias("without_id"),
        F.count_if(given & (F.col("__least") < F.col(value))).alias("conflicting"),
    )


def _moment(at: datetime | None) -> Column:
    return F.localtimestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def score_rows(
    scored: DataFrame,
    spec: FeatureSpec,
    as_of: date,
    model_version: str = UNKNOWN_VERSION,
    prediction: str = "prediction",
    scored_at: datetime | None = None,
) -> DataFrame:
    """Rows of the score table for yesterday's visits. A prediction that is no number gives NULL."""
    return scored.select(
        F.col(spec.id).cast("string").alias(spec.id.upper()),
        cleaning.score(prediction).alias(SCORE),
        F.lit(model_version).alias(MODEL_VERSION),
        F.lit(yesterday(as_of).isoformat()).cast("date").alias(SCORE_DATE),
        _moment(scored_at).alias(SCORED_AT),
        _moment(scored_at).alias(CREATED_AT),
    )


def rejected_scores(predictions: DataFrame, prediction: str) -> DataFrame:
    """How many predictions were read, and how many are no number."""
    bad = F.col(prediction).isNotNull() & cleaning.score(prediction).isNull()
    return predictions.agg(F.count("*").alias("read"), F.count_if(bad).alias("rejected"))


def merged(batch: DataFrame, stored: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The table's rows after adding ``batch``: one per id, date and model version.

    A stored number stays; a stored NULL or NaN gives way to the batch's number. Of several rows of a
    batch the one with the greatest number counts. Rows of a batch without an id are left out, stored ones stay
    as they are. All is reduced before the one shuffle.
    """
    key = [spec.id.upper(), SCORE_DATE, MODEL_VERSION]
    rest = [SCORE, SCORED_AT, CREATED_AT]
    none = F.col(SCORE).isNull() | F.isnan(SCORE)
    rank = F.struct(none.alias("none"), F.col("__new"), (-F.col(SCORE)).alias("order"), *[F.col(c) for c in rest])
    both = stored.withColumn("__new", F.lit(False)).unionByName(batch.withColumn("__new", F.lit(True)))
    single = both.filter(F.col(key[0]).isNotNull()).groupBy(*key).agg(F.min(rank).alias("first"))
    rows = single.select(*key, *[F.col(f"first.{c}").alias(c) for c in rest]).select(*batch.columns)
    return rows.unionByName(stored.filter(F.col(key[0]).isNull()).select(*batch.columns))


def read_score_table(spark: SparkSession, spec: FeatureSpec, path: str) -> DataFrame:
    schema = score_table_schema(spec)
    # The schema also keeps a version such as "0012" from being read as a number.
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def create_score_table(spark: SparkSession, spec: FeatureSpec, path: str) -> None:
    """An empty score table, unless there is one."""
    empty = spark.createDataFrame([], score_table_schema(spec))
    empty.write.mode("ignore").partitionBy(SCORE_DATE, MODEL_VERSION).parquet(path)


def _writer(rows: DataFrame, spec: FeatureSpec):
    key = spec.id.upper()
    # Sorted files plus a bloom filter stand in for an index on the id; the date is a partition.
    return (
        rows.sortWithinPartitions(SCORE_DATE, MODEL_VERSION, key)
        .write.partitionBy(SCORE_DATE, MODEL_VERSION)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
    )


def _pairs(spark: SparkSession, folder: str) -> list[str]:
    """The ``SCORE_DATE=../MODEL_VERSION=..`` folders below ``folder``; a load has few of them."""
    return [f"{day}/{version}" for day in subfolders(spark, folder) for version in subfolders(spark, f"{folder}/{day}")]


def finish_pending(spark: SparkSession, path: str) -> None:
    """Ends what a load has left that failed: it is published if it was written in full, else it goes.

    Every load begins with it.
    """
    for run in subfolders(spark, f"{path}/{PENDING}"):
        pending = f"{path}/{PENDING}/{run}"
        if exists(spark, f"{pending}/complete"):
            _exchange(spark, path, pending)
        remove(spark, pending)
    remove_if_empty(spark, f"{path}/{PENDING}")


def _exchange(spark: SparkSession, path: str, pending: str) -> None:
    for pair in _pairs(spark, f"{pending}/rows"):
        if exists(spark, f"{pending}/owned"):
            mark(spark, f"{path}/{OWNED}/{pair}/stored")
        move(spark, f"{pending}/rows/{pair}", f"{path}/{pair}")


def replace_scores(rows: DataFrame, spec: FeatureSpec, path: str, owned: bool = False) -> int:
    """Store whole days of model versions, in place of earlier runs of the same, and return the number of rows.

    In two steps: the rows are written and counted beside the table, then their folders take the place of the
    old ones. A load that fails before the second step changes nothing; one that fails in it is ended by the next
    load, or by :func:`finish_pending`. One load at a time. ``owned`` records the days and versions for
    :func:`clear_owned`.
    """
    spark = rows.sparkSession
    finish_pending(spark, path)
    pending = f"{path}/{PENDING}/{uuid4().hex}"
    _writer(rows, spec).parquet(f"{pending}/rows")
    written = read_score_table(spark, spec, f"{pending}/rows").count()  # from the files' footers
    if owned:
        mark(spark, f"{pending}/owned")
    mark(spark, f"{pending}/complete")
    _exchange(spark, path, pending)
    remove(spark, pending)
    remove_if_empty(spark, f"{path}/{PENDING}")
    return written


def clear_owned(spark: SparkSession, path: str, day: date) -> None:
    """Remove what loads with ``owned`` have stored of a day. What others have stored of it, under other versions, stays."""
    finish_pending(spark, path)
    folder = f"{SCORE_DATE}={day.isoformat()}"
    for version in subfolders(spark, f"{path}/{OWNED}/{folder}"):
        remove(spark, f"{path}/{folder}/{version}")
    remove(spark, f"{path}/{OWNED}/{folder}")
    for left in (OWNED, folder):
        remove_if_empty(spark, f"{path}/{left}")


def append_scores(rows: DataFrame, stored: DataFrame, spec: FeatureSpec, path: str) -> int:
    """Add ``rows`` to ``stored``, the present content of ``path``: see :func:`merged`. Returns the rows of the touched days.

    Only the days and versions of ``rows`` are read and replaced, each as a whole, so a load that
    fails or runs twice leaves no row double. There are few of them: one of each per load.
    """
    touched = F.broadcast(rows.select(SCORE_DATE, MODEL_VERSION).distinct())
    before = stored.join(touched, [SCORE_DATE, MODEL_VERSION], "left_semi").select(*rows.columns)
    return replace_scores(merged(rows, before, spec), spec, path)


def latest_scores(scores: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row per id, date and model version: the one scored last."""
    others = [F.col(SCORED_AT), F.col(CREATED_AT), F.col(SCORE)]
    return (
        scores.groupBy(spec.id.upper(), SCORE_DATE, MODEL_VERSION)
        .agg(F.max(F.struct(*others)).alias("last"))
        .select(spec.id.upper(), SCORE_DATE, MODEL_VERSION, f"last.{SCORE}")
    )


def join_back(visits: DataFrame, scores: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Every visit with the score and the version of each model that scored it, else NULLs.

    Scores stored twice do not multiply visits. They are reduced before the shuffle, so only the visit
    side can hold a hot id, and a left join can split that side.
    """
    key = spec.id.upper()
    latest = latest_scores(scores, spec).select(
        F.col(key).alias("__score_id"), F.col(SCORE_DATE).alias("__score_date"), SCORE, MODEL_VERSION
    )
    same_visit = F.col(spec.id).cast("string") == F.col("__score_id")
    same_day = F.to_date(spec.event_time) == F.col("__score_date")
    return visits.join(latest, same_visit & same_day, "left").drop("__score_id", "__score_date")
