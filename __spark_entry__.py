
from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.functions import cleaning, days
from visitrisk.functions.split import SPLIT, TEST, TRAIN
from visitrisk.operators import encode as enc
from visitrisk.operators import extract as ext
from visitrisk.operators import metrics, reports, retention
from visitrisk.operators import model as boost
from visitrisk.operators import scores as sc
from visitrisk.operators.matrix import feature_matrix
from visitrisk.plans import load, score, train
from visitrisk.scratch import application_folder
from visitrisk.sources import folders, readers, writers
from visitrisk.sources.layout import CSV_OPTIONS
from visitrisk.spec import VISIT_SPEC, FeatureSpec

try:  # the training-text operators can be left out
    import corpus_pipeline
    import visitrisk.llm.queries as llm
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "visitrisk.llm", "visitrisk.llm.queries"):
        raise
    llm = None

AS_OF = date(2024, 1, 31)
FIRST_DAY = date(2024, 1, 1)
SCORED_AT = datetime(2024, 1, 31, 3, 0, 0)

VISITS = FeatureSpec(
    boolean=("is_hosting", "is_mobile", "is_proxy"),
    categorical=("visitor_type", "publisher_name", "utm_content"),
    numeric=("gross_revenue", "visit_count"),
    target="fraud_score",
    id="visit_id",
    event_time="created_at",
)

# The visit table, derived from `events`. The text runs unchanged in Spark and in DuckDB.
VISITS_SQL = """
SELECT event_id AS visit_id,
       ts AS created_at,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 5.0 END AS fraud_score,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type = 'click' END AS is_hosting,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id % 2 = 0 END AS is_mobile,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id % 5 = 0 END AS is_proxy,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS visitor_type,
       CAST(user_id AS VARCHAR(20)) AS publisher_name,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE props END AS utm_content,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE value END AS gross_revenue,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(regexp_extract(props, '[0-9]+', 0) AS INT) END AS visit_count
FROM {events}
"""


def _wide_sql() -> str:
    """The same visits with every column of the full feature list, made by a rule from its position."""
    booleans = [
        f"CASE WHEN (event_id + {i}) % 7 = 0 THEN NULL ELSE (user_id + {i}) % 3 = 0 END AS {c}"
        for i, c in enumerate(VISIT_SPEC.boolean)
    ]
    categories = [
        f"CASE WHEN (event_id + {i}) % 11 = 0 THEN NULL ELSE concat(event_type, '-', (user_id + {i}) % {i + 5}) END AS {c}"
        for i, c in enumerate(VISIT_SPEC.categorical)
    ]
    numbers = [
        f"CASE WHEN (event_id + {i}) % 13 = 0 THEN NULL ELSE value * {i + 1} END AS {c}"
        for i, c in enumerate(VISIT_SPEC.numeric)
    ]
    columns = ", ".join(booleans + categories + numbers)
    return (
        f"SELECT event_id AS VISIT_ID, ts AS CREATED_AT, "
        f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 5.0 END AS {VISIT_SPEC.target}, "
        f"{columns} FROM {{events}}"
    )


# Scores of two model versions for every day, each load of version v1 made twice: (version, factor, hours).
LOADS = (("v1", 1.0, 0), ("v1", 0.5, 1), ("v2", 0.25, 0))


def _history_sql(visits: str) -> str:
    loads = [
        f"""SELECT CAST(visit_id AS VARCHAR) AS VISIT_ID,
CAST(COALESCE(CAST(visit_count AS DOUBLE), 0e0) * CAST({factor} AS DOUBLE) AS FLOAT) AS PREDICTED_FRAUD_SCORE,
'{version}' AS MODEL_VERSION, CAST(created_at AS DATE) AS SCORE_DATE,
created_at + INTERVAL {24 + hours} HOUR AS SCORED_AT, created_at + INTERVAL 24 HOUR AS CREATED_AT FROM {visits}"""
        for version, factor, hours in LOADS
    ]
    return " UNION ALL ".join(loads)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_visits(spark, f"{sf_dir}/events.parquet", "parquet")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VISITS_SQL, events=_events(spark, sf_dir))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_wide_sql(), events=_events(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = [F.struct(F.lit(v).alias("v"), F.lit(f).alias("f"), F.lit(h).alias("h")) for v, f, h in LOADS]
    score_of = F.coalesce(F.col("visit_count").cast("double"), F.lit(0.0)) * F.col("load.f")
    scored_at = F.col("created_at") + F.make_interval(hours=24 + F.col("load.h"))
    return (
        _visits(spark, sf_dir)
        .select("visit_id", "created_at", "visit_count", F.explode(F.array(*loads)).alias("load"))
        .select(
            F.col("visit_id").cast("string").alias("VISIT_ID"),
            score_of.cast("float").alias("PREDICTED_FRAUD_SCORE"),
            F.col("load.v").alias("MODEL_VERSION"),
            F.to_date("created_at").alias("SCORE_DATE"),
            scored_at.alias("SCORED_AT"),
            (F.col("created_at") + F.make_interval(hours=F.lit(24))).alias("CREATED_AT"),
        )
    )


def _folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    return application_folder(spark, f"{os.path.basename(sf_dir.rstrip('/'))}/{name}")


def _day_as_text(df: DataFrame, column: str) -> DataFrame:
    """Dates as ISO text, which both engines hand over alike."""
    return df.withColumn(column, F.col(column).cast("string"))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.clean_for_scoring(_visits(spark, sf_dir), VISITS)


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.training_extract(_visits(spark, sf_dir), VISITS, AS_OF)


def _scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.scoring_extract(_visits(spark, sf_dir), VISITS, AS_OF)


def _simple_score() -> F.Column:
    """An arithmetic stand-in for the model, so that both engines give the same score."""
    return F.lit(20.0) * F.col("is_mobile") + F.col("visit_count") / 2 + F.col("gross_revenue") / 10


def _scored(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(VISITS.id, _simple_score().alias("prediction"))


def _first_day_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = _visits(spark, sf_dir)
    first = ext.clean_for_scoring(visits.filter(days.during(visits, VISITS, FIRST_DAY)), VISITS)
    return enc.fit_codes(first, VISITS.categorical)


def _train_codes(extract: DataFrame) -> DataFrame:
    return enc.fit_codes(extract.filter(F.col(SPLIT) == TRAIN), VISITS.categorical)


# --- projections --------------------------------------------------------------------------------


def boolean_to_int(spark, sf_dir):
    return _visits(spark, sf_dir).select(VISITS.id, *[cleaning.flag(c) for c in VISITS.boolean])


def categorical_missing(spark, sf_dir):
    return _visits(spark, sf_dir).select(VISITS.id, *[cleaning.category(c) for c in VISITS.categorical])


def numeric_zero(spark, sf_dir):
    return _visits(spark, sf_dir).select(VISITS.id, *[cleaning.number(c) for c in VISITS.numeric])


def preprocess(spark, sf_dir):
    return ext.clean_for_training(_visits(spark, sf_dir), VISITS)


def available_columns(spark, sf_dir):
    fewer = _visits(spark, sf_dir).drop("is_proxy", "utm_content", "visit_count")
    return ext.clean_for_scoring(fewer, VISITS.available(fewer.columns))


def full_training_projection(spark, sf_dir):
    return ext.clean_for_training(_wide(spark, sf_dir), VISIT_SPEC)


def full_scoring_projection(spark, sf_dir):
    return ext.scoring_extract(_wide(spark, sf_dir), VISIT_SPEC, AS_OF)


# --- extracts -----------------------------------------------------------------------------------


def split_counts(spark, sf_dir):
    return metrics.split_counts(_training(spark, sf_dir))


def train_rows(spark, sf_dir):
    return ext.one_split(_training(spark, sf_dir), TRAIN)


def test_rows(spark, sf_dir):
    return ext.one_split(_training(spark, sf_dir), TEST)


def scoring_ids(spark, sf_dir):
    return ext.ids_only(_scoring(spark, sf_dir), VISITS)


def scoring_features(spark, sf_dir):
    return ext.features_only(_scoring(spark, sf_dir), VISITS)


def empty_day_guard(spark, sf_dir):
    return metrics.row_count(ext.scoring_extract(_visits(spark, sf_dir), VISITS, date(2024, 3, 1)))


# --- encoding -----------------------------------------------------------------------------------


def ordinal_fit(spark, sf_dir):
    return enc.fit_codes(_clean(spark, sf_dir), VISITS.categorical)


def ordinal_transform(spark, sf_dir):
    cleaned = _clean(spark, sf_dir).select(VISITS.id, *VISITS.categorical)
    return enc.encode(cleaned, _first_day_codes(spark, sf_dir), VISITS.categorical)


def ordinal_transform_broadcast(spark, sf_dir):
    cleaned = _clean(spark, sf_dir).select(VISITS.id, *VISITS.categorical)
    return enc.encode(cleaned, _first_day_codes(spark, sf_dir), VISITS.categorical, inline_bytes=0)


def ordinal_transform_shuffled(spark, sf_dir):
    cleaned = _clean(spark, sf_dir).select(VISITS.id, *VISITS.categorical)
    return enc.encode(cleaned, _first_day_codes(spark, sf_dir), VISITS.categorical, broadcast_bytes=0)


def saved_codes(spark, sf_dir):
    folder = _folder(spark, sf_dir, "saved_codes")
    enc.write_codes(_train_codes(_training(spark, sf_dir)), folder)
    return enc.read_codes(spark, folder)


def matrix(spark, sf_dir):
    extract = _training(spark, sf_dir)
    return feature_matrix(extract, VISITS, _train_codes(extract), keep=[VISITS.target, SPLIT])


# --- model --------------------------------------------------------------------------------------

# All 1,400 rounds may be used; the patience rule ends the run.
PATIENT = boost.BoostParams(patience=3, leaf_penalty=0.0)
# Eight rounds, all else as in a training run.
SHORT = boost.BoostParams(rounds=8)
PENALISED = boost.BoostParams(rounds=3, step=0.5, row_share=1.0, column_share=1.0, keep_best=False)
ONE_ROUND = boost.BoostParams(rounds=1, row_share=1.0, column_share=1.0, leaf_penalty=0.0)
FLAGS = replace(VISITS, categorical=(), numeric=())


def _learnable(spark, sf_dir):
    """Visits whose target depends on two of their flags."""
    mobile, proxy = (F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("is_mobile", "is_proxy"))
    return _visits(spark, sf_dir).withColumn(VISITS.target, F.lit(20.0) * mobile + F.lit(5.0) * proxy)


def _mixed(spark, sf_dir):
    """Visits whose target, 0 to 25, depends on a flag, a category and a number."""
    mobile, clicked = (F.coalesce(c, F.lit(False)).cast("int") for c in (F.col("is_mobile"), F.col("visitor_type") == "click"))
    many = F.least(F.coalesce("visit_count", F.lit(0)), F.lit(100)) / 20
    return _visits(spark, sf_dir).withColumn(VISITS.target, F.lit(10.0) * mobile + F.lit(10.0) * clicked + many)


def _model_paths(spark, sf_dir, name):
    base = _folder(spark, sf_dir, name)
    return base, {"models": f"{base}/models", "versions": f"{base}/versions"}


def _trained(spark, sf_dir, name, visits, spec, params):
    """A training run; its model as loaded again; its training rows."""
    base, paths = _model_paths(spark, sf_dir, name)
    trained = train.run_training(visits, spec, AS_OF, "m", f"{base}/training", params=params, **paths)
    pipeline, codes = boost.load_model(spark, paths["models"], "m")
    return trained, pipeline, codes, readers.read_training(spark, f"{base}/training", AS_OF)


def gbt_scores(spark, sf_dir):
    """Each visit of the day with a score of all features inside the target's range, and whether the model explains more
    than a third of the validation rows' variance."""
    visits = _mixed(spark, sf_dir)
    trained, pipeline, codes, _ = _trained(spark, sf_dir, "gbt", visits, VISITS, SHORT)
    scored = boost.score(ext.scoring_extract(visits, VISITS, AS_OF), VISITS, pipeline, codes)
    r2 = next(r["r2"] for r in trained.metrics.collect() if r["dataset"] == boost.VALIDATION)
    return scored.select(VISITS.id, F.col("prediction").between(-1, 26).alias("in_range"), F.lit(bool(r2 > 1 / 3)).alias("explains"))


def flag_scores(spark, sf_dir):
    """One unsampled round on the flags alone predicts the mean target of the training rows with the same flags."""
    visits = _visits(spark, sf_dir)
    _, pipeline, codes, _ = _trained(spark, sf_dir, "flags", visits, FLAGS, ONE_ROUND)
    scored = boost.score(ext.scoring_extract(visits, FLAGS, AS_OF), FLAGS, pipeline, codes)
    return scored.select(VISITS.id, F.round("prediction", 6).alias("prediction"))


def flag_metrics(spark, sf_dir):
    trained, *_ = _trained(spark, sf_dir, "flag_metrics", _visits(spark, sf_dir), FLAGS, ONE_ROUND)
    return trained.metrics.select("dataset", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def penalised_rounds(spark, sf_dir):
    """Three unsampled rounds on the flags, whose leaves are the flags' combinations, with a leaf penalty of 1."""
    visits = _visits(spark, sf_dir)
    _, pipeline, codes, _ = _trained(spark, sf_dir, "penalised", visits, FLAGS, PENALISED)
    scored = boost.score(ext.scoring_extract(visits, FLAGS, AS_OF), FLAGS, pipeline, codes)
    return scored.select(VISITS.id, F.round("prediction", 6).alias("prediction"))


def early_stopping(spark, sf_dir):
    """The flags explain the target, so no round after the first helps, and the patience rule ends the run: one round
    and the patience are fitted."""
    whole = replace(PATIENT, row_share=1.0, column_share=1.0)
    trained, pipeline, _, rows = _trained(spark, sf_dir, "early", _learnable(spark, sf_dir), FLAGS, whole)
    facts = {
        "kept": pipeline.stages[1].getNumTrees,
        "tried": len(trained.validation_errors),
        "best_error": round(min(trained.validation_errors), 6),
    }
    return rows.agg(F.count("*").alias("records")).select("*", *[F.lit(v).alias(n) for n, v in facts.items()])


def stored_order(spark, sf_dir):
    """Columns in another order than the model's come back in the stored one; a sum weighted by place shows it."""
    extract = _training(spark, sf_dir)
    names = list(VISITS.model_features)[::-1]
    shuffled = extract.select(*sorted(extract.columns))
    rows = feature_matrix(shuffled, VISITS, _train_codes(extract), names=names)
    weighted = sum((F.col(c) * (i + 1) for i, c in enumerate(rows.columns)), F.lit(0.0))
    return rows.agg(F.round(F.sum(weighted.cast("decimal(30,6)")).cast("double"), 2).alias("total"), F.count("*").alias("records"))


def daily_run(spark, sf_dir):
    """Train, score and load as the three jobs do; facts of the loaded table."""
    visits = _mixed(spark, sf_dir)
    base, paths = _model_paths(spark, sf_dir, "daily")
    train.run_training(
        visits, VISITS, AS_OF, "model-20240131", f"{base}/training", params=SHORT, trained_at=SCORED_AT, **paths
    )
    version = score.run_scoring(
        visits, VISITS, AS_OF, f"{base}/scoring", predictions=f"{base}/predictions", **paths
    )
    load.load_scores(spark, VISITS, AS_OF, version, f"{base}/predictions", f"{base}/scores", SCORED_AT)
    facts = sc.read_score_table(spark, VISITS, f"{base}/scores").groupBy("SCORE_DATE", "MODEL_VERSION").agg(
        F.count("*").alias("scored"),
        F.count_distinct("VISIT_ID").alias("ids"),
        F.count_if(F.col("PREDICTED_FRAUD_SCORE").between(-1, 26)).alias("in_range"),
    )
    return _day_as_text(facts, "SCORE_DATE")


def empty_day_run(spark, sf_dir):
    """A day with visits, then found empty: the steps give 0 or None, and what the first run left is gone."""
    visits = _learnable(spark, sf_dir)
    base, paths = _model_paths(spark, sf_dir, "empty_day")
    train.run_training(visits, FLAGS, AS_OF, "m", f"{base}/training", params=ONE_ROUND, **paths)
    counts = []
    for rows in (visits, visits.filter("created_at < TIMESTAMP_NTZ '2024-01-30 00:00:00'")):
        version = score.run_scoring(
            rows, FLAGS, AS_OF, f"{base}/scoring", predictions=f"{base}/predictions", **paths
        )
        counts.append(
            load.load_scores(spark, FLAGS, AS_OF, version, f"{base}/predictions", f"{base}/scores", SCORED_AT)
        )
    left = [d for kind in ("scoring", "predictions", "scores") for d in folders.subfolders(spark, f"{base}/{kind}")]
    facts = {"first": counts[0], "second": counts[1], "left": len(left)}
    return visits.agg(F.count("*").alias("visits")).select("*", *[F.lit(v).alias(n) for n, v in facts.items()])


def empty_day_with_others(spark, sf_dir):
    """A day loaded by a run and from elsewhere, then found empty: the scores from elsewhere stay."""
    base = _folder(spark, sf_dir, "others")
    extract = _scoring(spark, sf_dir)
    writers.write_ids_csv(extract, VISITS, f"{base}/ids")
    writers.write_predictions_csv(_scored(extract), f"{base}/elsewhere")
    _scored(extract).write.mode("overwrite").parquet(f"{base}/predictions/score_date=2024-01-30")
    load.load_scores(spark, VISITS, AS_OF, "own", f"{base}/predictions", f"{base}/scores", SCORED_AT)
    load.load_external_scores(spark, VISITS, AS_OF, "v1", f"{base}/ids", f"{base}/elsewhere", f"{base}/scores", SCORED_AT)
    load.load_scores(spark, VISITS, AS_OF, None, f"{base}/predictions", f"{base}/scores", SCORED_AT)
    return _stored(spark, f"{base}/scores")


def odd_names(spark, sf_dir):
    """Ids and scores handed over in folders with blanks, a percent sign, a plus and an accent in their names."""
    base = f"{_folder(spark, sf_dir, 'odd')}/a b/50% c+d é%20"
    extract = _scoring(spark, sf_dir)
    writers.write_ids_csv(extract, VISITS, f"{base}/ids")
    writers.write_predictions_csv(_scored(extract), f"{base}/predictions")
    load.load_external_scores(spark, VISITS, AS_OF, "v1", f"{base}/ids", f"{base}/predictions", f"{base}/scores", SCORED_AT)
    ids = readers.read_folder(spark, f"{base}/ids", "visit_id bigint").select(F.col("visit_id").cast("string").alias("VISIT_ID"))
    return _stored(spark, f"{base}/scores").join(ids, "VISIT_ID", "left_semi")


def _written_history(spark, sf_dir, name):
    """The score history as a score table: partitioned by day and version, sorted, with a bloom filter on the id."""
    folder = _folder(spark, sf_dir, name)
    sc.replace_scores(_history(spark, sf_dir), VISITS, folder)
    return sc.read_score_table(spark, VISITS, folder)


def stored_scores_by_visit(spark, sf_dir):
    return _day_as_text(reports.scores_of(_written_history(spark, sf_dir, "by_visit"), VISITS, "17"), "SCORE_DATE")


def stored_daily_report(spark, sf_dir):
    """The daily averages, and the scores of a day's visits joined back, both from the written table."""
    scores = _written_history(spark, sf_dir, "report")
    days_ = reports.daily_average(scores).select("SCORE_DATE", F.round("avg_score", 6).alias("avg_score"), "num_scored")
    visits = ext.clean_for_scoring(_visits(spark, sf_dir), VISITS, keep=[VISITS.event_time])
    joined = sc.join_back(visits, scores, VISITS).groupBy(F.to_date(VISITS.event_time).alias("SCORE_DATE")).agg(F.count(sc.SCORE).alias("joined"))
    return _day_as_text(days_.join(joined, "SCORE_DATE"), "SCORE_DATE")


def scored_files(spark, sf_dir):
    """Features with their id as CSV, scored, returned as ``id,prediction``, loaded as scores made elsewhere."""
    visits = _visits(spark, sf_dir)
    base, paths = _model_paths(spark, sf_dir, "scored_files")
    train.run_training(visits, FLAGS, AS_OF, "m", f"{base}/training", params=ONE_ROUND, **paths)
    score.extract_scoring_set(visits, FLAGS, AS_OF, f"{base}/scoring", f"{base}/exports")
    exported = f"{base}/exports/score_date=2024-01-30"
    version = score.score_files(
        spark, FLAGS, f"{exported}/keyed_features", predictions=f"{base}/returned", id_type=T.LongType(), **paths
    )
    load.load_external_scores(
        spark, VISITS, AS_OF, version, f"{exported}/ids", f"{base}/returned", f"{base}/scores", SCORED_AT
    )
    number = F.round(F.col("PREDICTED_FRAUD_SCORE").cast("double"), 3).alias("PREDICTED_FRAUD_SCORE")
    return _stored(spark, f"{base}/scores").select("VISIT_ID", number, "MODEL_VERSION", "SCORE_DATE")


def json_files(spark, sf_dir):
    """Features as JSON arrays of up to 500 records and as files of one object, read without lines."""
    path = _folder(spark, sf_dir, "json_arrays")
    cleaned = _clean(spark, sf_dir)
    alone = F.col(VISITS.id) % 1000 == 7
    file = F.when(alone, F.col(VISITS.id)).otherwise(-1 - F.floor(F.col(VISITS.id) / 500)).alias("file")
    records = cleaned.select(file, F.to_json(F.struct(*cleaned.columns)).alias("record")).groupBy("file")
    array = F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]"))
    texts = records.agg(F.when(F.col("file") >= 0, F.max("record")).otherwise(array).alias("value"))
    texts.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return readers.read_feature_json(spark, path, VISITS, cleaned.schema[VISITS.id].dataType)


def _measured(extract: DataFrame) -> DataFrame:
    """The score of every fifth visit count is missing."""
    known = F.when(F.col("visit_count") % 5 != 0, _simple_score())
    return extract.select(SPLIT, VISITS.target, known.alias("prediction"))


def regression_metrics(spark, sf_dir):
    measured = metrics.regression_metrics(
        _measured(_training(spark, sf_dir)), VISITS.target, "prediction", SPLIT
    )
    return measured.select(SPLIT, *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")], "n", "skipped")


def model_versions(spark, sf_dir):
    """Register two versions, the first one twice; the one trained last is picked."""
    folder = _folder(spark, sf_dir, "versions")
    measured = metrics.regression_metrics(
        _measured(_training(spark, sf_dir)), VISITS.target, "prediction", SPLIT
    ).withColumnRenamed(SPLIT, "dataset")
    for version, at in (
        ("model-a", datetime(2024, 1, 15, 2)),
        ("model-b", datetime(2024, 1, 31, 2)),
        ("model-a", datetime(2024, 1, 16, 2)),
    ):
        boost.register_version(boost.version_rows(measured, version, at), folder)
    versions = boost.read_versions(spark, folder)
    latest = boost.latest_version(versions).first()["model_version"]
    return versions.select(
        "model_version",
        "trained_at",
        "dataset",
        *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")],
        F.lit(latest).alias("latest"),
    )


# --- scores -------------------------------------------------------------------------------------


def score_join(spark, sf_dir):
    cleaned = _clean(spark, sf_dir)
    labelled = _visits(spark, sf_dir).filter(F.col(VISITS.target).isNotNull())
    scored = _scored(ext.clean_for_scoring(labelled, VISITS))
    return sc.pair_scores(ext.ids_only(cleaned, VISITS), scored.union(scored), VISITS.id)


def _score_rows(spark, sf_dir):
    return sc.score_rows(_scored(_scoring(spark, sf_dir)), VISITS, AS_OF, "v1", scored_at=SCORED_AT)


def _stored(spark, folder):
    return _day_as_text(sc.read_score_table(spark, VISITS, folder), "SCORE_DATE")


def score_rows(spark, sf_dir):
    return _day_as_text(_score_rows(spark, sf_dir), "SCORE_DATE")


def idempotent_append(spark, sf_dir):
    folder = _folder(spark, sf_dir, "append")
    rows = _score_rows(spark, sf_dir)
    sc.create_score_table(spark, VISITS, folder)
    for _ in range(2):
        sc.append_scores(rows, sc.read_score_table(spark, VISITS, folder), VISITS, folder)
    return _stored(spark, folder)


def replaced_scores(spark, sf_dir):
    """Two versions loaded, one of them again: the other stays, nothing doubles."""
    folder = _folder(spark, sf_dir, "replace")
    scored = _scored(_scoring(spark, sf_dir))
    for version in ("v1", "v2", "v1"):
        sc.replace_scores(sc.score_rows(scored, VISITS, AS_OF, version, scored_at=SCORED_AT), VISITS, folder)
    return _stored(spark, folder)


def rejected_scores(spark, sf_dir):
    raw = F.when(F.col("visit_count") % 10 == 0, F.col("utm_content")).otherwise(
        F.col("visit_count").cast("string")
    )
    return sc.rejected_scores(_visits(spark, sf_dir).select(raw.alias("raw")), "raw")


def external_scores(spark, sf_dir):
    """Ids and scores handed over as CSV files, paired by id and loaded twice."""
    base = _folder(spark, sf_dir, "external")
    extract = _scoring(spark, sf_dir)
    writers.write_ids_csv(extract, VISITS, f"{base}/ids")
    writers.write_predictions_csv(_scored(extract), f"{base}/predictions")
    for _ in range(2):
        load.load_external_scores(
            spark, VISITS, AS_OF, "v1", f"{base}/ids", f"{base}/predictions", f"{base}/scores", SCORED_AT
        )
    return _stored(spark, f"{base}/scores")


def scores_by_date(spark, sf_dir):
    return _day_as_text(reports.scores_on(_history(spark, sf_dir), date(2024, 1, 15)), "SCORE_DATE")


def scores_by_visit(spark, sf_dir):
    return _day_as_text(reports.scores_of(_history(spark, sf_dir), VISITS, "17"), "SCORE_DATE")


def daily_average(spark, sf_dir):
    averages = reports.daily_average(_history(spark, sf_dir))
    return _day_as_text(averages.withColumn("avg_score", F.round("avg_score", 6)), "SCORE_DATE")


def scores_joined_back(spark, sf_dir):
    """Scores of the visits with a target, so the others stay unmatched."""
    labelled = _visits(spark, sf_dir).filter(F.col(VISITS.target).isNotNull()).select(F.col("visit_id").cast("string").alias("VISIT_ID"))
    scores = _history(spark, sf_dir).join(labelled, "VISIT_ID", "left_semi")
    visits = ext.clean_for_scoring(_visits(spark, sf_dir), VISITS, keep=[VISITS.event_time])
    return sc.join_back(visits, scores, VISITS)


def exact_load(spark, sf_dir):
    """Ids delivered twice with NULLs among them, predictions repeated, as text, as NaN, conflicting, then corrected."""
    folder = _folder(spark, sf_dir, "exact")
    scored = _scored(_scoring(spark, sf_dir)).withColumn("visit_count", F.col(VISITS.id) % 10)
    ids = scored.select(F.when(F.col("visit_count") != 3, F.col(VISITS.id)).alias(VISITS.id))
    text = F.col("prediction").cast("string")
    first = F.when(F.col("visit_count") == 1, "no number").when(F.col("visit_count") == 2, "NaN").otherwise(text)
    lower = F.when(F.col("visit_count") == 4, (F.col("prediction") - 1).cast("string")).otherwise(first)
    sc.create_score_table(spark, VISITS, folder)
    deliveries = (
        scored.select(VISITS.id, first.alias("raw")).union(scored.select(VISITS.id, lower.alias("raw"))),
        scored.select(VISITS.id, F.when(F.col("visit_count") < 3, text).otherwise("0").alias("raw")),
    )
    for given in deliveries:
        numbers = given.select(VISITS.id, cleaning.score("raw").alias("prediction"))
        paired = sc.pair_scores(ids.union(ids), numbers, VISITS.id)
        rows = sc.score_rows(paired, VISITS, AS_OF, "v1", scored_at=SCORED_AT)
        sc.append_scores(rows, sc.read_score_table(spark, VISITS, folder), VISITS, folder)
    return _stored(spark, folder)


def pairing_counts(spark, sf_dir):
    """What does not pair: ids twice and NULL, predictions for fewer and for other ids."""
    scored = _scored(_clean(spark, sf_dir))
    one = F.col(VISITS.id) % 10
    ids = scored.filter(one != 4).select(F.when(one != 3, F.col(VISITS.id)).alias(VISITS.id))
    more = scored.filter(one == 6).select(VISITS.id, (F.col("prediction") + 1).alias("prediction"))
    return sc.pairing_counts(ids.union(ids.filter("visit_id % 10 = 1")), scored.filter(one != 5).union(more), VISITS.id)


# --- files --------------------------------------------------------------------------------------


def training_dataset(spark, sf_dir):
    base = _folder(spark, sf_dir, "training")
    train.extract_training_set(_visits(spark, sf_dir), VISITS, AS_OF, base)
    return readers.read_training(spark, base, AS_OF)


def folder_scan_parquet(spark, sf_dir):
    base = _folder(spark, sf_dir, "folder_parquet")
    writers.write_training(_training(spark, sf_dir), base, AS_OF)
    return readers.read_folder(spark, base)


def folder_scan_csv(spark, sf_dir):
    base = _folder(spark, sf_dir, "folder_csv")
    extract = _scoring(spark, sf_dir)
    writers.write_ids_csv(extract, VISITS, f"{base}/ids")
    return readers.read_folder(spark, base, "visit_id bigint")


def scoring_dataset(spark, sf_dir):
    base = _folder(spark, sf_dir, "scoring")
    score.extract_scoring_set(_visits(spark, sf_dir), VISITS, AS_OF, base)
    return readers.read_scoring(spark, base, days.yesterday(AS_OF))


def ids_csv(spark, sf_dir):
    path = _folder(spark, sf_dir, "ids_csv")
    writers.write_ids_csv(_clean(spark, sf_dir), VISITS, path)
    return readers.read_ids_csv(spark, path, VISITS.id, "bigint")


def feature_csv(spark, sf_dir):
    path = _folder(spark, sf_dir, "feature_csv")
    writers.write_feature_csv(_clean(spark, sf_dir), VISITS, path)
    return readers.read_feature_csv(spark, path, VISITS)


def feature_json(spark, sf_dir):
    path = _folder(spark, sf_dir, "feature_json")
    cleaned = _clean(spark, sf_dir)
    writers.write_feature_json(cleaned, VISITS, path)
    return readers.read_feature_json(spark, path, VISITS, cleaned.schema[VISITS.id].dataType, lines=True)


def ids_by_name(spark, sf_dir):
    """The id is the second column."""
    path = _folder(spark, sf_dir, "ids_by_name")
    rows = _clean(spark, sf_dir).select("visit_count", VISITS.id)
    rows.write.mode("overwrite").options(**CSV_OPTIONS).option("header", True).csv(path)
    return readers.read_ids_csv(spark, path, VISITS.id, "bigint")


def folder_of_different_files(spark, sf_dir):
    """Parquet parts with different columns, and CSV parts whose headers have another order."""
    base = _folder(spark, sf_dir, "different")
    rows = _clean(spark, sf_dir).select(VISITS.id, "is_mobile", "publisher_name")
    rows.select(VISITS.id).filter("visit_id % 2 = 0").write.mode("overwrite").parquet(f"{base}/parquet/a")
    rows.filter("visit_id % 2 = 1").write.mode("overwrite").parquet(f"{base}/parquet/b")
    csv = {"header": "true", **CSV_OPTIONS}
    rows.select("publisher_name", VISITS.id).filter("visit_id % 2 = 0").write.mode("overwrite").options(**csv).csv(f"{base}/csv/a")
    rows.filter("visit_id % 2 = 1").write.mode("overwrite").options(**csv).csv(f"{base}/csv/b")
    typed = "visit_id bigint, is_mobile int, publisher_name string"
    parts = {"parquet": readers.read_folder(spark, f"{base}/parquet"), "csv": readers.read_folder(spark, f"{base}/csv", typed)}
    both = [df.select(F.lit(kind).alias("format"), VISITS.id, "is_mobile", "publisher_name") for kind, df in parts.items()]
    return both[0].unionByName(both[1])


def damaged_features(spark, sf_dir):
    """A feature CSV with text in a number, with a surplus field, and with a field too few."""
    path = _folder(spark, sf_dir, "damaged")
    rows = _clean(spark, sf_dir)
    fields = [F.lit("abc") if c == "visit_count" else F.col(c).cast("string") for c in VISITS.raw_features]
    whole = [F.col(c).cast("string") for c in VISITS.raw_features]
    quoted = lambda cells: F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells])
    kind = F.col(VISITS.id) % 10
    line = F.when(kind == 0, quoted(fields)).when(kind == 1, F.concat(quoted(whole), F.lit(",9"))).when(kind == 2, quoted(whole[:-1])).otherwise(quoted(whole))
    rows.select(line.alias("value")).write.mode("overwrite").text(path)
    return readers.damage(readers.read_feature_csv(spark, path, VISITS, keep_damaged=True))


def raw_categories(spark, sf_dir):
    """A boolean and a text column encoded in all three ways."""
    visits = _visits(spark, sf_dir).select(VISITS.id, "is_mobile", "publisher_name")
    columns = ["is_mobile", "publisher_name"]
    codes = enc.fit_codes(visits, columns)
    ways = {"inline": {}, "broadcast": {"inline_bytes": 0}, "shuffled": {"broadcast_bytes": 0, "inline_bytes": 0}}
    parts = [enc.encode(visits, codes, columns, **limits).withColumn("way", F.lit(way)) for way, limits in ways.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def predictions_csv(spark, sf_dir):
    path = _folder(spark, sf_dir, "predictions_csv")
    writers.write_predictions_csv(_scored(_clean(spark, sf_dir)), path)
    read = readers.read_predictions_csv(spark, path, "prediction", VISITS.id, "bigint")
    return read.select(VISITS.id, cleaning.score("prediction").alias("prediction"))


def predictions_one_per_line(spark, sf_dir):
    path = _folder(spark, sf_dir, "predictions_lines")
    writers.write_predictions_csv(_scored(_clean(spark, sf_dir)), path, with_id=False)
    read = readers.read_predictions_csv(spark, path, "prediction")
    return read.select(cleaning.score("prediction").alias("prediction"))


def predictions_json(spark, sf_dir):
    path = _folder(spark, sf_dir, "predictions_json")
    scored = _scored(_clean(spark, sf_dir))
    writers.write_predictions_json(scored, path)
    return spark.read.schema(scored.schema).json(path)


# --- retention ----------------------------------------------------------------------------------


def expired_partitions(spark, sf_dir):
    """Written training and scoring folders, and models by the day they were trained."""
    base = _folder(spark, sf_dir, "retained")
    seen = ext.clean_for_scoring(_visits(spark, sf_dir), VISITS, keep=[VISITS.event_time])
    days_of = seen.select(VISITS.id, F.to_date(VISITS.event_time).alias("day"))
    for dataset, partition in (("training", "run_date"), ("inference", "score_date")):
        by_day = days_of.withColumnRenamed("day", partition)
        by_day.write.mode("overwrite").partitionBy(partition).parquet(f"{base}/{dataset}")
    trained = days_of.groupBy("day").agg(F.count("*").alias("n")).select(
        F.col("day").cast("timestamp_ntz").alias("trained_at"),
        F.lit("TRAIN").alias("dataset"),
        *[F.lit(0.0).alias(c) for c in ("rmse", "mae", "r2")],
        F.concat(F.lit("m-"), F.col("day").cast("string")).alias("model_version"),
    )
    boost.register_version(trained, f"{base}/versions")
    listed = [
        retention.partition_days(spark, "training", f"{base}/training", "run_date"),
        retention.partition_days(spark, "inference", f"{base}/inference", "score_date"),
        retention.model_days(boost.read_versions(spark, f"{base}/versions")).drop("model_version"),
    ]
    every = listed[0].unionByName(listed[1]).unionByName(listed[2])
    return _day_as_text(retention.due_partitions(every, date(2024, 4, 10)), "day")


def expired_folders(spark, sf_dir):
    """Visits written by day; the days past their time are found from the file names."""
    path = _folder(spark, sf_dir, "by_day")
    visits = ext.clean_for_scoring(_visits(spark, sf_dir), VISITS, keep=[VISITS.event_time])
    by_day = visits.withColumn("score_date", F.to_date(VISITS.event_time))
    by_day.write.mode("overwrite").partitionBy("score_date").parquet(path)
    listed = retention.partition_days(spark, "inference", path, "score_date")
    return _day_as_text(retention.due_partitions(listed, date(2024, 2, 20)), "day")


def entry(spark: SparkSession) -> DataFrame:
    """Yesterday's visits, cleaned."""
    return _scoring(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    training_text = {} if llm is None else {**llm.queries(), "pipeline": corpus_pipeline.run}
    return {
        "q01_boolean_to_int": boolean_to_int,
        "q02_categorical_missing": categorical_missing,
        "q03_numeric_zero": numeric_zero,
        "q04_preprocess": preprocess,
        "q05_training_extract": _training,
        "q06_split_counts": split_counts,
        "q07_train_rows": train_rows,
        "q08_test_rows": test_rows,
        "q09_scoring_extract": _scoring,
        "q10_scoring_ids": scoring_ids,
        "q11_scoring_features": scoring_features,
        "q12_ordinal_fit": ordinal_fit,
        "q13_ordinal_transform": ordinal_transform,
        "q14_feature_matrix": matrix,
        "q15_score_join": score_join,
        "q16_score_rows": score_rows,
        "q17_idempotent_append": idempotent_append,
        "q18_scores_by_date": scores_by_date,
        "q19_scores_by_visit": scores_by_visit,
        "q20_daily_average": daily_average,
        "q21_scores_joined_back": scores_joined_back,
        "q22_regression_metrics": regression_metrics,
        "q23_gbt_scores": gbt_scores,
        "q24_empty_day_guard": empty_day_guard,
        "q25_expired_partitions": expired_partitions,
        "q26_available_columns": available_columns,
        "q27_full_training_projection": full_training_projection,
        "q28_full_scoring_projection": full_scoring_projection,
        "q29_ordinal_transform_shuffled": ordinal_transform_shuffled,
        "q30_saved_codes": saved_codes,
        "q31_training_dataset": training_dataset,
        "q32_scoring_dataset": scoring_dataset,
        "q33_folder_scan_parquet": folder_scan_parquet,
        "q34_folder_scan_csv": folder_scan_csv,
        "q35_ids_csv": ids_csv,
        "q36_feature_csv": feature_csv,
        "q37_feature_json": feature_json,
        "q38_predictions_csv": predictions_csv,
        "q39_predictions_one_per_line": predictions_one_per_line,
        "q40_predictions_json": predictions_json,
        "q41_replaced_scores": replaced_scores,
        "q42_rejected_scores": rejected_scores,
        "q43_external_scores": external_scores,
        "q44_model_versions": model_versions,
        "q45_expired_folders": expired_folders,
        "q46_daily_run": daily_run,
        "q47_ordinal_transform_broadcast": ordinal_transform_broadcast,
        "q48_raw_categories": raw_categories,
        "q49_folder_of_different_files": folder_of_different_files,
        "q50_ids_by_name": ids_by_name,
        "q51_damaged_features": damaged_features,
        "q52_exact_load": exact_load,
        "q53_flag_scores": flag_scores,
        "q54_flag_metrics": flag_metrics,
        "q55_early_stopping": early_stopping,
        "q56_scored_files": scored_files,
        "q57_json_files": json_files,
        "q58_empty_day_run": empty_day_run,
        "q59_pairing_counts": pairing_counts,
        "q60_stored_order": stored_order,
        "q61_penalised_rounds": penalised_rounds,
        "q62_empty_day_with_others": empty_day_with_others,
        "q63_odd_names": odd_names,
        "q64_stored_scores_by_visit": stored_scores_by_visit,
        "q65_stored_daily_report": stored_daily_report,
        **training_text,
    }


# --- the same results in SQL --------------------------------------------------------------------


def _sql_clean(spec: FeatureSpec) -> str:
    return ", ".join(
        [f"CASE WHEN {c} THEN 1 ELSE 0 END AS {c}" for c in spec.boolean]
        + [f"COALESCE(CAST({c} AS VARCHAR), 'MISSING') AS {c}" for c in spec.categorical]
        + [f"COALESCE(CAST({c} AS DOUBLE), 0e0) AS {c}" for c in spec.numeric]
    )


def oracle_sql() -> dict[str, str]:
    training_text = {} if llm is None else llm.oracle_sql()
    visits = VISITS_SQL.format(events="events")
    clean = _sql_clean(VISITS)
    share = "CAST('0x' || substr(md5('42:' || CAST(visit_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0"
    side = f"CASE WHEN {share} < 0.2e0 THEN 'TEST' ELSE 'TRAIN' END AS data_split"
    recent = "fraud_score IS NOT NULL AND created_at >= DATE '2024-01-31' - INTERVAL 15 DAY"
    features = ", ".join(VISITS.raw_features)
    simple = "20e0 * is_mobile + visit_count / 2e0 + gross_revenue / 1e1"
    unpivoted = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value FROM {{source}}" for c in VISITS.categorical
    )

    head = f"""
WITH visits AS ({visits}),
clean AS (SELECT visit_id, created_at, {clean} FROM visits),
training AS (SELECT {clean}, fraud_score, {side} FROM visits WHERE {recent}),
scoring AS (SELECT visit_id, {features} FROM clean WHERE CAST(created_at AS DATE) = DATE '2024-01-31' - INTERVAL 1 DAY),
first_day AS (SELECT * FROM clean WHERE CAST(created_at AS DATE) = DATE '2024-01-01'),
train_side AS (SELECT * FROM training WHERE data_split = 'TRAIN'),
scored AS (SELECT visit_id, {simple} AS prediction FROM scoring),
history AS ({_history_sql("visits")})
"""

    def codes(source: str) -> str:
        return (
            "SELECT feature, value, CAST(ROW_NUMBER() OVER (PARTITION BY feature ORDER BY value) - 1 AS INT) AS code "
            f"FROM (SELECT DISTINCT feature, value FROM ({unpivoted.format(source=source)}))"
        )

    def encoded(source: str, codes_of: str, keep: str, others: str) -> str:
        columns = ", ".join(f"COALESCE(c{i}.code, -1) AS {c}_ENCODED" for i, c in enumerate(VISITS.categorical))
        joins = " ".join(
            f"LEFT JOIN codes c{i} ON c{i}.feature = '{c}' AND c{i}.value = s.{c}"
            for i, c in enumerate(VISITS.categorical)
        )
        return f"{head}, codes AS ({codes(codes_of)}) SELECT {keep}, {columns}{others} FROM {source} s {joins}"

    def stored(version: str) -> str:
        return (
            "SELECT CAST(visit_id AS VARCHAR) AS VISIT_ID, CAST(prediction AS FLOAT) AS PREDICTED_FRAUD_SCORE, "
            f"'{version}' AS MODEL_VERSION, '2024-01-30' AS SCORE_DATE, "
            "TIMESTAMP '2024-01-31 03:00:00' AS SCORED_AT, TIMESTAMP '2024-01-31 03:00:00' AS CREATED_AT FROM scored"
        )

    known = f"CASE WHEN visit_count % 5 <> 0 THEN {simple} END"
    errors = """sqrt(avg(power(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae,
1 - sum(power(y - p, 2)) / (var_pop(CASE WHEN p IS NOT NULL THEN y END) * count(p)) AS r2"""

    def measured(name: str) -> str:
        return f"""SELECT data_split AS {name}, {errors}, count(p) AS n, count(*) - count(p) AS skipped
FROM (SELECT data_split, fraud_score AS y, {known} AS p FROM training) GROUP BY data_split"""

    # One tree on three flags splits the training rows into groups by flags.
    flags = ", ".join(VISITS.boolean)
    by_flags = f"SELECT {flags}, avg(fraud_score) AS p FROM train_side GROUP BY {flags}"
    flagged = f"""{head}, by_flags AS ({by_flags}) SELECT visit_id, p AS prediction
FROM clean JOIN by_flags USING ({flags}) WHERE CAST(created_at AS DATE) = DATE '2024-01-30'"""

    def due(dataset: str, action: str, as_of: str, days_kept: int) -> str:
        return (
            f"SELECT '{dataset}' AS dataset, CAST(day AS VARCHAR) AS day, '{action}' AS action FROM "
            "(SELECT DISTINCT CAST(created_at AS DATE) AS day FROM visits) "
            f"WHERE day < DATE '{as_of}' - INTERVAL {days_kept} DAY"
        )

    history = (
        "VISIT_ID, PREDICTED_FRAUD_SCORE, MODEL_VERSION, CAST(SCORE_DATE AS VARCHAR) AS SCORE_DATE, "
        "SCORED_AT, CREATED_AT"
    )
    wide = _wide_sql().format(events="events")
    wide_clean = _sql_clean(VISIT_SPEC)
    fewer = _sql_clean(
        replace(
            VISITS,
            boolean=("is_hosting", "is_mobile"),
            categorical=("visitor_type", "publisher_name"),
            numeric=("gross_revenue",),
        )
    )
    transformed = encoded("clean", "first_day", "s.visit_id", "")
    encoded_training = encoded(
        "training",
        "train_side",
        f"s.fraud_score, s.data_split, {', '.join('s.' + c for c in VISITS.boolean)}",
        "".join(f", s.{c}" for c in VISITS.numeric),
    )
    all_clean = f"{head} SELECT visit_id, {features} FROM clean"
    training_rows = f"{head} SELECT {features}, fraud_score, data_split FROM training"

    return {
        "q01_boolean_to_int": f"{head} SELECT visit_id, {', '.join(VISITS.boolean)} FROM clean",
        "q02_categorical_missing": f"{head} SELECT visit_id, {', '.join(VISITS.categorical)} FROM clean",
        "q03_numeric_zero": f"{head} SELECT visit_id, {', '.join(VISITS.numeric)} FROM clean",
        "q04_preprocess": f"{head} SELECT {clean}, fraud_score FROM visits",
        "q05_training_extract": training_rows,
        "q06_split_counts": f"""{head} SELECT count(*) AS total, count(*) FILTER (data_split = 'TRAIN') AS train,
count(*) FILTER (data_split = 'TEST') AS test FROM training""",
        "q07_train_rows": f"{head} SELECT {features}, fraud_score FROM training WHERE data_split = 'TRAIN'",
        "q08_test_rows": f"{head} SELECT {features}, fraud_score FROM training WHERE data_split = 'TEST'",
        "q09_scoring_extract": f"{head} SELECT * FROM scoring",
        "q10_scoring_ids": f"{head} SELECT visit_id FROM scoring",
        "q11_scoring_features": f"{head} SELECT {features} FROM scoring",
        "q12_ordinal_fit": f"{head} {codes('clean')}",
        "q13_ordinal_transform": transformed,
        "q14_feature_matrix": encoded_training,
        "q15_score_join": f"""{head} SELECT c.visit_id, {simple} AS prediction FROM clean c
JOIN visits v ON c.visit_id = v.visit_id WHERE v.fraud_score IS NOT NULL""".replace(
            simple, "20e0 * c.is_mobile + c.visit_count / 2e0 + c.gross_revenue / 1e1"
        ),
        "q16_score_rows": f"{head} {stored('v1')}",
        "q17_idempotent_append": f"{head} {stored('v1')}",
        "q18_scores_by_date": f"{head} SELECT {history} FROM history WHERE SCORE_DATE = DATE '2024-01-15'",
        "q19_scores_by_visit": f"{head} SELECT {history} FROM history WHERE VISIT_ID = '17' ORDER BY SCORED_AT DESC",
        "q20_daily_average": f"""{head} SELECT DISTINCT CAST(SCORE_DATE AS VARCHAR) AS SCORE_DATE,
round(avg(PREDICTED_FRAUD_SCORE) OVER day, 6) AS avg_score, count(*) OVER day AS num_scored
FROM history WINDOW day AS (PARTITION BY SCORE_DATE)""",
        "q21_scores_joined_back": f"""{head}, ranked AS (SELECT h.*, ROW_NUMBER() OVER (
  PARTITION BY h.VISIT_ID, h.SCORE_DATE, h.MODEL_VERSION ORDER BY h.SCORED_AT DESC) AS nth
FROM history h SEMI JOIN (SELECT CAST(visit_id AS VARCHAR) AS known FROM visits WHERE fraud_score IS NOT NULL) v ON h.VISIT_ID = v.known)
SELECT c.*, r.PREDICTED_FRAUD_SCORE, r.MODEL_VERSION FROM clean c
LEFT JOIN ranked r ON r.nth = 1 AND r.VISIT_ID = CAST(c.visit_id AS VARCHAR) AND r.SCORE_DATE = CAST(c.created_at AS DATE)""",
        "q22_regression_metrics": f"""{head} SELECT data_split, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
round(r2, 6) AS r2, n, skipped FROM ({measured("data_split")})""",
        "q24_empty_day_guard": f"""{head} SELECT count(*) AS records FROM visits
WHERE CAST(created_at AS DATE) = DATE '2024-02-29'""",
        "q25_expired_partitions": f"""{head} {due("training", "expire", "2024-04-10", 90)}
UNION ALL {due("inference", "expire", "2024-04-10", 30)} UNION ALL {due("models", "archive", "2024-04-10", 90)}""",
        "q26_available_columns": f"{head} SELECT visit_id, {fewer} FROM visits",
        "q27_full_training_projection": f"SELECT {wide_clean}, {VISIT_SPEC.target} FROM ({wide})",
        "q28_full_scoring_projection": f"""SELECT VISIT_ID, {wide_clean} FROM ({wide})
WHERE CAST(CREATED_AT AS DATE) = DATE '2024-01-30'""",
        "q29_ordinal_transform_shuffled": transformed,
        "q30_saved_codes": f"{head} {codes('train_side')}",
        "q31_training_dataset": training_rows,
        "q32_scoring_dataset": f"{head} SELECT * FROM scoring",
        "q33_folder_scan_parquet": f"{head} SELECT {features}, fraud_score FROM training",
        "q34_folder_scan_csv": f"{head} SELECT visit_id FROM scoring",
        "q35_ids_csv": f"{head} SELECT visit_id FROM clean",
        "q36_feature_csv": f"{head} SELECT {features} FROM clean",
        "q37_feature_json": all_clean,
        "q38_predictions_csv": f"{head} SELECT visit_id, CAST({simple} AS FLOAT) AS prediction FROM clean",
        "q39_predictions_one_per_line": f"{head} SELECT CAST({simple} AS FLOAT) AS prediction FROM clean",
        "q40_predictions_json": f"{head} SELECT visit_id, {simple} AS prediction FROM clean",
        "q41_replaced_scores": f"{head} {stored('v1')} UNION ALL {stored('v2')}",
        "q42_rejected_scores": f"""{head}, raw AS (SELECT CASE WHEN visit_count % 10 = 0 THEN utm_content
ELSE CAST(visit_count AS VARCHAR) END AS raw FROM visits)
SELECT count(*) AS read, count(*) FILTER (raw IS NOT NULL AND TRY_CAST(raw AS FLOAT) IS NULL) AS rejected FROM raw""",
        "q43_external_scores": f"{head} {stored('v1')}",
        "q44_model_versions": f"""{head} SELECT v.model_version, v.trained_at, m.dataset, round(m.rmse, 6) AS rmse,
round(m.mae, 6) AS mae, round(m.r2, 6) AS r2, 'model-b' AS latest FROM ({measured("dataset")}) m
CROSS JOIN (VALUES ('model-a', TIMESTAMP '2024-01-16 02:00:00'), ('model-b', TIMESTAMP '2024-01-31 02:00:00'))
AS v(model_version, trained_at)""",
        "q47_ordinal_transform_broadcast": transformed,
        "q45_expired_folders": f"{head} {due('inference', 'expire', '2024-02-20', 30)}",
        "q23_gbt_scores": f"{head} SELECT visit_id, TRUE AS in_range, TRUE AS explains FROM scoring",
        "q46_daily_run": f"""{head} SELECT '2024-01-30' AS SCORE_DATE, 'model-20240131' AS MODEL_VERSION, count(*) AS scored,
count(DISTINCT visit_id) AS ids, count(*) AS in_range FROM scoring""",
        "q48_raw_categories": f"""{head}, m AS (SELECT value, ROW_NUMBER() OVER (ORDER BY value) - 1 AS code
FROM (SELECT DISTINCT CAST(is_mobile AS VARCHAR) AS value FROM visits WHERE is_mobile IS NOT NULL)),
p AS (SELECT value, ROW_NUMBER() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT publisher_name AS value FROM visits))
SELECT visit_id, CAST(COALESCE(m.code, -1) AS INT) AS is_mobile_ENCODED, CAST(COALESCE(p.code, -1) AS INT) AS publisher_name_ENCODED, way
FROM visits v LEFT JOIN m ON CAST(v.is_mobile AS VARCHAR) = m.value LEFT JOIN p ON v.publisher_name = p.value
CROSS JOIN (VALUES ('inline'), ('broadcast'), ('shuffled')) AS w(way)""",
        "q49_folder_of_different_files": f"""{head} SELECT format, visit_id,
CASE WHEN visit_id % 2 = 1 THEN is_mobile END AS is_mobile,
CASE WHEN visit_id % 2 = 1 OR format = 'csv' THEN publisher_name END AS publisher_name
FROM clean CROSS JOIN (VALUES ('parquet'), ('csv')) AS f(format)""",
        "q50_ids_by_name": f"{head} SELECT visit_id FROM clean",
        "q51_damaged_features": f"""{head} SELECT count(*) AS read, count(*) FILTER (visit_id % 10 < 3) AS rejected FROM clean""",
        "q52_exact_load": f"{head} {stored('v1')} WHERE visit_id % 10 <> 3",
        "q53_flag_scores": f"SELECT visit_id, round(prediction, 6) AS prediction FROM ({flagged})",
        "q54_flag_metrics": f"""{head}, by_flags AS ({by_flags}) SELECT dataset, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2
FROM (SELECT CASE data_split WHEN 'TRAIN' THEN 'TRAIN' ELSE 'VALIDATION' END AS dataset, {errors}
  FROM (SELECT data_split, fraud_score AS y, p FROM training JOIN by_flags USING ({flags})) GROUP BY data_split)""",
        "q55_early_stopping": f"""{head} SELECT count(*) AS records, 1 AS kept, 4 AS tried, 0e0 AS best_error
FROM visits WHERE created_at >= DATE '2024-01-31' - INTERVAL 15 DAY""",
        "q56_scored_files": f"""SELECT CAST(visit_id AS VARCHAR) AS VISIT_ID, round(CAST(CAST(prediction AS FLOAT) AS DOUBLE), 3) AS PREDICTED_FRAUD_SCORE,
'm' AS MODEL_VERSION, '2024-01-30' AS SCORE_DATE FROM ({flagged})""",
        "q57_json_files": all_clean,
        "q58_empty_day_run": f"""{head} SELECT count(*) AS visits,
CAST(count(*) FILTER (CAST(created_at AS DATE) = DATE '2024-01-30') AS INT) AS first, 0 AS second, 0 AS left FROM visits""",
        "q59_pairing_counts": f"""{head} SELECT count(*) FILTER (one NOT IN (3, 4)) AS ids, count(*) FILTER (one = 1) AS repeated,
count(*) FILTER (one = 3) AS null_ids, count(*) FILTER (one = 5) AS without_prediction,
count(*) FILTER (one IN (3, 4)) AS without_id, count(*) FILTER (one = 6) AS conflicting
FROM (SELECT visit_id % 10 AS one FROM clean)""",
        "q60_stored_order": f"""SELECT round(CAST(sum(CAST({' + '.join(f'{i + 1} * {c}' for i, c in enumerate(list(VISITS.model_features)[::-1]))} AS DECIMAL(30, 6))) AS DOUBLE), 2) AS total,
count(*) AS records FROM ({encoded_training})""",
        "q61_penalised_rounds": f"""{head}, cells AS (SELECT {flags}, sum(fraud_score) AS s, count(*) AS n FROM train_side GROUP BY {flags}),
one AS (SELECT *, s / (n + 1) AS f1 FROM cells), two AS (SELECT *, f1 + 0.5 * (s - n * f1) / (n + 1) AS f2 FROM one),
three AS (SELECT *, f2 + 0.5 * (s - n * f2) / (n + 1) AS f3 FROM two)
SELECT visit_id, round(f3, 6) AS prediction FROM clean JOIN three USING ({flags}) WHERE CAST(created_at AS DATE) = DATE '2024-01-30'""",
        "q62_empty_day_with_others": f"{head} {stored('v1')}",
        "q63_odd_names": f"{head} {stored('v1')}",
        "q64_stored_scores_by_visit": f"{head} SELECT {history} FROM history WHERE VISIT_ID = '17' ORDER BY SCORED_AT DESC",
        "q65_stored_daily_report": f"""{head} SELECT CAST(SCORE_DATE AS VARCHAR) AS SCORE_DATE, round(avg(CAST(PREDICTED_FRAUD_SCORE AS DOUBLE)), 6) AS avg_score,
count(*) AS num_scored, count(DISTINCT (VISIT_ID, MODEL_VERSION)) AS joined FROM history GROUP BY SCORE_DATE""",
        **training_text,
    }
