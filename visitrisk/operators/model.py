"""Boosted regression trees: train, stop early, score, save, pick a version."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitrisk.functions.split import SPLIT, TEST, TRAIN
from visitrisk.operators.encode import read_codes
from visitrisk.operators.matrix import FEATURES, assembler, feature_matrix
from visitrisk.operators.metrics import regression_metrics
from visitrisk.operators.trees import Draw, Tree, blocks, boosted, cut_points, fit_tree, mean_squares
from visitrisk.scratch import shared_folder
from visitrisk.spec import FeatureSpec

LABEL = "label"
PREDICTION = "prediction"
VALIDATION = "VALIDATION"


@dataclass(frozen=True)
class BoostParams:
    """Boosting settings."""

    # The defaults of a training run.
    rounds: int = 1400
    max_depth: int = 6
    step: float = 0.0769
    row_share: float = 0.958
    column_share: float = 0.707
    seed: int = 42
    patience: int = 50
    # Of a column with more values than about this, so many quantiles are told apart.
    bins: int = 256
    # A leaf's value is the sum of its rows' residuals over their number plus this.
    leaf_penalty: float = 1.0
    # Keep the rounds up to the best validation error; else all that were fitted.
    keep_best: bool = True

    # About how many training rows take part, chosen by hash of their features; None: all.
    max_rows: int | None = None
    # Every round visits all partitions several times: on a large dataset, two or three per core are
    # enough. None keeps those of the scan.
    partitions: int | None = None
    # The sums of one pass in a task; a level that needs more takes several passes.
    histogram_mb: int = 1024
    checkpoint_every: int = 10


@dataclass(frozen=True)
class Trained:
    """The model, the mean squared error of each round fitted, on either side, and the metrics of the rounds kept."""

    pipeline: PipelineModel
    training_errors: list[float]
    validation_errors: list[float]
    metrics: DataFrame

    @property
    def feature_names(self) -> list[str]:
        return feature_names(self.pipeline)


def rounds_to_keep(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the best validation error, and whether ``patience`` idle rounds followed it.

    Looks at the errors in order and stops at the first point where ``patience`` rounds brought no
    better one, so a later, better error cannot count.
    """
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def drawn_columns(n: int, params: BoostParams, round_: int) -> list[int]:
    """The columns that the tree of a round may split on."""
    return sorted(random.Random(f"{params.seed} {round_}").sample(range(n), max(1, int(n * params.column_share))))


def _boost(rows: DataFrame, names: Sequence[str], params: BoostParams) -> tuple[GBTRegressionModel, list[float], list[float]]:
    """Boost until the validation error has been idle for ``patience`` rounds, keep the best prefix.

    ``rows`` holds the features ``names``, LABEL and SPLIT. Their columns are cut into bins once. Each round fits one
    tree to what the rounds before leave of the label, in one pass a level and one more to take its values off. The rows
    are kept from round to round, so no round is fitted twice: with n rounds kept, n + patience are fitted. They are
    checkpointed every ``checkpoint_every`` rounds, so a lost executor costs those since. The first tree counts in full,
    later ones by ``step``.
    """
    points = cut_points(rows.filter(F.col(SPLIT) == TRAIN), names, params.bins)
    used = rows.filter(F.col(SPLIT).isin(TRAIN, TEST) & F.col(LABEL).isNotNull())
    state = blocks(used, names, LABEL, F.col(SPLIT) == TRAIN, points).persist(StorageLevel.MEMORY_AND_DISK)
    shared_folder(rows.sparkSession)
    trees, errors = [], {TRAIN: [], TEST: []}
    try:
        for round_ in range(params.rounds):
            columns = drawn_columns(len(names), params, round_)
            n_bins = 1 + max(len(points[c]) for c in columns)
            draw = Draw(params.row_share, (params.seed % 2**32, round_))
            tree = fit_tree(state, columns, n_bins, params.max_depth, draw, params.histogram_mb << 20)
            weight = params.step if round_ else 1.0
            trees.append((tree, weight))
            after = boosted(state, tree, weight * tree.values(params.leaf_penalty)).persist(StorageLevel.MEMORY_AND_DISK)
            if round_ % params.checkpoint_every == params.checkpoint_every - 1:
                after.checkpoint()
            for side, error in zip((TRAIN, TEST), mean_squares(after)):
                errors[side].append(error)
            state.unpersist()
            state = after
            if rounds_to_keep(errors[TEST], params.patience)[1]:
                break
    finally:
        state.unpersist()
    keep = rounds_to_keep(errors[TEST], params.patience)[0] if params.keep_best else len(trees)
    return _ensemble(trees[:keep], points, params.leaf_penalty), errors[TRAIN], errors[TEST]


def _ensemble(fitted: Sequence[tuple[Tree, float]], points: Sequence[np.ndarray], penalty: float) -> GBTRegressionModel:
    """MLlib's model of the trees (tree, weight)."""
    gateway = SparkContext._active_spark_context._gateway
    ml, impurity = gateway.jvm.org.apache.spark.ml, gateway.jvm.org.apache.spark.mllib.tree.impurity

    def node(tree: Tree, values: np.ndarray, i: int):
        stats = gateway.new_array(gateway.jvm.double, 3)
        stats[0], stats[1], stats[2] = map(float, tree.stats[i])
        found = impurity.VarianceCalculator(stats, int(tree.stats[i][0]))
        if tree.column[i] < 0:
            return ml.tree.LeafNode(float(values[i]), found.calculate(), found)
        split = ml.tree.ContinuousSplit(tree.column[i], float(points[tree.column[i]][tree.cut[i]]))
        children = [node(tree, values, tree.child[i] + side) for side in (0, 1)]
        return ml.tree.InternalNode(found.predict(), found.calculate(), tree.gain[i], *children, split, found)

    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(fitted))
    weights = gateway.new_array(gateway.jvm.double, len(fitted))
    for i, (tree, weight) in enumerate(fitted):
        uid = ml.regression.DecisionTreeRegressor().uid()
        root = node(tree, tree.values(penalty), 0)
        trees[i], weights[i] = ml.regression.DecisionTreeRegressionModel(uid, root, len(points)), weight
    uid = ml.regression.GBTRegressor().uid()
    model = GBTRegressionModel(ml.regression.GBTRegressionModel(uid, trees, weights, len(points)))
    return model.setFeaturesCol(FEATURES).setPredictionCol(PREDICTION)


def _check_labels(rows: DataFrame) -> None:
    missing = F.col(LABEL).isNull() | F.isnan(LABEL)
    found = rows.filter(F.col(SPLIT) == TRAIN).agg(F.count("*").alias("n"), F.count_if(missing).alias("missing")).first()
    if not found["n"]:
        raise ValueError("there are no training rows")
    if found["missing"]:
        raise ValueError(f"{found['missing']} of {found['n']} training rows have no label")


def train(matrix: DataFrame, names: Sequence[str], params: BoostParams = BoostParams()) -> Trained:
    """Fit on the TRAIN rows of ``matrix``, stop early on the TEST rows, measure both.

    ``matrix`` has the features ``names``, ``label`` and ``data_split``. Read it from a written
    dataset: same files, settings and seed give the same model.
    """
    assemble = assembler(names)
    kept = [*names, F.col(LABEL).cast("double").alias(LABEL), SPLIT]
    rows = matrix.select(*kept)
    if params.max_rows is not None:
        share = params.max_rows / max(1, rows.filter(F.col(SPLIT) == TRAIN).count())
        draw = F.pmod(F.xxhash64(*matrix.columns), F.lit(1_000_000))
        rows = matrix.filter((F.col(SPLIT) != TRAIN) | (draw < share * 1_000_000)).select(*kept)
    if params.partitions is not None:
        rows = rows.coalesce(params.partitions)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _check_labels(rows)
        model, training_errors, validation_errors = _boost(rows, names, params)
        dataset = F.when(F.col(SPLIT) == TRAIN, TRAIN).otherwise(VALIDATION).alias("dataset")
        predicted = model.transform(assemble.transform(rows)).select(dataset, LABEL, PREDICTION)
        # Two rows, computed before the training rows are released.
        measured = regression_metrics(predicted, LABEL, PREDICTION, by="dataset").drop("n", "skipped")
        metrics = matrix.sparkSession.createDataFrame(measured.collect(), measured.schema)
    finally:
        rows.unpersist()
    return Trained(PipelineModel([assemble, model]), training_errors, validation_errors, metrics)


def feature_names(pipeline: PipelineModel) -> list[str]:
    """The feature order the model was trained with."""
    return list(pipeline.stages[0].getInputCols())


def score(
    cleaned: DataFrame, spec: FeatureSpec, pipeline: PipelineModel, codes: DataFrame
) -> DataFrame:
    """``(id, prediction)`` for every row of ``cleaned``; the id stays on its row all the way."""
    names = feature_names(pipeline)
    matrix = feature_matrix(cleaned, spec, codes, names=names, keep=[spec.id])
    return pipeline.transform(matrix).select(spec.id, PREDICTION)


def codes_path(models: str, version: str) -> str:
    return f"{models}/{version}/codes"


def save_model(pipeline: PipelineModel, models: str, version: str) -> None:
    """The model with its feature order, next to its codes."""
    pipeline.write().overwrite().save(f"{models}/{version}/model")


def load_model(spark: SparkSession, models: str, version: str) -> tuple[PipelineModel, DataFrame]:
    """The model and its codes."""
    return (
        PipelineModel.load(f"{models}/{version}/model"),
        read_codes(spark, codes_path(models, version)),
    )


VERSION_SCHEMA = (
    "trained_at timestamp_ntz, dataset string, rmse double, mae double, r2 double, model_version string"
)


def version_rows(metrics: DataFrame, version: str, trained_at: datetime) -> DataFrame:
    """One row per dataset that registers a version together with its metrics."""
    return metrics.select(
        F.lit(trained_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("trained_at"),
        "dataset",
        "rmse",
        "mae",
        "r2",
        F.lit(version).alias("model_version"),
    )


def register_version(rows: DataFrame, path: str) -> None:
    """Add a version; registering it again replaces its rows."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_version")
        .parquet(path)
    )


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VERSION_SCHEMA).parquet(path)


def latest_version(versions: DataFrame) -> DataFrame:
    """One row: the version trained last, the greater name when two share the time."""
    newest = F.max(F.struct("trained_at", "model_version")).alias("newest")
    return versions.agg(newest).select("newest.model_version", "newest.trained_at")
