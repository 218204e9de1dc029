"""The three jobs end to end, and the shape of the plans they run."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as contract
from visitrisk.operators import extract as ext
from visitrisk.operators import reports
from visitrisk.operators import scores as sc
from visitrisk.operators.encode import fit_codes
from visitrisk.operators.matrix import feature_matrix
from visitrisk.operators.model import BoostParams
from visitrisk.plans import load, score, train
from visitrisk.sources import readers
from visitrisk.spec import VISIT_SPEC

AS_OF, SPEC = contract.AS_OF, contract.VISITS
PARAMS = BoostParams(rounds=2, max_depth=2)


@pytest.fixture(scope="module")
def visits(spark):
    return contract._learnable(spark, SF)


def test_daily_jobs(spark, visits, tmp_path):
    base = str(tmp_path)
    at = {"models": f"{base}/models", "versions": f"{base}/versions"}
    for day, version in ((2, "m1"), (1, "m0")):  # the latest training wins, not the greatest name
        trained_at = datetime(2024, 1, 30 + (day == 1))
        train.run_training(visits, SPEC, AS_OF, version, f"{base}/training", params=PARAMS, trained_at=trained_at, **at)
    used = score.run_scoring(
        visits, SPEC, AS_OF, f"{base}/scoring", predictions=f"{base}/predictions", exports=f"{base}/exports", **at
    )
    assert used == "m0"
    expected = ext.scoring_extract(visits, SPEC, AS_OF)
    for _ in range(2):
        assert load.load_scores(spark, SPEC, AS_OF, used, f"{base}/predictions", f"{base}/scores") == expected.count()
    table = sc.read_score_table(spark, SPEC, f"{base}/scores")
    assert table.select("VISIT_ID").exceptAll(expected.select(F.col("visit_id").cast("string"))).isEmpty()
    assert tuple(reports.daily_average(table).first())[::2] == (date(2024, 1, 30), 40)

    folder = f"{base}/exports/score_date=2024-01-30"
    assert readers.read_ids_csv(spark, f"{folder}/ids", "visit_id", "bigint").exceptAll(expected.select("visit_id")).isEmpty()
    assert readers.read_feature_csv(spark, f"{folder}/features", SPEC).exceptAll(ext.features_only(expected, SPEC)).isEmpty()


def test_nothing_is_written_without_visits(spark, visits, tmp_path):
    late = date(2024, 5, 1)
    assert train.extract_training_set(visits, SPEC, late, f"{tmp_path}/training") is None
    assert train.run_training(visits, SPEC, late, "v", f"{tmp_path}/training", "m", "v") is None
    assert score.extract_scoring_set(visits, SPEC, late, f"{tmp_path}/scoring") == 0
    assert score.run_scoring(visits, SPEC, late, f"{tmp_path}/scoring", "m", "v", "p") is None
    assert not list(tmp_path.iterdir())


def test_training_set_counts(spark, visits, tmp_path):
    counts = train.extract_training_set(visits, SPEC, AS_OF, str(tmp_path))
    assert counts["train"] + counts["test"] == counts["total"] > 0


def test_training_and_scoring_clean_alike(spark, visits):
    day = visits.filter(F.to_date("created_at") == "2024-01-30")
    for_training = ext.clean_for_training(day, SPEC).select(*SPEC.raw_features)
    for_scoring = ext.features_only(ext.scoring_extract(visits, SPEC, AS_OF), SPEC)
    assert for_training.schema == for_scoring.schema
    assert for_training.exceptAll(for_scoring).isEmpty() and for_scoring.exceptAll(for_training).isEmpty()


def test_every_feature_of_the_full_list_encodes_and_assembles(spark):
    wide = contract._wide(spark, SF)
    cleaned = ext.training_extract(wide, VISIT_SPEC, AS_OF)
    codes = fit_codes(cleaned.filter("data_split = 'TRAIN'"), VISIT_SPEC.categorical)
    matrix = feature_matrix(cleaned, VISIT_SPEC, codes, keep=["data_split"])
    assert matrix.columns == ["data_split", *VISIT_SPEC.model_features]
    assert matrix.filter("data_split = 'TRAIN' AND DOMAIN_ENCODED < 0").isEmpty()


def test_day_filter_reaches_the_scan(spark, tmp_path, plan_of):
    contract._visits(spark, SF).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    plan = plan_of(ext.scoring_extract(stored, SPEC, AS_OF))
    assert "GreaterThanOrEqual(created_at,2024-01-30T00:00" in plan and "LessThan(created_at,2024-01-31T00:00" in plan
    assert "fraud_score" not in plan
    plan = plan_of(ext.training_extract(stored, SPEC, AS_OF))
    assert "GreaterThanOrEqual(created_at,2024-01-16T00:00" in plan and "IsNotNull(fraud_score)" in plan
    assert "Exchange" not in plan


def test_day_filter_prunes_partitions(spark, tmp_path, plan_of):
    by_day = contract._visits(spark, SF).withColumn("visit_date", F.to_date("created_at"))
    by_day.write.partitionBy("visit_date").parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    spec = replace(SPEC, day_partition="visit_date")
    for extract in (ext.scoring_extract(stored, spec, AS_OF), ext.training_extract(stored, spec, AS_OF)):
        assert "visit_date" in plan_of(extract).split("PartitionFilters: ")[1].split("]")[0]
    assert ext.scoring_extract(stored, spec, AS_OF).count() == 40
