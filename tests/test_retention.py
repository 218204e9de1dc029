from datetime import date, datetime

from visitrisk.operators import retention


def test_due(spark):
    days = spark.createDataFrame(
        [
            (kind, day)
            for kind in ("training", "inference", "models", "other")
            for day in (date(2023, 1, 1), date(2024, 1, 1), date(2024, 3, 1), date(2024, 3, 31))
        ],
        "dataset string, day date",
    )
    due = {(r["dataset"], r["day"]): r["action"] for r in retention.due_partitions(days, date(2024, 4, 1)).collect()}
    assert due == {
        ("training", date(2023, 1, 1)): "expire",
        ("training", date(2024, 1, 1)): "expire",
        ("inference", date(2023, 1, 1)): "expire",
        ("inference", date(2024, 1, 1)): "expire",
        ("inference", date(2024, 3, 1)): "expire",
        ("models", date(2023, 1, 1)): "expire",
        ("models", date(2024, 1, 1)): "archive",
    }


def test_a_day_expires_only_after_its_last_day(spark):
    days = spark.createDataFrame([("inference", date(2024, 1, 1))], "dataset string, day date")
    assert retention.due_partitions(days, date(2024, 1, 31)).count() == 0
    assert retention.due_partitions(days, date(2024, 2, 1)).count() == 1


def test_days_come_from_the_folders_one_level_below(spark, tmp_path):
    for name in ("score_date=2024-01-01", "score_date=2024-01-02", "score_date=odd", "other"):
        (tmp_path / name / "MODEL_VERSION=v").mkdir(parents=True)
    days = retention.partition_days(spark, "inference", str(tmp_path), "score_date").collect()
    assert {r["day"] for r in days} == {None, date(2024, 1, 1), date(2024, 1, 2)} and len(days) == 3
    assert retention.partition_days(spark, "inference", str(tmp_path / "none"), "score_date").count() == 0


def test_models_are_kept_by_their_last_training(spark):
    versions = spark.createDataFrame(
        [("a", datetime(2023, 1, 1)), ("a", datetime(2024, 3, 30)), ("b", datetime(2023, 12, 1)), ("c", datetime(2022, 1, 1))],
        "model_version string, trained_at timestamp_ntz",
    )
    due = retention.due_partitions(retention.model_days(versions), date(2024, 4, 1)).collect()
    assert {(r["model_version"], r["action"]) for r in due} == {("b", "archive"), ("c", "expire")}
