import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from visitrisk.functions import cleaning, days
from visitrisk.operators import extract
from visitrisk.spec import VISIT_SPEC, FeatureSpec

SPEC = FeatureSpec(("b",), ("c",), ("n",), target="y", id="id", event_time="at")
AS_OF = date(2024, 1, 31)


def test_missing_values(spark):
    rows = spark.createDataFrame(
        [(True, "x", 1.5), (False, "", math.nan), (None, None, None)], "b boolean, c string, n double"
    )
    clean = rows.select(cleaning.flag("b"), cleaning.category("c"), cleaning.number("n")).collect()
    assert [r["b"] for r in clean] == [1, 0, 0]
    assert [r["c"] for r in clean] == ["x", "", "MISSING"]
    assert clean[0]["n"] == 1.5 and math.isnan(clean[1]["n"]) and clean[2]["n"] == 0.0


def test_numeric_columns_become_double(spark):
    rows = spark.sql("SELECT 1 AS b, 12 AS c, CAST(1.25 AS DECIMAL(5,2)) AS n, 'p' AS id, 3.0D AS y")
    clean = extract.clean_for_training(rows.withColumn("b", F.col("b") == 1), SPEC)
    assert dict(clean.dtypes) == {"b": "int", "c": "string", "n": "double", "y": "double"}
    assert tuple(clean.first()) == (1, "12", 1.25, 3.0)


def test_bad_score_text_is_null(spark):
    raw = spark.createDataFrame([("1.5",), ("n/a",), ("",), (None,)], "s string")
    assert [r[0] for r in raw.select(cleaning.score("s")).collect()] == [1.5, None, None, None]


EDGES = [
    (1, datetime(2024, 1, 30)),
    (2, datetime(2024, 1, 30, 23, 59, 59, 999999)),
    (3, datetime(2024, 1, 31)),
    (4, datetime(2024, 1, 16)),
    (5, datetime(2024, 1, 15, 23, 59, 59)),
]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string", "date"])
def test_day_edges(spark, kind):
    visits = spark.createDataFrame(EDGES, "id int, at timestamp_ntz").withColumn("at", F.col("at").cast(kind))
    during = visits.filter(days.during(visits, SPEC, days.yesterday(AS_OF)))
    assert {r["id"] for r in during.collect()} == {1, 2}
    since = visits.filter(days.since(visits, SPEC, date(2024, 1, 16)))
    assert {r["id"] for r in since.collect()} == {1, 2, 3, 4}


def test_unlabelled_rows_do_not_train(spark):
    visits = spark.createDataFrame(
        [(1, datetime(2024, 1, 30), True, "x", 1.0, None), (2, datetime(2024, 1, 30), True, "x", 1.0, 7.0)],
        "id int, at timestamp_ntz, b boolean, c string, n double, y double",
    )
    assert [r["y"] for r in extract.training_extract(visits, SPEC, AS_OF).collect()] == [7.0]
    assert extract.scoring_extract(visits, SPEC, AS_OF).count() == 2


def test_feature_list():
    assert (len(VISIT_SPEC.boolean), len(VISIT_SPEC.categorical), len(VISIT_SPEC.numeric)) == (3, 23, 69)
    assert len(set(VISIT_SPEC.raw_features)) == 95
    assert VISIT_SPEC.model_features[3] == "IP_API_CITY_ENCODED"


def test_available_features_ignore_case_and_keep_order():
    found = VISIT_SPEC.available(["domain", "IP_API_CITY", "ip_api_proxy", "other"])
    assert found.raw_features == ("IP_API_PROXY", "IP_API_CITY", "DOMAIN")
