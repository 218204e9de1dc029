import random

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitrisk.operators import encode as enc


# Looked up inside a projection, by a broadcast join, by a shuffled join.
LIMITS = [(enc.BROADCAST_BYTES, enc.INLINE_BYTES), (enc.BROADCAST_BYTES, 0), (0, 0)]


def codes_of(codes):
    return {(r["feature"], r["value"]): r["code"] for r in codes.collect()}


def expected_codes(rows, columns):
    return {
        (c, value): code
        for i, c in enumerate(columns)
        for code, value in enumerate(sorted({r[i] for r in rows if r[i] is not None}))
    }


def test_code_point_order(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("é",), ("Z",)], "c string")
    assert codes_of(enc.fit_codes(rows, ["c"])) == {("c", "Z"): 0, ("c", "a"): 1, ("c", "b"): 2, ("c", "é"): 3}


def test_unknown_and_null_are_minus_one(spark):
    codes = enc.fit_codes(spark.createDataFrame([("a",), ("b",)], "c string"), ["c"])
    rows = spark.createDataFrame([(1, "b"), (2, "q"), (3, None)], "id int, c string")
    for limits in LIMITS:
        found = {r["id"]: r["c_ENCODED"] for r in enc.encode(rows, codes, ["c"], *limits).collect()}
        assert found == {1: 1, 2: -1, 3: -1}


def test_numbering_over_many_partitions(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="13")
    values = [f"v{random.Random(i).getrandbits(40)}" for i in range(3000)]
    rows = [(v, values[i % 7]) for i, v in enumerate(values)]
    fitted = enc.fit_codes(spark.createDataFrame(rows, "many string, few string"), ["many", "few"])
    assert fitted.rdd.getNumPartitions() > 5
    assert codes_of(fitted) == expected_codes(rows, ["many", "few"])


texts = st.one_of(st.none(), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=4))


@given(fit=st.lists(st.tuples(texts, texts), min_size=1, max_size=30), other=st.lists(st.tuples(texts, texts), min_size=1, max_size=30))
@hypothesis_settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_against_brute_force(spark, fit, other):
    schema = "a string, b string"
    codes = enc.fit_codes(spark.createDataFrame(fit, schema), ["a", "b"])
    expected = expected_codes(fit, ["a", "b"])
    assert codes_of(codes) == expected
    encoded = enc.encode(spark.createDataFrame(other, schema), codes, ["a", "b"], unfitted=["a", "b"])
    assert sorted(tuple(r) for r in encoded.collect()) == sorted(
        (expected.get(("a", a), -1), expected.get(("b", b), -1)) for a, b in other
    )


def test_every_lookup_gives_the_same_on_skewed_values(spark, monkeypatch):
    monkeypatch.setattr(enc, "COMMON_VALUES", 2)
    rows = [(i, "hot" if i % 3 == 0 else f"v{i % 500}", "new" if i % 2 else f"w{i % 90}") for i in range(6000)]
    frame = spark.createDataFrame(rows, "id int, a string, b string").repartition(8)
    codes = enc.fit_codes(frame.filter("b != 'new' AND id < 4000"), ["a", "b"])
    inline, broadcast, shuffled = (enc.encode(frame, codes, ["a", "b"], *limits) for limits in LIMITS)
    expected = sorted(map(tuple, inline.collect()))
    assert sorted(map(tuple, broadcast.collect())) == expected
    assert sorted(map(tuple, shuffled.collect())) == expected
    assert len(expected) == 6000


def test_common_values_are_few_and_spread(spark, settings, monkeypatch):
    """Rows of a hot value do not meet in one partition, though the value is unknown."""
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(enc, "COMMON_VALUES", 2)
    frame = spark.range(0, 8000, numPartitions=32).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("a")
    )
    codes = enc.fit_codes(frame.filter("a != 'hot'"), ["a"])
    encoded = enc.encode(frame, codes, ["a"], broadcast_bytes=0)
    sizes = encoded.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 8000
    assert max(r["count"] for r in sizes) < 8000 / 8 * 2


def test_budget_counts_all_features(spark):
    codes = spark.createDataFrame(
        [("a", "x", 0), ("b", "y" * 100, 0), ("c", "z" * 1000, 0)], "feature string, value string, code int"
    )
    sizes = enc._sizes(codes)
    assert enc._within(sizes, ["c", "b", "a"], 300) == ["a", "b"]
    assert enc._within(sizes, ["c", "b", "a"], 100) == ["a"]
    assert enc._within(sizes, ["c", "b", "a"], 5000) == ["a", "b", "c"]


def test_lookups_follow_the_measured_sizes(spark, plan_of):
    rows = spark.createDataFrame([("x", "y" * 100, "z" * 1000, "u")], "a string, b string, c string, unseen string")
    codes = enc.fit_codes(rows, ["a", "b", "c"])
    encoded = enc.encode(
        rows, codes, ["a", "b", "c", "unseen"], broadcast_bytes=300, inline_bytes=100, unfitted=["unseen"]
    )
    with pytest.raises(ValueError, match="unseen"):
        enc.encode(rows, codes, ["a", "unseen"])
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "__index_0" in plan and "__index_1" not in plan
    assert "__value_0" in plan and "__value_1" not in plan and "__rare_code_0" in plan and "__rare_code_1" not in plan
    assert [tuple(r) for r in encoded.collect()] == [(0, 0, 0, -1)]


def test_codes_with_gaps_are_joined(spark):
    codes = spark.createDataFrame([("a", "x", 3), ("a", "y", 9)], "feature string, value string, code int")
    rows = spark.createDataFrame([("x",), ("y",), ("q",)], "a string")
    assert sorted(r[0] for r in enc.encode(rows, codes, ["a"]).collect()) == [-1, 3, 9]


def test_saved_codes_keep_text(spark, tmp_path):
    rows = [("17.10",), ("NA",), ("16",), ("",), ("017",)]
    codes = enc.fit_codes(spark.createDataFrame(rows, "c string"), ["c"])
    enc.write_codes(codes, str(tmp_path / "codes"))
    assert codes_of(enc.read_codes(spark, str(tmp_path / "codes"))) == expected_codes(rows, ["c"])


@pytest.mark.parametrize("limits", LIMITS)
def test_duplicate_rows_stay(spark, limits):
    rows = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 3, "c string, n int")
    encoded = enc.encode(rows, enc.fit_codes(rows, ["c"]), ["c"], *limits)
    assert encoded.groupBy("n").count().orderBy("n").collect() == [(1, 50), (2, 3)]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_shuffled_codes_equal_inline_codes(spark, settings, plan_of, adaptive):
    """The far side is really shuffled, with a hot fitted value, a hot unknown one, a long one and NULLs."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled=adaptive)
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.repeat(F.lit("x"), 9000))
    frame = spark.range(0, 6000, numPartitions=8).select(
        "id",
        hot.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("v"), F.col("id") % 700)).alias("a"),
        (F.col("id") % 4).alias("b"),
    )
    codes = enc.fit_codes(frame.filter("a NOT LIKE 'x%' AND id < 5000"), ["a", "b"])
    inline = enc.encode(frame, codes, ["a", "b"])
    shuffled = enc.encode(frame, codes, ["a", "b"], 0, 0)
    assert plan_of(shuffled).count("SortMergeJoin") >= 2
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, inline.collect()))


@pytest.mark.parametrize("limits", LIMITS)
def test_categories_of_any_type_are_text(spark, limits):
    rows = spark.sql("SELECT id, id % 2 = 0 AS flag, date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS day FROM range(30)")
    codes = enc.fit_codes(rows, ["flag", "day"])
    found = enc.encode(rows, codes, ["flag", "day"], *limits)
    assert {tuple(r) for r in found.collect()} == {(i, 1 - i % 2, i % 3) for i in range(30)}


def test_shuffles_do_not_grow_with_the_large_columns(spark, settings, plan_of):
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    columns = [f"c{i}" for i in range(5)]
    frame = spark.range(0, 3000, numPartitions=4).select(
        "id", *[F.concat(F.lit("v"), F.col("id") * (i + 3) % (1500 + i)).alias(c) for i, c in enumerate(columns)]
    )
    codes = spark.createDataFrame(enc.fit_codes(frame, columns).collect(), "feature string, value string, code int")
    expected = sorted(map(tuple, enc.encode(frame, codes, columns).collect()))
    for limits in ((0, 0), (0, enc.INLINE_BYTES)):
        for used in (columns[:1], columns):
            plan = plan_of(enc.encode(frame, codes, used, *limits))
            assert plan.count("Exchange hashpartitioning") == 4
            assert plan.count("SortMergeJoin") == 2
        assert sorted(map(tuple, enc.encode(frame, codes, columns, *limits).collect())) == expected


def test_rare_values_keep_their_place(spark, monkeypatch):
    """Rows whose values are the same, but in other columns or with a NULL between, have keys of their own."""
    monkeypatch.setattr(enc, "COMMON_VALUES", 1)
    rows = [("x", None, "y"), (None, "x", "y"), ("y", "x", None), ("xy", "", None), ("", "xy", None), (None, None, None)] * 3
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    codes = spark.createDataFrame(
        [(c, v, 10 * i + j) for i, c in enumerate("abc") for j, v in enumerate(["", "x", "xy", "y"])],
        "feature string, value string, code int",
    )
    place = {c: {"": 10 * i, "x": 10 * i + 1, "xy": 10 * i + 2, "y": 10 * i + 3} for i, c in enumerate("abc")}
    expected = sorted(tuple(place[c].get(v, -1) for c, v in zip("abc", row)) for row in rows)
    for limits in LIMITS:
        assert sorted(map(tuple, enc.encode(frame, codes, list("abc"), *limits).collect())) == expected
