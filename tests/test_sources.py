import json
from datetime import date

import pytest
from pyspark.sql import types as T

from visitrisk.operators.extract import clean_for_scoring
from visitrisk.sources import readers, writers
from visitrisk.spec import FeatureSpec

SPEC = FeatureSpec(("b",), ("c", "d"), ("n",), target="y", id="id", event_time="at")
TEXTS = ["plain", "", " padded ", 'a "quoted" word', "comma, inside", "line\nbreak", "cr\r\nlf", "17.10", "NA", "null", "é", "\\", "\\N", "#x", "'"]


@pytest.fixture
def cleaned(spark):
    rows = [(i, i % 2, text, text[::-1], i / 3) for i, text in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id bigint, b int, c string, d string, n double").coalesce(1)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_feature_csv_keeps_every_text(spark, cleaned, tmp_path):
    writers.write_feature_csv(cleaned, SPEC, str(tmp_path / "f"))
    back = readers.read_feature_csv(spark, str(tmp_path / "f"), SPEC, multi_line=True)
    assert back.dtypes == [("b", "int"), ("c", "string"), ("d", "string"), ("n", "double")]
    assert content(back) == content(cleaned.drop("id"))


def test_feature_json_keeps_every_text(spark, cleaned, tmp_path):
    writers.write_feature_json(cleaned, SPEC, str(tmp_path / "f"))
    back = readers.read_feature_json(spark, str(tmp_path / "f"), SPEC, T.LongType(), lines=True)
    assert content(back) == content(cleaned)


@pytest.mark.parametrize(
    "document",
    [
        [{"b": 1, "c": "x", "d": "17.10", "n": 2}, {"c": "y", "n": 0.5, "more": 3}],
        {"b": 0, "c": "only", "d": "NA", "n": 1.0},
    ],
)
def test_json_array_or_single_record(spark, tmp_path, document):
    (tmp_path / "in.json").write_text(json.dumps(document))
    found = readers.read_feature_json(spark, str(tmp_path), SPEC)
    records = document if isinstance(document, list) else [document]
    assert content(found) == sorted(
        (tuple(r.get(k) for k in ("b", "c", "d", "n")) for r in records), key=repr
    )


def test_plain_csv_from_elsewhere(spark, tmp_path):
    (tmp_path / "in.csv").write_text('1,x,"a ""b"" c",1.5\n0,,17.10,\n')
    found = readers.read_feature_csv(spark, str(tmp_path), SPEC).collect()
    assert [tuple(r) for r in found] == [(1, "x", 'a "b" c', 1.5), (0, None, "17.10", None)]


def test_ids_csv_has_a_header_and_keeps_null(spark, tmp_path):
    ids = spark.createDataFrame([("a",), ("",), (None,), ("007",)], "id string").coalesce(1)
    writers.write_ids_csv(ids, SPEC, str(tmp_path / "ids"))
    (file,) = (tmp_path / "ids").glob("*.csv")
    assert file.read_text().splitlines()[0] == "id"
    assert content(readers.read_ids_csv(spark, str(tmp_path / "ids"), "id")) == content(ids)


def test_predictions_one_per_line(spark, tmp_path):
    scored = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "id string, prediction double").coalesce(1)
    writers.write_predictions_csv(scored, str(tmp_path / "p"), with_id=False)
    (file,) = (tmp_path / "p").glob("*.csv")
    assert file.read_text() == "1.5\n2.0\n"
    writers.write_predictions_csv(scored, str(tmp_path / "k"))
    (file,) = (tmp_path / "k").glob("*.csv")
    assert file.read_text() == "a,1.5\nb,2.0\n"


def test_folder_prefers_parquet_and_reads_each_file_once(spark, tmp_path):
    ids = spark.range(10)
    ids.write.parquet(str(tmp_path / "x" / "deep" / "one"))
    ids.write.parquet(str(tmp_path / "x" / "two"))
    ids.write.option("header", True).csv(str(tmp_path / "x" / "text"))
    assert readers.read_folder(spark, str(tmp_path / "x")).count() == 20


def test_folder_of_csv_keeps_text(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("c,n\n17.10,1\n")
    (tmp_path / "sub" / "b.csv").write_text("c,n\nNA,2\n")
    assert content(readers.read_folder(spark, str(tmp_path))) == [("17.10", "1"), ("NA", "2")]
    typed = readers.read_folder(spark, str(tmp_path), "c string, n double")
    assert content(typed) == [("17.10", 1.0), ("NA", 2.0)]


def test_folder_joins_files_by_column_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("c,n\nx,1\n")
    (tmp_path / "b.csv").write_text("n,c\n2,y\n")
    (tmp_path / "c.csv").write_text('n,"odd, name"\n3,z\n')
    found = readers.read_folder(spark, str(tmp_path))
    rows = sorted((r["n"], r["c"], r["odd, name"]) for r in found.collect())
    assert rows == [("1", "x", None), ("2", "y", None), ("3", None, "z")]
    typed = readers.read_folder(spark, str(tmp_path), "n int, c string, more double").collect()
    assert sorted((r["n"], r["c"], r["more"]) for r in typed if r["c"]) == [(1, "x", None), (2, "y", None)]


def test_ids_by_name_wherever_the_column_stands(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("created,id\n2024,7\n2023,8\n")
    assert content(readers.read_ids_csv(spark, str(tmp_path), "id", "int")) == [(7,), (8,)]
    with pytest.raises(ValueError, match="visit"):
        readers.read_ids_csv(spark, str(tmp_path), "visit")


def test_damaged_records_fail_or_are_kept_apart(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1,x,y,1.5\n1,x,y,abc\n1,x,y,2.5,surplus\n1,x\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_feature_csv(spark, str(tmp_path), SPEC).collect()
    kept = readers.read_feature_csv(spark, str(tmp_path), SPEC, keep_damaged=True)
    assert tuple(readers.damage(kept).first()) == (4, 3)
    assert content(readers.sound(kept)) == [(1, "x", "y", 1.5)]


def test_feature_csv_with_id(spark, tmp_path):
    rows = spark.createDataFrame([(7, 1, "a", "b", 2.0)], "id long, b int, c string, d string, n double")
    writers.write_feature_csv(rows, SPEC, str(tmp_path / "k"), with_id=True)
    assert content(readers.read_feature_csv(spark, str(tmp_path / "k"), SPEC, T.LongType())) == [(7, 1, "a", "b", 2.0)]


def test_folder_without_data_is_an_error(spark, tmp_path):
    (tmp_path / "note.txt").write_text("x")
    with pytest.raises(ValueError, match="no parquet or CSV"):
        readers.read_folder(spark, str(tmp_path))


def test_rerun_replaces_the_whole_run(spark, tmp_path):
    base = str(tmp_path)
    both = spark.createDataFrame([(1, "TRAIN"), (2, "TEST")], "n int, data_split string")
    writers.write_training(both, base, date(2024, 1, 30))
    writers.write_training(both, base, date(2024, 1, 31))
    writers.write_training(both.filter("data_split = 'TRAIN'"), base, date(2024, 1, 31))
    assert readers.read_training(spark, base, date(2024, 1, 30)).count() == 2
    assert readers.read_training(spark, base, date(2024, 1, 31)).count() == 1
    assert readers.read_training(spark, base, date(2024, 1, 30), "TEST").columns == ["n"]


def test_visits_by_table_name_and_by_format(spark, tmp_path):
    visits = spark.createDataFrame([(1, True, "x", "y", 2.0)], "id int, b boolean, c string, d string, n double")
    visits.createOrReplaceTempView("visits_of_test")
    assert clean_for_scoring(readers.read_visits(spark, "visits_of_test"), SPEC).count() == 1
    visits.write.orc(str(tmp_path / "orc"))
    assert readers.read_visits(spark, str(tmp_path / "orc"), "orc").count() == 1


@pytest.mark.parametrize("name", ["a b", "50%", "a%20b", "c+d", "{x,y}", "[ab]", "q?*", "é"])
def test_files_of_any_name_are_read(spark, tmp_path, name):
    for at in (tmp_path / name / "one.csv", tmp_path / "plain" / f"{name}.csv"):
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text("visit_id,x\n1,a\n2,b\n")
    ids = readers.read_ids_csv(spark, str(tmp_path), "visit_id", "int")
    assert sorted(r["visit_id"] for r in ids.collect()) == [1, 1, 2, 2]
    assert readers.read_folder(spark, str(tmp_path), "visit_id int, x string").count() == 4


def test_file_names_reach_the_driver_only_where_headers_differ(spark, tmp_path, monkeypatch):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"c,n\nx,{i}\n")
    (tmp_path / "empty.csv").write_text("")
    asked = []
    monkeypatch.setattr(readers, "_as_given", lambda uri, given=readers._as_given: asked.append(uri) or given(uri))
    assert content(readers.read_folder(spark, str(tmp_path), "n int")) == [(i,) for i in range(5)]
    assert not asked
    (tmp_path / "other.csv").write_text("\n\nn,c\n5,y\n")
    assert content(readers.read_folder(spark, str(tmp_path), "n int")) == [(i,) for i in range(6)]
    assert len(asked) == 6


def test_a_header_over_two_lines_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"c\nd",n\nx,1\n')
    with pytest.raises(ValueError, match="line break"):
        readers.read_folder(spark, str(tmp_path))
