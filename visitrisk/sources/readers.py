"""Readers. Every text format is read with a schema, so a value looks the same as when trained on."""

from __future__ import annotations

import csv
import re
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.functions.split import SPLIT
from visitrisk.sources.layout import CSV_OPTIONS, RUN_DATE, SCORE_DAY, in_partition
from visitrisk.spec import FeatureSpec


def read_visits(spark: SparkSession, source: str, format: str | None = None, **options: str) -> DataFrame:
    """The visit table: a catalog table by name, or any Spark format by its path and options."""
    if format is None:
        return spark.table(source)
    reader = spark.read.format(format).options(**options)
    return reader.load(source) if source else reader.load()


# The whole line of a record that does not fit its schema, where such records are kept.
DAMAGED = "__damaged"


def _checked(reader, schema: T.StructType, keep_damaged: bool):
    """A reader that fails on a record that does not fit ``schema``, or keeps its text in ``DAMAGED``.

    Without either, text in a numeric column would become NULL and surplus fields would vanish unseen.
    """
    if not keep_damaged:
        return reader.schema(schema).option("mode", "FAILFAST")
    kept = T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())])
    return reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED)


def sound(rows: DataFrame) -> DataFrame:
    """The records that fit their schema."""
    return rows.filter(F.col(DAMAGED).isNull()).drop(DAMAGED)


def damage(rows: DataFrame) -> DataFrame:
    """How many records were read, and how many do not fit their schema."""
    # A record is checked only in the columns that a query reads, so every column takes part in a
    # condition that never holds.
    never = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) > 1
    return rows.agg(F.count("*").alias("read"), F.count_if(F.col(DAMAGED).isNotNull() | never).alias("rejected"))


def _csv(spark: SparkSession, header: bool, multi_line: bool = False):
    return spark.read.options(**CSV_OPTIONS).option("header", header).option("multiLine", multi_line)


def _schema(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(k)) for n, k in fields])


def _as_given(uri: str) -> str:
    """The path that a reader takes for one file, whatever characters its name has."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _heads(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """The header of each CSV file below ``folder``: its first line with text, found in the tasks.

    A header with a line break inside quotes is an error, as a file's lines are read apart from each other.
    """
    lines = (
        spark.read.options(**_below(pattern))
        .text(folder)
        .filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), "value")
    )
    return lines.groupBy("path").agg(F.min_by("value", "at").alias("head"))


def _below(pattern: str) -> dict[str, str]:
    return {"recursiveFileLookup": "true", "pathGlobFilter": pattern}


def _names(head: str) -> list[str]:
    if head.count('"') % 2:
        raise ValueError(f"a header with a line break inside quotes: {head!r}")
    return next(csv.reader([head]))


def _csv_by_name(
    spark: SparkSession, folder: str, schema: T.StructType | None, multi_line: bool, pattern: str
) -> DataFrame | None:
    """CSV files with headers, read by column name whatever order each file has; None without files.

    A column that a file lacks is NULL there. Columns outside ``schema`` are left out. The driver gets one
    row per different header; only where there are several, the names of their files, too.
    """
    rows = None
    heads = _heads(spark, folder, pattern)
    different = sorted(r["head"] for r in heads.groupBy("head").agg(F.count("*")).collect())
    types = {} if schema is None else {f.name: f.dataType for f in schema}
    for head in different:
        own = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in _names(head)])
        reader = _checked(_csv(spark, True, multi_line), own, keep_damaged=False)
        if len(different) == 1:
            part = reader.options(**_below(pattern)).csv(folder)
        else:
            part = reader.csv([_as_given(r["path"]) for r in heads.filter(F.col("head") == head).collect()])
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is None or schema is None:
        return rows
    lacking = [f for f in schema if f.name not in rows.columns]
    if len(lacking) == len(schema):
        raise ValueError(f"no file below {folder} has any of the columns {schema.names}")
    return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f in lacking else F.col(f"`{f.name}`") for f in schema])


def read_ids_csv(spark: SparkSession, path: str, id_column: str, id_type: str = "string") -> DataFrame:
    """Ids from CSV with a header: the column of that name, wherever it stands. Its absence is an error."""
    rows = _csv_by_name(spark, path, _schema((id_column, id_type)), multi_line=False, pattern="*")
    if rows is None:
        raise ValueError(f"no file in {path}")
    return rows


def read_predictions_csv(
    spark: SparkSession, path: str, prediction: str, id_column: str | None = None, id_type: str = "string"
) -> DataFrame:
    """Predictions from CSV without a header: one per line, after the id when ``id_column`` is given.

    They stay text here; the score column is cast later, where rejects can be counted. A line with
    another number of fields, or an id of another type, is an error. Ids hold no line breaks here.
    """
    fields = [(prediction, "string")] if id_column is None else [(id_column, id_type), (prediction, "string")]
    return _checked(_csv(spark, header=False), _schema(*fields), keep_damaged=False).csv(path)


def read_feature_csv(
    spark: SparkSession,
    path: str,
    spec: FeatureSpec,
    id_type: T.DataType | None = None,
    multi_line: bool = False,
    keep_damaged: bool = False,
) -> DataFrame:
    """Cleaned features from CSV without a header, named by position; the id first when ``id_type`` is given.

    ``multi_line`` allows line breaks inside quoted text, one task per file; without it large files
    are split. A record that does not fit is an error, or kept apart with ``keep_damaged``: see
    :func:`sound` and :func:`damage`.
    """
    reader = _csv(spark, header=False, multi_line=multi_line)
    return _checked(reader, spec.cleaned_schema(id_type), keep_damaged).csv(path)


def read_feature_json(
    spark: SparkSession,
    path: str,
    spec: FeatureSpec,
    id_type: T.DataType | None = None,
    lines: bool = False,
    keep_damaged: bool = False,
) -> DataFrame:
    """Features from JSON: each file an array of records or one record, or one record per line.

    A feature that no record has is read as NULL. An array cannot be split, so a file is one task
    unless ``lines`` is on. Damaged records as in :func:`read_feature_csv`.
    """
    reader = spark.read.option("multiLine", not lines)
    return _checked(reader, spec.cleaned_schema(id_type), keep_damaged).json(path)


def _has_parquet(spark: SparkSession, folder: str) -> bool:
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
    )
    return not listing.select("path").isEmpty()


def read_folder(
    spark: SparkSession, folder: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """All files below ``folder``, each once: parquet if there is any, else CSV with a header.

    Files are joined by column name: a column that a file lacks is NULL there, and the order of a
    file's columns plays no part. Without a schema CSV columns are text.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if _has_parquet(spark, folder):
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        return (reader.option("mergeSchema", True) if fields is None else reader.schema(fields)).parquet(folder)
    rows = _csv_by_name(spark, folder, fields, multi_line, "*.csv")
    if rows is None:
        raise ValueError(f"no parquet or CSV files below {folder}")
    return rows


def read_training(spark: SparkSession, base: str, run_day: date, side: str | None = None) -> DataFrame:
    """The training dataset of one run, or one side of it; other runs are not even listed."""
    rows = spark.read.option("basePath", base).parquet(in_partition(base, RUN_DATE, run_day)).drop(RUN_DATE)
    return rows if side is None else rows.filter(rows[SPLIT] == side).drop(SPLIT)


def read_scoring(spark: SparkSession, base: str, day: date) -> DataFrame:
    """The complete scoring dataset of one day."""
    return spark.read.option("basePath", base).parquet(in_partition(base, SCORE_DAY, day)).drop(SCORE_DAY)
