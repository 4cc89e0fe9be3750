"""Delimited source files under a declared all-text schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.operators.aggregates import union_all
from tierstar.schemas import CORRUPT, TableSpec


def _options(separator: str, raw_quotes: bool, multiline: bool) -> dict[str, str]:
    options = {
        "header": "true",
        "encoding": "UTF-8",
        "sep": separator,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # A pruned parser does not notice missing or extra fields, so all fields are always parsed.
        "columnPruning": "false",
        "multiLine": str(multiline).lower(),
    }
    if raw_quotes:
        options["quote"] = ""
    else:
        # A quoted empty field stays distinguishable from an empty one.
        options |= {"quote": '"', "escape": '"', "emptyValue": '""'}
    return options


def read_raw(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    raw_quotes: bool = False,
    multiline: bool = False,
    check_header: bool = True,
) -> DataFrame:
    """Text columns as in the file, plus ``_corrupt_record`` holding any line with too few or too many fields.

    ``raw_quotes`` leaves quotes in the data. ``multiline`` reads values that contain line breaks;
    such files cannot be split between tasks, so prefer a cleaned file for large inputs.
    ``check_header`` makes the read fail when a file's header is not the declared one.
    """
    schema = T.StructType([*spec.raw_schema().fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .options(**_options(spec.separator, raw_quotes, multiline))
        .option("enforceSchema", str(not check_header).lower())
        .csv(path)
    )


def accepted(raw: DataFrame) -> DataFrame:
    """Rows with the right number of fields."""
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(raw: DataFrame) -> DataFrame:
    """Rows with too few or too many fields, with the line as it stood in the file."""
    return raw.filter(F.col(CORRUPT).isNotNull())


def file_headers(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """The column names of every file of a folder, as its own first line gives them: file, names. Only first blocks of files are read."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    heads = lines.filter(F.col("start") == 0).withColumn("place", F.monotonically_increasing_id())
    heads = heads.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    plain = F.regexp_replace("header", "[\ufeff\r]", "")
    names = F.transform(F.split(plain, F.concat(F.lit("\\Q"), F.lit(separator), F.lit("\\E"))), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    return heads.select("file", names.alias("names"))


def header_drift(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Files whose header is not the declared one: file, and the columns it lacks or has in excess."""
    declared, names = F.array(*[F.lit(c.raw) for c in spec.columns]), F.col("names")
    found = file_headers(spark, path, spec.separator).select("file", F.array_except(declared, names).alias("missing"), F.array_except(names, declared).alias("unexpected"), (names != declared).alias("drifts"))
    return found.filter("drifts").drop("drifts")


def read_evolved(spark: SparkSession, path: str, spec: TableSpec, renames: Mapping[str, str] | None = None, raw_quotes: bool = False) -> DataFrame:
    """The raw table of files whose headers changed over time: every file is read by its own header.

    Columns are matched by name, whatever their order; ``renames`` maps earlier names to the declared ones. A declared column that a file
    lacks is NULL there, and one that is not declared is left out. Lines with a wrong number of fields for their own file carry ``_corrupt_record``.
    Files are read together by header, so there are as many scans as versions of the header.
    """
    versions = file_headers(spark, path, spec.separator).groupBy("names").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("names").collect()
    parts = []
    for version in versions:
        known = [(renames or {}).get(n, n) for n in version.names]
        twice = {c.raw for c in spec.columns if known.count(c.raw) > 1}
        if twice:
            raise ValueError(f"{', '.join(sorted(twice))} found more than once in the header of {version.files[0]}")
        # By position, because two undeclared columns may share a name.
        fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(len(known))]
        read = spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])).options(**_options(spec.separator, raw_quotes, False)).csv(list(version.files))
        columns = [(F.col(f"_c{known.index(c.raw)}") if c.raw in known else F.lit(None).cast("string")).alias(c.raw) for c in spec.columns]
        parts.append(read.select(*columns, CORRUPT))
    if not parts:
        return spark.createDataFrame([], T.StructType([*spec.raw_schema().fields, T.StructField(CORRUPT, T.StringType())]))
    return union_all(parts)
