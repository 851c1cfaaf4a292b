"""Delimited and fixed-width inputs, and the writers of the finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODE_LIST_SCHEMA = "icd10_code string, description string"


def _delimited(
    spark: SparkSession, path: str, schema: str, sep: str, header: bool, multi_line: bool
) -> DataFrame:
    return (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("nullValue", "")
        .schema(schema)
        .csv(path)
    )


def read_csv(
    spark: SparkSession, path: str, schema: str, header: bool = True, multi_line: bool = True
) -> DataFrame:
    """Comma-separated text; an empty field is null.

    Fields in quotes can hold line breaks, as spreadsheet exports have them. Then a
    file is read by one task; ``multi_line=False`` splits large files without such fields.
    """
    return _delimited(spark, path, schema, ",", header, multi_line)


def read_tsv(
    spark: SparkSession, path: str, schema: str, header: bool = True, multi_line: bool = True
) -> DataFrame:
    """Tab-delimited text, otherwise as ``read_csv``."""
    return _delimited(spark, path, schema, "\t", header, multi_line)


def read_fixed_width(spark: SparkSession, path: str, fields: dict[str, int]) -> DataFrame:
    """Text lines cut at the given widths; blanks around a field go, empty is null."""
    columns, start = [], 1
    for name, width in fields.items():
        text = F.trim(F.substring("value", start, width))
        columns.append(F.nullif(text, F.lit("")).alias(name))
        start += width
    return spark.read.text(path).select(*columns)


def read_code_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """The fixed-width code list: 8 characters of code, 300 of description."""
    return read_fixed_width(spark, path, {"original": 8, "description": 300})


def official_list(df: DataFrame) -> DataFrame:
    """First two columns, whatever their names, as (icd10_code, description)."""
    first, second = df.columns[:2]
    return df.select(F.col(first).alias("icd10_code"), F.col(second).alias("description"))


def release_table(spark: SparkSession, releases: list[dict]) -> DataFrame:
    """Metadata of the yearly releases as a (year, url, file) dimension."""
    schema = T.StructType.fromDDL("year int, url string, file string")
    return spark.createDataFrame([(r["year"], r.get("url"), r.get("file")) for r in releases], schema)


def missing_releases(releases: DataFrame, docs: DataFrame) -> DataFrame:
    """Announced releases for which no document was read."""
    return releases.join(docs.select("year").distinct(), "year", "left_anti")


def _write_csv(df: DataFrame, path: str, by: list[str], mode: str) -> None:
    writer = df.write.mode(mode)
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.option("header", True).option("nullValue", "").option("emptyValue", "").option(
        "escape", '"'
    ).csv(path)


def write_hierarchy(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite") -> None:
    """Hierarchy table, a folder per year, ordered by code inside each file.

    Overwriting replaces the years that ``df`` has and leaves all others. Rows of a
    CSV file hold their ``year`` as well; its folders are named ``release=``.
    """
    ordered = df.repartitionByRange("year", "icd10_code").sortWithinPartitions("year", "icd10_code")
    if file_format == "csv":
        _write_csv(ordered.withColumn("release", F.col("year")), path, ["release"], mode)
    else:
        ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def write_phrases(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write_csv(df, path, [], mode)
