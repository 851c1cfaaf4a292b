"""Yearly releases loaded again and again: only files that are new or changed are read.

A *store* is a folder with two growing tables. ``manifest`` has a row for each
file and each load that found it new, changed or gone: size, modification time, hash of
the content, year and outcome. ``parsed`` has the documents of the files a load has parsed. A load lists
the release folder, anti-joins the list with the manifest, hashes the files whose
size or time differ, and parses those whose content is new. What the store
then holds is what a full read of the folder would give.

A load writes its documents before its manifest rows; one that dies in between
is done again under the same number. Two loads of a store must not run at once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codetree.sources.tabular_xml import CORRUPT, DOCUMENT_SCHEMA, NAME_YEAR, judge, read_raw
from codetree.staging import stage

# Outcomes of a file in a load.
PARSED, BROKEN, NO_YEAR, NO_RELEASE, GONE = "parsed", "not parsed", "no year", "no release", "gone"

# ``parsed_in`` is the load whose documents of the file hold.
MANIFEST = (
    "load int, file string, path string, size long, modified timestamp, hash string, "
    "year int, outcome string, parsed_in int"
)
_KEPT = "file string, path string, size long, modified timestamp, hash string, year int, outcome string, parsed_in int"


def table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """All rows of the store's manifest."""
    return table(spark, f"{store}/manifest", MANIFEST)


def current(spark: SparkSession, store: str) -> DataFrame:
    """The last manifest row of every file, gone ones included."""
    last = F.max_by(F.struct("*"), "load").alias("last")
    return manifest(spark, store).groupBy(F.col("file").alias("_file")).agg(last).select("last.*")


def list_files(spark: SparkSession, path: str, name_filter: str = "*.xml") -> DataFrame:
    """(file, path, size, modified) of the files below ``path``, whose content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_filter)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file"), "path",
            F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        )
    )


def _hashed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, found) with the SHA-256 of each file."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("_metadata.file_path").alias("file"), F.sha2("content", 256).alias("found"))


def _outcomes(parsed: DataFrame) -> DataFrame:
    """(file, year, outcome) of parsed files: broken where any document is."""
    broken = F.max(F.col(CORRUPT).isNotNull())
    outcome = F.when(broken, BROKEN).when(F.max("year").isNull(), NO_YEAR).otherwise(PARSED)
    return parsed.groupBy("file").agg(F.max("year").alias("year"), outcome.alias("outcome"))


def load(
    spark: SparkSession, path: str, store: str, name_filter: str = "*.xml", year_pattern: str = NAME_YEAR
) -> DataFrame:
    """Bring the store up to the release folder; the manifest rows this load has added.

    A file counts as changed when its content hash differs; one that was only touched gets
    its new time. A load that finds no change adds no rows and takes no number. Files that do not parse stay out of the documents until they change. The
    driver holds the paths of the changed files, as it does for any read.
    """
    known = current(spark, store).filter(F.col("outcome") != GONE)
    number = (manifest(spark, store).agg(F.max("load")).first()[0] or 0) + 1
    listed = list_files(spark, path, name_filter)
    differing = listed.join(known.select("file", "size", "modified"), ["file", "size", "modified"], "left_anti")
    suspects = differing.collect()
    found = spark.createDataFrame(suspects, differing.schema)
    hashes = _hashed(spark, [r["path"] for r in suspects]) if suspects else spark.createDataFrame([], "file string, found string")
    before = known.select("file", "hash", "year", "outcome", "parsed_in")
    found = found.join(hashes, "file", "left").join(before, "file", "left")
    found = stage(found.withColumn("changed", ~F.col("found").eqNullSafe(F.col("hash"))), "found-files")
    changed = [r["path"] for r in found.filter("changed").select("path").collect()]
    outcomes = spark.createDataFrame([], "file string, year int, outcome string")
    if changed:
        folder = f"{store}/parsed/load={number}"
        read_raw(spark, changed, name_filter, year_pattern).write.mode("overwrite").parquet(folder)
        outcomes = _outcomes(spark.read.parquet(folder))
    new = outcomes.select("file", F.col("year").alias("new_year"), F.col("outcome").alias("new_outcome"))
    values = {
        "hash": F.col("found"),
        "year": F.col("new_year"),
        "outcome": F.coalesce("new_outcome", F.lit(NO_RELEASE)),
        "parsed_in": F.lit(number),
    }
    rows = found.join(new, "file", "left").withColumns({c: F.when(F.col("changed"), v).otherwise(F.col(c)) for c, v in values.items()})
    lost = known.join(listed.select("file"), "file", "left_anti").withColumn("outcome", F.lit(GONE))
    columns = [c.split()[0] for c in _KEPT.split(", ")]
    target = f"{store}/manifest/load={number}"
    rows.select(columns).unionByName(lost.select(columns)).write.mode("overwrite").parquet(target)
    return spark.read.schema(_KEPT).parquet(target).withColumn("load", F.lit(number))


def releases(spark: SparkSession, store: str, several_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantined files) the store holds, with the ``load`` each document was read in.

    As ``read_releases`` of the folder would give; with ``several_files`` all files of a year are its release.
    """
    read = table(spark, f"{store}/parsed", f"{DOCUMENT_SCHEMA}, {CORRUPT} string, file string, year int, load int")
    held = current(spark, store).filter(F.col("outcome").isin(PARSED, BROKEN, NO_YEAR))
    held = held.select("file", F.col("parsed_in").alias("load"))
    good, bad = judge(read.join(held, ["file", "load"], "left_semi"), several_files)
    return good.join(held, "file"), bad


def year_prints(spark: SparkSession, store: str, several_files: bool = False) -> DataFrame:
    """(year, print): a hash of the files each year's release consists of, to tell changed years by."""
    held = current(spark, store).filter(F.col("outcome").isin(PARSED, BROKEN) & F.col("year").isNotNull()).groupBy("year")
    files = F.array_join(F.array_sort(F.collect_list("hash")), ",") if several_files else F.min_by("hash", "file")
    return held.agg(F.sha2(files, 256).alias("print"))


def drop_superseded(spark: SparkSession, store: str) -> list[int]:
    """Delete the documents of loads that no file is read from any more; their numbers."""
    written = table(spark, f"{store}/parsed", "file string, load int").select("load").distinct()
    used = current(spark, store).filter(F.col("outcome") != GONE).select(F.col("parsed_in").alias("load"))
    old = sorted(r["load"] for r in written.join(used, "load", "left_anti").collect())
    for number in old:
        remove(spark, f"{store}/parsed/load={number}")
    return old


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
