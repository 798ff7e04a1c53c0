"""Which sources are new or changed, told from file listings and footers before any row is read.

A source is a file or a folder of files. The manifest holds, for every file that was processed, its path, size and time, and for its
source the number of rows and a hash of the schema. It is a Parquet folder to which each run appends; the last entry of a path holds.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from .landing import named_by_file

MANIFEST = "source_table string, path string, length long, modified timestamp, n_rows long, schema_hash string, run long"
_STAT = ["path", "length", "modified"]


def source_name(path, by: str = "file"):
    """Name of the source that a file belongs to: its own name without ending, or that of its folder (of name=value the value)."""
    pattern = {"file": r"([^/]+?)(\.[A-Za-z0-9.]+)?$", "folder": r"([^/=]+)/[^/]+$"}[by]
    return S.safe_ident(F.regexp_extract(F.url_decode(path), pattern, 1))


def list_sources(spark: SparkSession, root: str, by: str = "file", pattern: str | None = None) -> DataFrame:
    """(source_table, path, length, modified) of the files below root. No file is opened: only the listing is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    return files.select(source_name(F.col("path"), by).alias("source_table"), "path", "length", F.col("modificationTime").alias("modified"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each path; empty where there is no manifest yet."""
    schema = T.StructType.fromDDL(MANIFEST)
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    last = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("run")))
    return rows.withColumn("_n", last).where("_n = 1").drop("_n")


def new_sources(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of the sources of which the manifest knows no file."""
    return listing.join(manifest.select("source_table").distinct(), "source_table", "left_anti")


def touched_sources(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """All files of the sources that have a file which is new, of another size or time, or that have lost one."""
    moved = listing.join(manifest.select(*_STAT), _STAT, "left_anti").select("source_table")
    gone = manifest.join(listing.select("path"), "path", "left_anti").select("source_table")
    return listing.join(moved.union(gone).distinct(), "source_table", "left_semi")


def read_sources(spark: SparkSession, files: DataFrame, schema: T.StructType, fmt: str = "parquet", by: str = "file", **options) -> DataFrame:
    """Rows of these files only, with source_table; the scan lists nothing else. Paths, never rows, pass through the driver."""
    paths = sorted(r["path"] for r in files.select("path").distinct().collect())
    if not paths:
        return spark.createDataFrame([], T.StructType([T.StructField("source_table", T.StringType()), *schema.fields]))
    rows = spark.read.format(fmt).schema(schema).options(**options).load(paths).select(*schema.names, F.col("_metadata.file_path").alias("_path"))
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("_path"))
    return named_by_file(rows, source_name(F.col("_path"), by), "_path", listed).drop("_path")


def facts(spark: SparkSession, files: DataFrame, by: str = "file") -> DataFrame:
    """(source_table, n_rows, schema_hash) of Parquet sources: row counts come from the footers, as no column is read, and the schema
    of a source from the footer of its last file by name."""
    found = files.groupBy("source_table").agg(F.collect_list("path").alias("paths"), F.max("path").alias("last")).collect()
    none = T.StructType.fromDDL("source_table string, n_rows long, schema_hash string")
    if not found:
        return spark.createDataFrame([], none)
    shapes = [(r["source_table"], hashlib.sha256(spark.read.parquet(r["last"]).schema.simpleString().encode()).hexdigest()) for r in found]
    rows = spark.read.schema(T.StructType()).parquet(*[p for r in found for p in r["paths"]])
    files = rows.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count("*").alias("n"))
    name = F.coalesce(source_name(F.col("_path"), by), F.lit(""))  # made for each file: as it is never null, the join below tests no row for that
    counts = files.groupBy(name.alias("source_table")).agg(F.sum("n").alias("n_rows"))
    known = spark.createDataFrame(shapes, "source_table string, schema_hash string")  # a row for each source
    return known.join(counts, "source_table", "left").select("source_table", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "schema_hash")


def changed_sources(spark: SparkSession, listing: DataFrame, manifest: DataFrame, by: str = "file") -> tuple[DataFrame, DataFrame]:
    """(changed, same): files of touched sources whose row count or schema differs from the manifest, with these facts, and of those
    that were only copied or touched. Footers are read for touched sources alone."""
    touched = touched_sources(listing, manifest)
    told = touched.join(facts(spark, touched, by), "source_table")
    known = manifest.select("source_table", "n_rows", "schema_hash").distinct()
    keys = ["source_table", "n_rows", "schema_hash"]
    return told.join(known, keys, "left_anti").select(*told.columns), told.join(known, keys, "left_semi").select(*told.columns)


def record(told: DataFrame, path: str, run: int) -> None:
    """Appends processed files (with n_rows and schema_hash) under the number of the run; a run repeated replaces its own entries."""
    rows = told.select("source_table", *_STAT, "n_rows", "schema_hash", F.lit(run).cast("long").alias("run"))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={run}")


def import_new(spark: SparkSession, root: str, manifest_path: str, schema: T.StructType, run: int, by: str = "file") -> tuple[DataFrame, DataFrame]:
    """(rows, told): the rows of new and changed Parquet sources below root, and the files to record once they are imported."""
    changed, same = changed_sources(spark, list_sources(spark, root, by, "*.parquet"), read_manifest(spark, manifest_path), by)
    return read_sources(spark, changed, schema, by=by), changed.unionByName(same)
