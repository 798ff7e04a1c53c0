"""Shared helpers: table access, written intermediate tables, folds, connected components."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, with as many underscores behind it as make it no column of df (Spark compares names without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a local session (tests) that sets none gets a temporary
    one, any other must set it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def short_batches(spark: SparkSession, rows: int = 500) -> None:
    """Sends Python workers at most so many rows at once: a batch of whole texts is held several times over (Arrow, Python, numpy), on
    either side of the socket, and workers keep the memory of their largest batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def materialize(df: DataFrame, name: str = "part", by: tuple[str, ...] = ()) -> DataFrame:
    """Write df to the shared folder, partitioned by the columns ``by``, and read it back: later plans start here, and a lost
    executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove_written(df: DataFrame) -> None:
    """Deletes the files of a materialized table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.written_to)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def numbered(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """df in the order of these columns, each row with its place from 0 on, without gaps; written. Only the row counts of the
    partitions pass through the driver."""
    part, at = fresh(df, "_part"), fresh(df, "_at")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))}), "numbered")
    before, offsets = 0, []
    for r in ranged.groupBy(part).count().orderBy(part).collect():
        offsets.append((r[part], before))
        before += r["count"]
    starts = df.sparkSession.createDataFrame(offsets, f"{part} int, {name} long")  # a row for each partition
    return ranged.join(F.broadcast(starts), part).withColumn(name, F.col(name) + F.col(at)).drop(part, at)


#: Most partial results that the driver adds up; of more partitions, groups are added up by tasks before.
PARTIALS = 64


def summed(df: DataFrame, partial: Callable[[Iterator[pd.DataFrame]], dict]) -> dict:
    """Adds up what ``partial`` makes of each partition: a dict of numbers, arrays or other things that add, of a size that does not
    grow with the rows. The order of additions is that of the partitions."""
    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = partial(batches)
        yield pd.DataFrame([{"at": TaskContext.get().partitionId(), "got": pickle.dumps(got)}])

    def added(blobs: list[bytes]) -> dict:
        total: dict = {}
        for blob in blobs:
            for key, value in pickle.loads(blob).items():
                total[key] = total[key] + value if key in total else value
        return total

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        return pd.DataFrame([{"at": rows["at"].iloc[0], "got": pickle.dumps(added(list(rows["got"])))}])

    parts, n = df.mapInPandas(made, "at int, got binary"), df.rdd.getNumPartitions()
    while n > PARTIALS:
        n = -(-n // PARTIALS)
        parts = parts.groupBy((F.col("at") % n).alias("_to")).applyInPandas(merged, "at int, got binary")
    return added([bytes(r["got"]) for r in sorted(parts.collect(), key=lambda r: r["at"])])


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def _edge_state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); root is the smallest node reachable.

    Alternates large-star and small-star steps, written to the shared folder after each round, until the edges stand still.
    A hub's edges meet in minima with partial aggregation and in joins on the hub. The minima are written first, so these joins
    have a shuffle of their own on either side and adaptive execution splits the hub's; no task or driver holds a component.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = materialize(ordered(edges.select("u", "v")), "edges")
    state = _edge_state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        before, edges = edges, materialize(ordered(small), "edges")
        for done in (before, least, large, low):
            remove_written(done)
        was, state = state, _edge_state(edges)
        if state == was:
            break
    else:
        raise RuntimeError(f"connected_components: not settled after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
