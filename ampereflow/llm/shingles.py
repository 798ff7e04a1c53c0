"""Links between texts whose shingle sets have a Jaccard similarity at or above a threshold: candidates from min-hash bands, each
confirmed on the sets themselves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: A pair of similarity s shares a band with probability 1 - (1 - s ** ROWS) ** BANDS: 0.99 at 0.8, 0.09 at 0.5, 0.002 at 0.3.
BANDS, ROWS = 24, 8
SIMILAR = 0.8
PARTS = 4
_draw = np.random.default_rng(64)
_FACTORS = _draw.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * 2 + 1
_SHIFTS = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """Signed keys of the bands of a set of shingle hashes (uint64, not empty)."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[at : at + 2048, None] * _FACTORS + _SHIFTS).min(0))
    return [xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63) for x in least.reshape(BANDS, ROWS)]


def set_of(hashes: np.ndarray) -> bytes:
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32)).tobytes()


def similar(a: bytes, b: bytes, threshold: float) -> bool:
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    if not len(x) or not len(y):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= threshold * (len(x) + len(y) - both)


def similar_edges(nodes: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """Edges (u, v) between nodes (node, n, bands, shingles: the set and its size) whose sets are similar.

    Nodes that share a band are compared with the band's least and greatest node and with those of one of PARTS parts of its nodes,
    drawn anew for each band: of up to three nodes all pairs, of more some for every band that they share, never all pairs of a group.
    Sets of too unlike sizes are left out before they are sent; the others are confirmed one by one.
    """
    entries = nodes.where("n > 0").select("node", "n", F.posexplode("bands").alias("band", "key"))
    entries = entries.withColumn("part", F.pmod(F.xxhash64("node", "band"), F.lit(PARTS)))
    parts = entries.groupBy("band", "key", "part").agg(F.min(F.struct("node", "n")).alias("low"), F.max(F.struct("node", "n")).alias("high"), F.count("*").alias("m"))
    parts = materialize(parts, "parts")
    whole = parts.groupBy("band", "key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("m").alias("m")).where("m > 1")
    leaders = materialize(parts.select("band", "key", "part", F.col("low").alias("low_part"), F.col("high").alias("high_part")).join(whole.drop("m"), ["band", "key"]), "leaders")
    pairs = entries.join(leaders, ["band", "key", "part"]).select("node", "n", F.explode(F.array("low", "high", "low_part", "high_part")).alias("o"))
    pairs = pairs.where(F.col("o.node") != F.col("node")).where(F.least("n", "o.n") >= threshold * F.greatest("n", "o.n"))
    pairs = materialize(pairs.select(F.greatest("node", "o.node").alias("u"), F.least("node", "o.node").alias("v")).distinct(), "candidates")
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = materialize(nodes.select("node", "shingles").join(wanted, "node", "left_semi"), "candidate-sets")
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")

    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = [similar(a, b, threshold) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch.loc[good, ["u", "v"]]

    return both.select("u", "v", "a", "b").mapInPandas(confirmed, "u long, v long")
