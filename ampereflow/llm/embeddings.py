"""Embedding near-dedup: PCA-ordered tiles, compared leading dimensions first and dropped when cosine cannot reach the threshold."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize

TILE = 1024  #: most vectors in a tile
LEAD = 4  #: leading components whose ranges prune pairs of tiles
STEPS = (8, 16, 32)  #: dimensions after which the bound is taken
CELL = 3  #: neighbouring tiles (1 << CELL) on either side that one task compares at a time, so that a tile is not sent for each pair
GRID = 2000  #: tiles on either side of a join cell, so that a label of any size is spread over many
_SLACK = 1e-9


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Axes (columns, by falling variance) of the normalised vectors' second moments: a dim x dim sum of the whole table."""
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = np.stack(batch["vec"].to_numpy()).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pd.DataFrame({"at": np.arange(dim), "row": list(total)})

    rows = vectors.select("vec").mapInPandas(moments, "at int, row array<double>").select("at", F.posexplode("row").alias("to", "x")).groupBy("at", "to").agg(F.sum("x").alias("x")).collect()
    second = np.zeros((dim, dim))
    for r in rows:
        second[r["at"], r["to"]] = r["x"]
    return np.linalg.eigh(second)[1][:, ::-1]


def _cut(dim: int, axes: np.ndarray, tile: int, kind: str):
    """Rows sorted by (label, first component) -> tiles of at most ``tile`` rows of one label, with the range of leading components."""
    lead = min(LEAD, dim)

    def made(label, rows: list, number: int, part: int) -> dict:
        x = np.stack([r[1] for r in rows]).astype(np.float64)
        y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes[:, :lead]
        return {"label": label, "tile": (part << 32) + number, "ids": [r[0] for r in rows], "copies": [r[2] for r in rows], "vecs": x.astype(kind).tobytes(), "low": y.min(0).tolist(), "high": y.max(0).tolist()}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, label, rows = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            out = []
            for lab, node, vec, copies in zip(batch["label"], batch["node"], batch["vec"], batch["copies"], strict=True):
                if rows and (lab != label or len(rows) == tile):
                    out.append(made(label, rows, number, part))
                    number, rows = number + 1, []
                label = lab
                rows.append((node, vec, copies))
            if out:
                yield pd.DataFrame(out)
        if rows:
            yield pd.DataFrame([made(label, rows, number, part)])

    return cut


def _compare(dim: int, axes: np.ndarray, threshold: float, kind: str):
    steps = [*(k for k in STEPS if k < dim), dim]

    def turned(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(blob, dtype=kind).reshape(-1, dim).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return x, x @ axes

    def pairs(xa, ya, xb, yb) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and the matrix of links among them."""
        rows, cols, done = np.arange(len(ya)), np.arange(len(yb)), 0
        products = np.zeros((len(rows), len(cols)))
        for k in steps[:-1]:
            products += ya[rows, done:k] @ yb[cols, done:k].T
            rest = np.outer(np.linalg.norm(ya[rows, k:], axis=1), np.linalg.norm(yb[cols, k:], axis=1))
            open_ = products + rest >= threshold - _SLACK
            r, c = open_.any(1), open_.any(0)
            if not r.any():
                return rows[:0], cols[:0], np.zeros((0, 0), dtype=bool)
            rows, cols, products, done = rows[r], cols[c], products[np.ix_(r, c)], k
        return rows, cols, xa[rows] @ xb[cols].T >= threshold

    def links(ta: tuple, tb: tuple, same: bool) -> pd.DataFrame | None:
        rows, cols, near = pairs(*ta[2:], *tb[2:])
        if not len(rows):
            return None
        ia, ib, na, nb = ta[0][rows], tb[0][cols], ta[1][rows], tb[1][cols]
        if same:
            near &= ia[:, None] != ib[None, :]
        if not near.any():
            return None
        la, lb, top = ia.copy(), ib.copy(), np.iinfo(np.int64).max
        while True:
            ma = np.minimum(la, np.where(near, lb[None, :], top).min(1))
            mb = np.minimum(lb, np.where(near, ma[:, None], top).min(0))
            if (ma == la).all() and (mb == lb).all():
                break
            la, lb = ma, mb
        out = pd.DataFrame({"node": ia, "links": near @ nb, "root": la})
        if not same:
            out = pd.concat([out, pd.DataFrame({"node": ib, "links": near.T @ na, "root": lb})])
        return out[out["links"] > 0]

    def compare(near: pd.DataFrame, tiles: pd.DataFrame) -> pd.DataFrame:
        """The pairs of tiles of one cell; each of its tiles is turned once."""
        made = {t: (np.asarray(ids), np.asarray(copies), *turned(vecs)) for t, ids, copies, vecs in zip(tiles["tile"], tiles["ids"], tiles["copies"], tiles["vecs"], strict=True)}
        out = [links(made[a], made[b], a == b) for a, b in zip(near["tile_a"], near["tile_b"], strict=True)]
        out = [x for x in out if x is not None and len(x)]
        return pd.concat(out) if out else pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})

    return compare


def _links(nodes: DataFrame, dim: int, threshold: float, tile: int, kind: str) -> DataFrame:
    """(node, links, root) of the links among nodes (node, vec, label, copies) whose vectors all have dim components."""
    axes = principal_axes(nodes, dim)
    first = F.expr("aggregate(zip_with(vec, array(%s), (x, y) -> x * y), 0D, (s, x) -> s + x) / sqrt(aggregate(vec, 0D, (s, x) -> s + double(x) * x))" % ", ".join(f"{x!r}D" for x in map(float, axes[:, 0])))
    tiles = nodes.select("label", "node", "vec", "copies").withColumn("first", first).repartitionByRange("label", "first").sortWithinPartitions("label", "first")
    schema = f"label {dict(nodes.dtypes)['label']}, tile long, ids array<long>, copies array<long>, vecs binary, low array<double>, high array<double>"
    tiles = materialize(tiles.select("label", "node", "vec", "copies").mapInPandas(_cut(dim, axes, tile, kind), schema), "tiles")
    reach = 2 * (1 - threshold) + 1e-9  # squared distance of unit vectors at the threshold
    box = " + ".join(f"power(greatest(0, a.low[{k}] - b.high[{k}], b.low[{k}] - a.high[{k}]), 2)" for k in range(min(LEAD, dim)))
    narrow = tiles.select("label", "tile", "low", "high")
    grid = max(1, -(-narrow.count() // GRID))
    own, every = F.pmod(F.xxhash64("tile"), F.lit(grid)), F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    a, b = narrow.select("*", own.alias("row"), every.alias("col")), narrow.select("*", own.alias("col"), every.alias("row"))
    near = a.alias("a").join(b.alias("b"), F.expr(f"a.label = b.label AND a.row = b.row AND a.col = b.col AND a.tile <= b.tile AND {box} <= {reach!r}"))
    near = near.select(F.expr(f"shiftright(a.tile, {CELL})").alias("cell_a"), F.expr(f"shiftright(b.tile, {CELL})").alias("cell_b"), F.col("a.tile").alias("tile_a"), F.col("b.tile").alias("tile_b"))
    near = materialize(near, "tile-pairs")
    sent = near.select(F.col("cell_a").alias("to_a"), F.col("cell_b").alias("to_b"), F.explode(F.array("tile_a", "tile_b")).alias("tile")).distinct().join(tiles.select("tile", "ids", "copies", "vecs"), "tile")
    work = near.groupBy("cell_a", "cell_b").cogroup(sent.groupBy("to_a", "to_b")).applyInPandas(_compare(dim, axes, threshold, kind), "node long, links long, root long")
    return materialize(work, "links")


def embedding_near_dups(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """One row per vector: id, n_links (other vectors of its label with cosine >= threshold), component_id, kept.

    Every pair within a label is covered: equal vectors are one node with its number of copies; nodes sorted by label and first
    principal component form tiles; pairs of tiles whose ranges in the leading components are too far apart are skipped; the
    others are compared as matrices, a few neighbouring tiles with a few others at a time. A tile pair returns sums and a spanning
    star per local component, never its pairs. Components that are double are compared as such.

    Vectors of different lengths do not link; each length that two or more vectors have gets axes and tiles of its own. Null, zero,
    non-finite vectors, those with null components, or with a null label or id link with nothing. Rows repeated under one id count
    as vectors of their own and share component and links. Empty table: empty result.
    """
    wide = vectors.schema[vec_col].dataType.elementType.simpleString() not in ("float", "tinyint", "smallint")
    element, kind = ("double", "f8") if wide else ("float", "f4")
    base = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast(f"array<{element}>").alias("vec"), F.col(label_col).alias("label"))
    fit = F.coalesce(F.expr("id IS NOT NULL AND label IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x <> 0)"), F.lit(False))
    rows = base.withColumn("fit", fit)
    nodes = rows.where("fit").groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sizes = nodes.groupBy(F.size("vec").alias("dim")).count().orderBy("dim").collect()
    lone = rows.where("NOT fit").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    parts = [_links(nodes.where(F.size("vec") == r["dim"]), r["dim"], threshold, tile, kind) for r in sizes if r["count"] > 1]
    found = reduce(DataFrame.unionAll, parts, nodes.limit(0).select("node", F.col("copies").alias("links"), F.col("node").alias("root")))
    comp = connected_components(found.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "least", "copies").join(links, "node", "left").join(comp, "node", "left")
    named = named.select("node", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    first = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(nodes.select("node", "label", "vec").join(named.join(first, "root").select("node", "n_links", "component_id"), "node"), "named")
    linked = rows.where("fit").join(named, ["label", "vec"]).select("id", "n_links", "component_id")
    return linked.unionAll(lone).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
