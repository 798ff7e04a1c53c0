"""Exact top-k search by integer inner product: vectors by descending length, partial sums on rotated axes, Cauchy-Schwarz bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered, summed

TILE = 1024  #: candidates compared at a time
GROUP = 8 * TILE  #: neighbours by length that one task gets as candidates
SPAN = 50 * TILE  #: neighbours by length whose queries one task gets
SUB = 512  #: queries compared at a time
STEPS = (8, 16, 32, 48)  #: leading axes after which the bound is taken
AXES_BYTES = 64 << 20  #: most memory for rotations; lengths beyond it keep their own axes, which bounds less well but as rightly
SALT = 2000  #: groups of candidates on one key of the join that finds pairs of groups
_LEAST = -(2**63) + 1
_SLACK = 1e-5  #: of the product of two lengths, above the rounding of single-precision sums

_FOUND = "dim int, part long, query long, query_id long, n_query double, unnamed boolean, vec_id long, row long, score long"


def _packed(x: np.ndarray) -> dict:
    """Integer vectors in the narrowest type that holds them."""
    kind = next(k for k in ("i2", "i4", "i8") if not x.size or np.iinfo(k).min < x.min() and x.max() <= np.iinfo(k).max)
    return {"kind": kind, "ints": np.ascontiguousarray(x, dtype=kind).tobytes()}


def rotations(rows: DataFrame, lengths: list) -> dict[int, np.ndarray]:
    """Right singular vectors of the table by falling singular value, for each vector length as far as AXES_BYTES goes."""
    chosen, left = {}, AXES_BYTES
    for r in sorted(lengths, key=lambda r: -r["count"]):
        if 0 < 8 * r["dim"] ** 2 <= left:
            chosen[r["dim"]], left = r["count"], left - 8 * r["dim"] ** 2

    def moments(batches: Iterator[pd.DataFrame]) -> dict[int, np.ndarray]:
        total = {d: np.zeros((d, d)) for d in chosen}
        for batch in batches:
            for d, part in batch.groupby(batch["x"].map(len))["x"]:
                x = np.stack(part.to_numpy()).astype(np.float64) / float(np.sqrt(chosen[d]))
                total[d] += x.T @ x
        return total

    sums = summed(rows.where(F.col("dim").isin([int(d) for d in chosen])).select("x"), moments) if chosen else {}
    return {d: np.linalg.eigh(m)[1][:, ::-1].astype(np.float32) if np.isfinite(m).all() else np.eye(d, dtype=np.float32) for d, m in sums.items()}


def _blocks(axes: dict[int, np.ndarray]):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        """One row for a run of vectors, longest first: integers, rotated coordinates, lengths, ids."""
        rows = rows.sort_values("pos")
        dim = int(rows["dim"].iloc[0])
        x = np.stack(rows["x"].to_numpy()).astype(np.int64).reshape(len(rows), dim)
        y = x.astype(np.float32)
        size = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        made = {"dim": dim, "part": rows["part"].iloc[0], "n": len(rows), "top": float(size.max()), **_packed(x), "turned": (y @ axes[dim] if dim in axes else y).tobytes()}
        return pd.DataFrame([made | {k: rows[k].to_numpy(t).tobytes() for k, t in (("id", "i8"), ("unnamed", "?"), ("row", "i8"))}])

    return block


_BLOCK = "dim int, part long, n int, top double, kind string, ints binary, turned binary, id binary, unnamed binary, row binary"


class _Side:
    """The vectors of one block."""

    def __init__(self, b, steps: list[int]) -> None:
        self.x = np.frombuffer(b.ints, b.kind).reshape(b.n, b.dim)
        self.y = np.frombuffer(b.turned, np.float32).reshape(b.n, b.dim)
        self.id, self.unnamed, self.row = (np.frombuffer(getattr(b, k), t) for k, t in (("id", "i8"), ("unnamed", "?"), ("row", "i8")))
        square = self.y.astype(np.float64) ** 2
        self.size = np.sqrt((self.x.astype(np.float64) ** 2).sum(1))
        self.rest = {k: np.sqrt(square[:, k:].sum(1)) for k in steps}


def _open_pairs(q: _Side, at: np.ndarray, c: _Side, cols: np.ndarray, least: np.ndarray, steps: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of queries ``at`` and candidates ``cols`` whose product may reach the query's least score."""
    done, sums = 0, np.zeros((len(at), len(cols)), np.float32)
    least = np.where(least > _LEAST, least, -np.inf)
    for k in steps:
        sums += q.y[at, done:k] @ c.y[cols, done:k].T
        bound = sums + np.outer(q.rest[k][at], c.rest[k][cols]) + _SLACK * np.outer(q.size[at], c.size[cols])
        may = bound >= least[at][:, None]
        rows, columns = may.any(1), may.any(0)
        if not rows.any():
            return at[:0], cols[:0]
        at, cols, sums, may, done = at[rows], cols[columns], sums[np.ix_(rows, columns)], may[np.ix_(rows, columns)], k
    r, s = np.nonzero(may) if steps else np.indices(sums.shape).reshape(2, -1)
    return at[r], cols[s]


def _products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of rows, exact; what no long holds counts as the largest or smallest one."""
    if bound < 2**53:  # then no sum or product rounds
        return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
    found = (a.astype(object) * b.astype(object)).sum(1)
    return np.array([max(_LEAST, min(-_LEAST, int(v))) for v in found], np.int64)


def _scan(q: _Side, c: _Side, k: int, least: np.ndarray, steps: list[int]) -> dict[str, np.ndarray]:
    """The k best candidates of each query, of those that reach its least score."""
    best = {n: np.zeros(0, t) for n, t in (("q", "i8"), ("score", "i8"), ("unnamed", "?"), ("id", "i8"), ("row", "i8"))}
    least, tiles = least.copy(), [np.arange(t, min(t + TILE, len(c.size))) for t in range(0, len(c.size), TILE)]
    for low in range(0, len(q.size), SUB):
        sub = np.arange(low, min(low + SUB, len(q.size)))
        for cols in tiles:
            at = sub[q.size[sub] * c.size[cols].max() * (1 + 1e-9) >= least[sub]]
            if not len(at):
                break  # what follows is shorter
            at, cols = _open_pairs(q, at, c, cols, least, steps)
            for piece in range(0, len(at), 1 << 18):
                r, s = at[piece : piece + (1 << 18)], cols[piece : piece + (1 << 18)]
                score = _products(q.x[r], c.x[s], float((q.size[r] * c.size[s]).max()))
                good = (score >= least[r]) & (q.row[r] != c.row[s])
                new = {"q": r[good], "score": score[good], "unnamed": c.unnamed[s[good]], "id": c.id[s[good]], "row": c.row[s[good]]}
                both = {n: np.concatenate([best[n], new[n]]) for n in best}
                order = np.lexsort((both["row"], both["id"], both["unnamed"], -both["score"], both["q"]))
                both = {n: v[order] for n, v in both.items()}
                first = np.searchsorted(both["q"], both["q"])
                rank = np.arange(len(first)) - first
                last = rank == k - 1
                least[both["q"][last]] = np.maximum(least[both["q"][last]], both["score"][last])
                best = {n: v[rank < k] for n, v in both.items()}
    return best


def _cell(k: int):
    def cell(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({n.split()[0]: [] for n in _FOUND.split(", ")})
        b = next(queries.itertuples())
        steps = sorted({s for s in STEPS if s < b.dim} | {b.dim} - {0})
        q, c = _Side(b, steps), _Side(next(candidates.itertuples()), steps)
        known = {x["query"]: x["least"] for x in (b.known if b.known is not None else [])}
        found = _scan(q, c, k, np.array([known.get(r, _LEAST) for r in q.row.tolist()], np.int64), steps)
        of = found["q"]
        return pd.DataFrame({"dim": b.dim, "part": b.part, "query": q.row[of], "query_id": q.id[of], "n_query": q.size[of], "unnamed": found["unnamed"], "vec_id": found["id"], "row": found["row"], "score": found["score"]})

    return cell


def top_products(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query with all rows but itself, ties to the
    smaller id. Components x count as floor(scale * x); queries are the rows whose id is divisible by ``every``.

    All rows are numbered by length of vector and falling norm. Runs of GROUP neighbours are candidates, the queries of SPAN
    neighbours a block. Each block meets the longest candidates first, which gives its queries a score to reach; after that it is
    sent only to runs whose longest vector can reach it. There, tile by tile in descending length, coordinates on the singular
    vectors are summed step by step and a pair is dropped when partial sum plus residual norms stay below the score (with room for
    rounding). What is left is multiplied as integers.

    Vectors score with vectors of their own length only. Null vectors, vectors with null or non-finite components take no part;
    empty ones score 0 with one another. A null id is no query; as candidate it comes after all ids in a tie. Rows that repeat an id
    or a whole row are rows of their own, as query and as candidate. A query without candidates gives no rows. A scaled component
    beyond a long counts as the nearest one, and so does a score (before ranking). Empty table: empty result. Other columns are not read.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fit = F.coalesce(F.expr("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"), F.lit(False))
    ints = base.where(fit).select("id", F.expr(f"transform(vec, x -> floor({int(scale)} * x))").alias("x"))
    rows = ints.select(
        F.monotonically_increasing_id().alias("row"), F.col("id").isNull().alias("unnamed"), F.coalesce("id", F.lit(2**63 - 1)).alias("id"),
        F.size("x").alias("dim"), F.expr("-aggregate(x, 0D, (s, v) -> s + double(v) * v)").alias("less"), "x", F.coalesce(F.col("id") % every == 0, F.lit(False)).alias("asks"),
    )
    rows = materialize(rows, "integer-vectors")
    axes = rotations(rows, rows.groupBy("dim").count().collect())
    placed = numbered(rows, ["dim", "less", "row"])
    keep = ["dim", "part", "pos", "row", "id", "unnamed", "x"]
    candidates = placed.withColumn("part", F.expr(f"pos div {GROUP}")).select(*keep).groupBy("dim", "part").applyInPandas(_blocks(axes), _BLOCK)
    candidates = materialize(candidates, "candidate-runs")
    queries = placed.where("asks").withColumn("part", F.expr(f"pos div {SPAN}")).select(*keep).groupBy("dim", "part").applyInPandas(_blocks(axes), _BLOCK)
    queries = materialize(queries, "query-runs")

    def scored(pairs: DataFrame, asked: DataFrame) -> DataFrame:
        """pairs: (dim, part, to) of blocks of queries and runs of candidates."""
        left = pairs.join(asked, ["dim", "part"])
        right = pairs.join(candidates.withColumnRenamed("part", "to"), ["dim", "to"]).withColumnsRenamed({"dim": "of", "part": "from", "to": "with"})
        cells = left.groupBy("dim", "part", "to").cogroup(right.withColumn("dim", F.col("of")).groupBy("of", "from", "with"))
        return cells.applyInPandas(_cell(k), _FOUND)

    known = "array<struct<query:long,least:long>>"
    longest = candidates.groupBy("dim").agg(F.min("part").alias("to"))
    first = queries.select("dim", "part").join(longest, "dim")
    started = materialize(scored(first, queries.withColumn("known", F.lit(None).cast(known))), "first-scores")
    reached = started.groupBy("dim", "part", "query").agg(F.count("*").alias("n"), F.min("score").alias("least"), F.max("n_query").alias("size")).where(F.col("n") == k)
    need = F.when(F.col("size") > 0, F.col("least") / F.col("size")).otherwise(-1.0)
    reached = reached.groupBy("dim", "part").agg(F.collect_list(F.struct("query", "least")).alias("known"), F.min(need).alias("need"), F.count("*").alias("ready"))
    asked = queries.join(reached, ["dim", "part"], "left")
    least = F.when(F.col("ready") == F.col("n"), F.col("need") - 1e-9 * F.abs("need")).otherwise(-1.0)
    salts = -(-candidates.count() // SALT) or 1
    runs = candidates.select("dim", F.col("part").alias("to"), "top", F.pmod(F.xxhash64("dim", "part"), F.lit(salts)).alias("salt"))
    wanted = asked.select("dim", "part", least.alias("need"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    others = wanted.join(runs, ["dim", "salt"]).where("top >= need").select("dim", "part", "to").join(first, ["dim", "part", "to"], "left_anti")
    rest = scored(materialize(others, "run-pairs"), asked.drop("need", "ready"))
    rank = F.expr("row_number() OVER (PARTITION BY query ORDER BY score DESC, unnamed, vec_id, row)")
    best = started.unionAll(rest).withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int"), F.when(~F.col("unnamed"), F.col("vec_id")).alias("vec_id"), "score")
