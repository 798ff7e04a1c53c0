"""Embedding whitening: leading eigenvectors of the covariance by block Jacobi-Davidson on distributed centred products."""

from __future__ import annotations

from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, summed

GUARD = 4  #: vectors of the block beyond the wanted ones
BASIS = 4  #: blocks in the subspace before it is restarted from its best block
INNER = 10  #: MINRES steps for each correction equation, at most
INNER_FALL = 1e-2  #: fall of the correction equation's residual that is enough
OUTER = 500  #: rounds after which it gives up with an error
EDGE = 4e18  #: scaled components beyond it, either way, count as it
_EPS = np.finfo(np.float64).eps

Asked = Generator[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]


def minres(theta: np.ndarray, right: np.ndarray, project, inner: int = INNER) -> Asked:
    """Solves project (V - theta_i) project t_i = right_i for all columns at once; each step asks for one product with V."""
    size = np.linalg.norm(right, axis=0)
    live = np.maximum(size, 1e-300)
    x, w0, w1, v0, v = (np.zeros_like(right) for _ in range(5))
    v, g, eta = right / live, size, size.copy()
    c0, c1, s0, s1 = np.ones_like(size), np.ones_like(size), np.zeros_like(size), np.zeros_like(size)
    for _ in range(inner):
        got = project((yield v) - v * theta)
        d = (v * got).sum(0)
        after = project(got - d * v - g * v0 * (v0 != 0))
        h = np.linalg.norm(after, axis=0)
        a0 = c1 * d - c0 * s1 * g
        a1, a2, a3 = np.maximum(np.hypot(a0, h), 1e-300), s1 * d + c0 * c1 * g, s0 * g
        c0, c1, s0, s1 = c1, a0 / a1, s1, h / a1
        w0, w1 = w1, (v - a3 * w0 - a2 * w1) / a1
        x, eta = x + c1 * eta * w1, -s1 * eta
        v0, v, g = v, after / np.maximum(h, 1e-300), h
        if (np.abs(eta) <= INNER_FALL * size).all():
            break
    return x


def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Directions of new outside the others' spans, without those that depend on one another."""
    norm = np.linalg.norm(new, axis=0)
    new = new[:, norm > 0] / norm[norm > 0]
    for _ in range(2):
        for base in others:
            new = new - base @ (base.T @ new)
    left, size, _ = np.linalg.svd(new, full_matrices=False)
    new = left[:, size > 1e-10]
    for base in others:
        new = new - base @ (base.T @ new)
    return np.linalg.qr(new)[0]


def jacobi_davidson(dim: int, want: int) -> Asked:
    """(eigenvalues, vectors as columns) of the ``want`` largest eigenvalues of a symmetric positive semidefinite matrix V that is
    only known by its products: yields blocks, is sent V @ block. Rayleigh-Ritz on a growing subspace; the leading Ritz vectors are
    locked, in order, when their residuals are at the level of rounding; corrections of the others come from projected equations."""
    want, width = min(want, dim), min(dim, want + GUARD)
    rng = np.random.default_rng(dim)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    image = yield basis
    for _ in range(OUTER):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        rest = image - basis * theta
        rest -= locked @ (locked.T @ rest)
        scale = max(theta[0], *values[:1]) if len(values) else theta[0]
        least = want - len(values)
        good = np.linalg.norm(rest[:, :least], axis=0) <= 8 * _EPS * np.sqrt(dim) * max(scale, 0)
        ready = len(good) if good.all() or basis.shape[1] + len(values) == dim else int(np.argmin(good))  # a basis of the whole space is as exact as rounding lets it be
        locked, values = np.hstack([locked, basis[:, :ready]]), np.concatenate([values, theta[:ready]])
        basis, image, rest, theta = basis[:, ready:], image[:, ready:], rest[:, ready:], theta[ready:]
        least = want - len(values)
        if not least:
            break
        if basis.shape[1] > (BASIS - 1) * width:
            basis, image = basis[:, :width], image[:, :width]
        ritz = np.hstack([locked, basis[:, :least]])

        def project(block: np.ndarray, ritz=ritz) -> np.ndarray:
            return block - ritz @ (ritz.T @ block)

        found = yield from minres(theta[:least], project(-rest[:, :least]), project)
        new = _orthonormal(found, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((dim, 1)), locked, basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, (yield new)])
    else:
        raise RuntimeError(f"jacobi_davidson: residuals not down to rounding after {OUTER} rounds")
    locked = np.linalg.qr(locked)[0]
    small = locked.T @ (yield locked)
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    return theta[::-1], (locked @ turn)[:, ::-1]


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: as longs or, where these are too short, Python's integers."""
    if n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, sums), default=0) < 2**62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _squares(d: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None where no long holds it."""
    about = (d.astype(np.float64) ** 2).sum(1)
    safe = about < 9e18
    exact = (np.where(safe[:, None], d, 0).astype(np.int64) ** 2).sum(1).tolist()
    for k in np.nonzero(~safe & (about < 1e19))[0]:
        exact[k] = sum(int(v) ** 2 for v in d[k])
    return [v if a < 1e19 and v < 2**63 else None for v, a in zip(exact, about, strict=True)]


def _by_length(batch: pd.Series) -> Iterator[tuple[int, pd.Index, np.ndarray]]:
    for dim, part in batch.groupby(batch.map(len)):
        yield int(dim), part.index, np.stack(part.to_numpy()).astype(np.int64).reshape(len(part), int(dim))


def _totals(batches: Iterator[pd.DataFrame]) -> dict:
    """For each length the number of vectors and, as Python's integers, their sums."""
    total: dict = {}
    for batch in batches:
        for dim, _, x in _by_length(batch["x"]):
            exact = x if not x.size or len(x) * max(abs(int(x.min())), abs(int(x.max()))) < 2**62 else x.astype(object)
            for key, value in (((dim, "n"), len(x)), ((dim, "sums"), exact.sum(0).astype(object))):
                total[key] = total[key] + value if key in total else value
    return total


def _centred(known: dict):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [{"dim": dim, "y": (_deviations(x, *known[dim]).astype(np.float64) / known[dim][0]).tobytes()} for dim, _, x in _by_length(batch["x"])]
            yield pd.DataFrame(out, columns=["dim", "y"])

    return rows


def _over_blocks(blocks: DataFrame, of: dict) -> dict:
    """Sum over the fit list of of[dim](block of centred vectors)."""
    def partial(batches: Iterator[pd.DataFrame]) -> dict:
        total: dict = {}
        for batch in batches:
            for dim, y in zip(batch["dim"], batch["y"], strict=True):
                if dim in of:
                    value = of[dim](np.frombuffer(y, np.float64).reshape(-1, dim))
                    total[dim] = total[dim] + value if dim in total else value
        return total

    return summed(blocks, partial)


def fit(vectors: DataFrame, components: int) -> dict[int, dict]:
    """For each vector length of the integer vectors (column x): n, sums, eigenvalues, axes, trace and identity error of the
    distinct ones. The covariance is never formed; each product is one pass over the written centred vectors."""
    distinct = materialize(vectors.select("x").where("size(x) > 0").distinct(), "distinct-vectors")
    totals = summed(distinct, _totals)
    known = {dim: (totals[dim, "n"], totals[dim, "sums"]) for dim, kind in totals if kind == "n"}
    blocks = materialize(distinct.mapInPandas(_centred(known), "dim int, y binary"), "centred-blocks")
    trace = {d: float(v) / known[d][0] for d, v in _over_blocks(blocks, {d: lambda y: (y * y).sum() for d in known}).items()}
    running, asked, solved = {d: jacobi_davidson(d, components) for d in known if trace[d] > 0}, {}, {}
    for d, steps in running.items():
        asked[d] = next(steps)
    while asked:
        got = _over_blocks(blocks, {d: lambda y, b=b, n=known[d][0]: y.T @ ((y @ b) / n) for d, b in asked.items()})
        for d in list(asked):
            try:
                asked[d] = running[d].send(got[d])
            except StopIteration as done:
                solved[d] = done.value
                del asked[d]
    for d, (values, axes) in solved.items():
        real = values > 16 * _EPS * d * values[0]  # below, the direction is rounding alone and has no scale to divide by
        solved[d] = values[real], axes[:, real] / np.sqrt(values[real])
    means = _over_blocks(blocks, {d: lambda y, a=a: (y @ a).sum(0) for d, (_, a) in solved.items()})
    means = {d: m / known[d][0] for d, m in means.items()}
    second = _over_blocks(blocks, {d: lambda y, a=a, m=means[d]: (y @ a - m).T @ (y @ a - m) for d, (_, a) in solved.items()})
    error = {d: float(np.abs(s / known[d][0] - np.eye(len(s))).max()) for d, s in second.items()}
    return {d: {"n": known[d][0], "sums": known[d][1], "axes": a, "explained": (v / trace[d]).tolist(), "error": error[d]} for d, (v, a) in solved.items()}


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and leading principal component.

    A component c of a vector counts as floor(scale * c) + shift. Fitted on the distinct vectors: n of them with sums S per
    dimension. deviation is the exact sum of (n * x - S)^2, null where no long holds it.

    Vectors of each length are a table of their own, all fitted in the same passes. Null vectors and vectors with null or non-finite
    components are left out; so are empty ones, and lengths whose vectors are all equal, which have no direction to scale. Directions
    without variance are no components, so there may be fewer than asked for. Rows repeated, or with repeated or null ids, are each
    returned. Scaled components beyond 4e18 count as that. Empty table: empty result. Other columns are not read.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    real = F.coalesce(F.expr("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"), F.lit(False))
    whole = F.expr(f"transform(vec, x -> floor(greatest(least({int(scale)} * x, {EDGE!r}D), {-EDGE!r}D)) + {int(shift)}L)")
    rows = materialize(base.where(real).select("id", whole.alias("x")), "integer-vectors")
    fitted = fit(rows, components)

    @F.pandas_udf("struct<deviation:long,whitened:array<double>>")
    def turned(x: pd.Series) -> pd.DataFrame:
        deviation, whitened = np.full(len(x), None, object), np.full(len(x), None, object)
        for dim, at, block in _by_length(x.reset_index(drop=True)):
            f = fitted[dim]
            d = _deviations(block, f["n"], f["sums"])
            deviation[at] = _squares(d)
            for k, row in zip(at, (d.astype(np.float64) / f["n"]) @ f["axes"], strict=True):
                whitened[k] = row
        return pd.DataFrame({"deviation": pd.array(deviation, "Int64"), "whitened": whitened})

    spark = vectors.sparkSession
    facts = spark.createDataFrame([(d, f["n"], f["explained"], f["error"]) for d, f in fitted.items()], "dim int, n long, explained array<double>, identity_error double")  # a row for each length
    out = rows.withColumn("dim", F.size("x")).join(F.broadcast(facts), "dim").withColumn("of", turned("x"))
    out = out.select("id", "n", "explained", "identity_error", "of.deviation", F.posexplode("of.whitened").alias("at", "whitened"))
    return out.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.expr("explained[at]").alias("explained"), "identity_error")
