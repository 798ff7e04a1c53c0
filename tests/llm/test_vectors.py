"""Top-k search and whitening against brute force."""

import math

import numpy as np
import pytest

from ampereflow.llm import common, topk, whitening

SF = "/root/testdata/sf0.001"
NAN, INF = math.nan, math.inf
LIMIT = 2**63 - 1


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def frame(spark, rows, names):
    """(vec_id, embedding) and integers under the other names."""
    data = [(i, v if v is None else [x if x is None else float(x) for x in v], *range(len(names))) for i, v in rows]
    return spark.createDataFrame(data, ", ".join(["vec_id long", "embedding array<double>", *(f"{n} int" for n in names)]))


def plain_top(rows, k=5, every=50, scale=256):
    ints = [(n, i, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows) if fine(v)]
    out = []
    for n, i, q in ints:
        if i is not None and i % every == 0:
            found = sorted((-max(-LIMIT, min(LIMIT, sum(a * b for a, b in zip(q, c, strict=True)))), j is None, j or 0, m) for m, j, c in ints if m != n and len(c) == len(q))
            out += [(i, r + 1, None if unnamed else j, -s) for r, (s, unnamed, j, _) in enumerate(found[:k])]
    return sorted(out, key=str)


def top(df, **more):
    found = topk.top_products(df, **more)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_top_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    assert top(df) == plain_top(rows)
    assert top(df, k=3, every=7, scale=100) == plain_top(rows, 3, 7, 100)


@pytest.mark.parametrize("small", [False, True])
def test_top_of_unlike_lengths_and_ties(spark, small, monkeypatch):
    if small:
        for name, value in (("TILE", 16), ("GROUP", 64), ("SPAN", 200), ("SUB", 5), ("AXES_BYTES", 8 * 36), ("SALT", 2)):
            monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    rows = [(k, (rng.standard_normal(6) * rng.lognormal(0, 1) * np.array([3, 2, 1, 0.1, 0.1, 0.1])).tolist()) for k in range(500)]
    rows += [(1000 + k, [1.0, 1.0, 0, 0, 0, 0]) for k in range(150)]  # a crowd of equal vectors and scores
    rows += [(2000 + k, rng.standard_normal(3).tolist()) for k in range(60)] + [(3000, [2.0]), (3050, []), (3051, []), (4000, [0.0] * 6)]
    rows += [(None, [9.0, 9, 0, 0, 0, 0]), (None, [1.0, 1.0, 0, 0, 0, 0]), (1000, [1.0, 1.0, 0, 0, 0, 0]), (50, [5.0, 5, 5, 5, 5, 5]), (100, None), (150, [None, 1.0, 0, 0, 0, 0]), (200, [NAN] * 6), (250, [INF] * 6)]
    df = frame(spark, rows, ["row", "part", "pos"]).repartition(7)
    assert top(df) == plain_top(rows)


def test_top_of_huge_and_empty(spark):
    rows = [(0, [1e12, -1e12]), (50, [1e12, 1.0]), (3, [1e12, 2.0]), (4, [-1e12, 3.0]), (5, [1.5, 2.5])]
    df = frame(spark, rows, [])
    assert top(df) == plain_top(rows)
    assert top(df.limit(0)) == [] and top(df.where("vec_id = 0")) == [] and topk.top_products(df).count() == 8


def plain_white(rows, scale=64, shift=10**6, components=16):
    x = {}
    for i, v in rows:
        if fine(v) and len(v):
            x.setdefault(len(v), []).append((i, tuple(math.floor(scale * c) + shift for c in v)))
    out = {}
    for part in x.values():
        fit = sorted({v for _, v in part})
        n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        y = np.array([[float(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in fit])
        values, axes = np.linalg.eigh(y.T @ y / n)
        values, axes = values[::-1], axes[:, ::-1]
        for i, v in part:
            d = [n * a - s for a, s in zip(v, sums, strict=True)]
            for k in range(min(components, len(v))):
                if values[k] > 1e-9 * values[0] > 0:
                    out.setdefault((str(i), k + 1), []).append((n, sum(a * a for a in d), abs(float(np.array([float(a) / n for a in d]) @ axes[:, k])) / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def same_white(df, rows, tolerance=1e-8, **more):
    want, got = plain_white(rows), {}
    for r in whitening.whiten(df, **more).collect():
        assert 0 <= r["identity_error"] <= 1e-9
        got.setdefault((str(r["vec_id"]), r["component"]), []).append((r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
    assert got.keys() == want.keys()
    for key, values in want.items():
        for a, b in zip(sorted(values), sorted(got[key]), strict=True):
            assert a[0] == b[0] and b[1] == (a[1] if a[1] < 2**63 else None) and np.allclose(a[2:], b[2:], rtol=tolerance, atol=tolerance)


def test_whitening_equals_dense_eigenvectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    same_white(df, [tuple(r) for r in df.select("vec_id", "embedding").collect()])


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.standard_normal(5) * [5, 4, 3, 2, 1]).tolist()) for k in range(80)] + [(500 + k, [1.0, 2, 3, 4, 5]) for k in range(60)]  # a crowd of equal vectors counts once
    rows += [(100 + k, (rng.standard_normal(2) * [3, 1]).tolist()) for k in range(20)] + [(200, [1.0, 2, 3]), (201, [1.0, 2, 3]), (202, []), (300, [float(1), 7, 7, 7]), (301, [2.0, 7, 7, 7])]
    rows += [(None, [1.0, 1, 1, 1, 1]), (7, [0.5, 0, 0, 0, 0]), (400, None), (401, [None] * 5), (402, [NAN] * 5), (403, [INF] * 5)]
    rows += [(600 + k, [1e12 * k, float(k * k), 1.0, 1.0, 1.0, 1.0]) for k in range(9)]  # no long holds these deviations
    df = frame(spark, rows, ["x", "dim"]).repartition(6)
    want = [r for r in rows if not (r[1] is not None and len(r[1]) == 6)]
    same_white(df.where("size(embedding) <> 6 OR embedding IS NULL"), want)
    huge = whitening.whiten(df.where("size(embedding) = 6")).collect()
    assert {(r["vec_id"], r["deviation"]) for r in huge} == {(600 + k, None if k != 4 else (64 * (9 * 16 - 204)) ** 2) for k in range(9)}  # 604 is the mean but for its second component
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("vec_id = 200")).collect() == []


@pytest.mark.parametrize("dim,rows", [(150, 2000), (120, 40), (30, 500), (3, 50)])
def test_jacobi_davidson_reaches_double_precision(dim, rows):
    y = np.random.default_rng(dim).standard_normal((rows, dim)) * np.linspace(1, 1.3, dim)
    v = y.T @ y / rows
    steps = whitening.jacobi_davidson(dim, 16)
    asked = next(steps)
    while True:
        try:
            asked = steps.send(v @ asked)
        except StopIteration as done:
            values, axes = done.value
            break
    dense = np.linalg.eigvalsh(v)[::-1][: len(values)]
    assert len(values) == min(16, dim) and np.abs(values - dense).max() <= 1e-13 * dense[0]
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() <= 1e-13 * dense[0] and np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13


def test_sums_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(common, "PARTIALS", 3)
    got = common.summed(spark.range(1000).repartition(20), lambda batches: {"n": sum(int(b["id"].sum()) for b in batches)})
    assert got == {"n": 499500}


def test_numbers_without_gaps(spark):
    df = spark.range(500).selectExpr("id % 7 AS a", "id")
    got = common.numbered(df, ["a", "id"]).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(500)) and [(r["a"], r["id"]) for r in got] == sorted((r["a"], r["id"]) for r in got)
