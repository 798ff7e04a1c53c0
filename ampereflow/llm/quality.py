"""Quality classifier: hierarchical empirical Bayes over document evidence, host and path.

A document's own evidence is a logistic model over hashed word n-grams and a few counts of the text. Grouped sums of the
probabilities that it gives are the record of each host and of each path below it. A document is judged by its evidence and by the
record of the other documents of its site: the path's mean without the document itself, shrunk toward the host's, which is shrunk
toward the global one. How strongly they shrink is estimated from the spread between sites by the method of moments, so a site of
few documents says little and sites that are all alike say nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize
from .models import SAMPLE, Logistic, labelled_sample

BROADCAST_ROWS = 100_000  #: most sites that are sent to every executor; more are joined by shuffle
KEEP = 0.5
BUCKETS = 1 << 16  #: of hashed words and word pairs
LEAST = 3  #: labelled texts that a bucket must stand in to have a weight

_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}")
_NUMBERS = re.compile(r"[0-9]+")
_SYMBOLS, _STOPS = "#$%&*|<>{}~^", ".,;:"


class _Buckets(dict):
    """Word -> bucket, remembered while there is room."""

    def __missing__(self, word: str) -> int:
        bucket = xxhash.xxh32_intdigest(word.encode("utf-8", "replace")) % BUCKETS
        if len(self) < 50_000:
            self[word] = bucket
        return bucket


_buckets = _Buckets()


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs of neighbours."""
    one = np.fromiter(map(_buckets.__getitem__, words), dtype=np.int64, count=len(words))
    return one, (one[:-1] * 40503 + one[1:] * 31 + 7) % BUCKETS


def text_counts(text: str, words: list[str]) -> list[float]:
    """Lengths, distinct words, symbols, doubled marks, capitals, numbers, stops and line ends of a whole text."""
    n, distinct = max(1, len(words)), len(set(words))
    return [
        np.log1p(len(text)), len(text) / n, distinct / n * n**0.15, distinct / n, sum(map(text.count, _SYMBOLS)) / n, (text.count("!!") + text.count("??")) / n,
        len(_CAPITALS.findall(text)) / n, len(_NUMBERS.findall(text)) / n, sum(map(text.count, _STOPS)) / n, text.count("\n") / n,
    ]


@dataclass
class QualityModel:
    """weights: log ratio of good to bad texts for each bucket of words and of pairs; logistic: over their means and the counts."""

    weights: np.ndarray
    logistic: Logistic

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        words = text.split()
        return [*(float(w[g].mean()) if len(g) else 0.0 for w, g in zip(self.weights, grams([w.lower() for w in words]), strict=True)), *text_counts(text, words)]

    def evidence(self, texts) -> np.ndarray:
        """Log-odds of quality 1 by the text alone."""
        return self.logistic.logit(np.array([self.features(t) for t in texts], dtype=float).reshape(-1, 12))


def _presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many good and bad texts each bucket stands in."""
    total = np.zeros((2, 2, BUCKETS), dtype=np.int64)  # quality, words or pairs, bucket
    for batch in batches:
        for text, quality in zip(batch["text"], batch["quality"], strict=True):
            for k, g in enumerate(grams((text or "").lower().split())):
                total[int(quality), k, np.unique(g)] += 1
    at = np.argwhere(total)
    yield pd.DataFrame({"quality": at[:, 0], "kind": at[:, 1], "bucket": at[:, 2], "n": total[tuple(at.T)]})


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> QualityModel:
    """Learns from at most ``most`` labelled rows, drawn by hash: n-gram weights from one half, the logistic model from the other."""
    sample = F.broadcast(labelled_sample(labels.withColumnRenamed("doc_id", id_col), "quality", id_col, most))
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(sample, id_col)
    rows = materialize(rows.select("text", "quality", F.xxhash64(id_col, "text").alias("h")), "labelled")
    half = F.pmod("h", F.lit(2)) == 0
    counts = np.zeros((2, 2, BUCKETS))
    found = rows.where(half).mapInPandas(_presence, "quality int, kind int, bucket int, n long").groupBy("quality", "kind", "bucket").agg(F.sum("n").alias("n"))
    for r in found.toPandas().itertuples(index=False):  # at most 4 * BUCKETS rows
        counts[r.quality, r.kind, r.bucket] = r.n
    n = np.zeros(2)
    for r in rows.where(half).groupBy("quality").count().collect():
        n[r["quality"]] = r["count"]
    weights = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
    weights[counts.sum(0) < LEAST] = 0
    model = QualityModel(weights, Logistic(np.zeros((0, 12)), np.zeros(0)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.features(t) for t in texts])

    xy = rows.where(~half).select("quality", "h", features("text").alias("x")).orderBy("h", "quality").collect()
    model.logistic = Logistic(np.array([r["x"] for r in xy], dtype=float).reshape(-1, 12), np.array([r["quality"] for r in xy], dtype=float))
    return model


def _evidence(docs: DataFrame, model: QualityModel):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.evidence(texts))

    return evidence


def site_posteriors(scored: DataFrame) -> DataFrame:
    """One row per host and path of scored (host, path, p): sums and numbers of p (s, n of the path, hs, hn of the host), the global
    mean m, the strengths with which hosts and paths shrink, and the posterior means host_mean and path_mean."""
    paths = scored.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count("*").alias("n"))
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    whole = hosts.agg(F.sum("hs").alias("gs"), F.sum("hn").alias("gn"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("sq"), F.count("*").alias("k"))
    mean = F.col("gs") / F.col("gn")
    # between-host variance of the means, weighted by size, less what chance alone gives
    spread = F.col("sq") / F.col("gn") - mean * mean - mean * (1 - mean) * F.col("k") / F.col("gn")
    whole = whole.select(mean.alias("m"), F.least(F.greatest(mean * (1 - mean) / F.greatest(spread, F.lit(1e-6)) - 1, F.lit(2.0)), F.lit(1e4)).alias("strength"))
    inner = paths.join(hosts, "host")
    within = F.sum(F.col("s") * F.col("s") / F.col("n") - F.col("n") * F.pow(F.col("hs") / F.col("hn"), 2)) / F.sum("n")
    chance = F.sum(F.col("hs") / F.col("hn") * (1 - F.col("hs") / F.col("hn"))) / F.sum("n")
    level = F.sum(F.col("n") * F.col("hs") / F.col("hn") * (1 - F.col("hs") / F.col("hn"))) / F.sum("n")
    inside = inner.agg(F.least(F.greatest(level / F.greatest(within - chance, F.lit(1e-6)) - 1, F.lit(2.0)), F.lit(1e4)).alias("path_strength"))
    both = inner.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(inside))
    return both.withColumns(_means(lambda c: F.col(c), F.lit(0.0), 0))


def _means(col, p: Column, one: int) -> dict[str, Column]:
    """Posterior means of host and path from all documents but ``one``, whose probability is p."""
    host = (col("hs") - p + col("strength") * col("m")) / (col("hn") - one + col("strength"))
    return {"host_mean": host, "path_mean": (col("s") - p + col("path_strength") * host) / (col("n") - one + col("path_strength"))}


def _logit(p: Column) -> Column:
    return F.log(F.greatest(p, F.lit(1e-6)) / F.greatest(1 - p, F.lit(1e-6)))


def _judged(rows: DataFrame, scored: DataFrame, host: Column, path: Column, names: tuple[str, str, str], weight: float) -> DataFrame:
    """rows with site_shift and score beside the evidence that they have; scored: (host, path, p) of all rows."""
    evidence, shift, score = names
    sites = materialize(site_posteriors(scored).drop("host_mean", "path_mean"), "sites")
    name = {c: fresh(rows, f"_site_{c}") for c in sites.columns}
    sites = sites.select(*[F.col(c).alias(n) for c, n in name.items()])
    if sites.count() <= BROADCAST_ROWS:
        sites = F.broadcast(sites)
    p = 1 / (1 + F.exp(-F.col(evidence)))
    out = rows.join(sites, (host == F.col(name["host"])) & (path == F.col(name["path"])), "left")
    others = _logit(_means(lambda c: F.col(name[c]), p, 1)["path_mean"]) - _logit(F.col(name["m"]))
    out = out.withColumn(shift, F.coalesce(others, F.lit(0.0))).drop(*name.values())
    return out.withColumn(score, 1 / (1 + F.exp(-(F.col(evidence) + weight * F.col(shift)))))


def _site(host_col: str, path_col: str) -> tuple[Column, Column]:
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (host_col, path_col))


def with_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", weight: float = 1.0, names: tuple[str, str, str] = ("evidence", "site_shift", "quality_score")) -> DataFrame:
    """Adds the columns ``names`` to docs, in place of columns with these names: log-odds of the text alone, log-odds that the other
    documents of its site add, and the probability of quality 1 by both.

    Null texts count as empty; null hosts and paths are a site of their own; null ids are scored but never train; rows repeated
    count each; where no row is labelled the evidence is zero; an empty table gives an empty result.
    """
    evidence = _evidence(docs, fit_evidence(docs, labels, id_col, text_col))
    host, path = _site(host_col, path_col)
    rows = materialize(docs.withColumn(names[0], evidence(F.col(text_col))), "with-evidence")  # each text is scored once, for its site and for itself
    scored = rows.select(host.alias("host"), path.alias("path"), (1 / (1 + F.exp(-F.col(names[0])))).alias("p"))
    return _judged(rows, scored, host, path, names, weight)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", keep: float = KEEP) -> DataFrame:
    """The rows of docs with a score of at least keep, with the columns of docs whatever they are called."""
    rows, scored = _scored(docs, labels, id_col, text_col, host_col, path_col)
    keys = ["id", "h", "host", "path"]
    good = _judged(rows, scored, F.col("host"), F.col("path"), ("evidence", "site_shift", "score"), 1.0).where(F.col("score") >= keep).select(*keys).distinct()
    name = {k: fresh(docs, f"_good_{k}") for k in keys}
    host, path = _site(host_col, path_col)
    same = F.col(id_col).eqNullSafe(F.col(name["id"])) & (F.xxhash64(text_col) == F.col(name["h"])) & (host == F.col(name["host"])) & (path == F.col(name["path"]))
    return docs.join(good.select(*[F.col(k).alias(n) for k, n in name.items()]), same, "left_semi")


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, scored) for _judged: id, hash of the text, site and evidence of every document, written, so that each text is scored
    once for its site and for itself."""
    evidence = _evidence(docs, fit_evidence(docs, labels, id_col, text_col))
    host, path = _site(host_col, path_col)
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), host.alias("host"), path.alias("path"), evidence(F.col(text_col)).alias("evidence")), "evidence")
    return rows, rows.select("host", "path", (1 / (1 + F.exp(-F.col("evidence")))).alias("p"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", keep: float = KEEP, weight: float = 1.0) -> DataFrame:
    """One row per input row: id, evidence, site_shift, score, kept (score >= keep). See with_quality for odd inputs; texts are read
    once."""
    rows, scored = _scored(docs, labels, id_col, text_col, host_col, path_col)
    out = _judged(rows, scored, F.col("host"), F.col("path"), ("evidence", "site_shift", "score"), weight)
    return out.select(F.col("id").alias(id_col), "evidence", "site_shift", "score", (F.col("score") >= keep).alias("kept"))
