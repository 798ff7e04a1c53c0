"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding look-alikes, normalised by length, with exceptions.

The lexicon is learned: beginnings of words that stand in many more toxic than other training texts. A longer beginning or word
that is common in harmless texts is an exception: it matches instead of the shorter one and weighs nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, materialize
from .models import SAMPLE, Logistic, labelled_sample

THRESHOLD = 0.3
LENGTHS = (4, 5, 6, 7, 8)  #: lengths of beginnings that are tried beside whole words
G2 = 30.0  #: least likelihood-ratio statistic of an entry

#: Harmless phrases that hold words often used as insults.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "circus clown", "pond scum", "sore loser")

# fixed values: characters that stand for letters
_LOOK_ALIKE = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i",
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}


def _table() -> dict[int, str]:
    fold = {ord(k): v for k, v in _LOOK_ALIKE.items()}
    fold |= {0xFF41 + k: _LOOK_ALIKE.get(chr(97 + k), chr(97 + k)) for k in range(26)}  # full-width letters
    fold |= {c: " " for c in range(128) if not chr(c).isalnum() and c not in fold}
    return fold | {0x200B: "", 0x200C: "", 0x200D: "", 0xAD: "", 0xFEFF: ""}


_FOLD = _table()
_SPACE = re.compile(r" {2,}")


def fold(text: str | None) -> str:
    """Lower case, look-alikes as letters, other ASCII marks as single spaces; starts and ends with a space."""
    return _SPACE.sub(" ", f" {(text or '').lower().translate(_FOLD)} ")


def beginnings(text: str | None) -> set[str]:
    out = set()
    for w in set(fold(text).split()):
        out.add(w + " ")
        out.update(w[:n] for n in LENGTHS if n <= len(w))
    return out


class Lexicon:
    """Entries with weights, exceptions without, and the model that turns the features of a text into a probability."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], model: Logistic | None = None) -> None:
        self.weights, self.exceptions, self.model, self.machine = weights, exceptions, model, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"machine": None}

    def _matches(self, folded: str) -> Iterator[tuple[int, tuple[int, float]]]:
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for entry, weight in [*self.weights.items(), *((x, 0.0) for x in self.exceptions)]:
                self.machine.add_word(" " + entry, (len(entry) + 1, weight))
            self.machine.make_automaton()
        return self.machine.iter(folded) if len(self.machine) else iter(())

    def features(self, text: str | None) -> list[float]:
        """Logs of the sum of weights and of the sum per hundred words, the greatest weight, the log of the number of matches."""
        folded = fold(text)
        best: dict[int, tuple[int, float]] = {}  # of the matches at one start the longest holds
        for end, (n, weight) in self._matches(folded):
            start = end + 1 - n
            if start not in best or best[start][0] < n:
                best[start] = (n, weight)
        hits, until = [], 0
        for start, (n, weight) in sorted(best.items()):
            if weight and start >= until:
                hits.append(weight)
            elif not weight:
                until = max(until, start + n - 1)
        words = max(1, folded.count(" ") - 1)
        return [math.log1p(sum(hits)), math.log1p(100 * sum(hits) / words), max(hits, default=0.0), math.log1p(len(hits))]

    def scores(self, texts) -> np.ndarray:
        return self.model.proba(np.array([self.features(t) for t in texts], dtype=float).reshape(-1, 4))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: Counter = Counter()
        for text in batch["text"]:
            found.update(beginnings(text))
        yield pd.DataFrame({"entry": list(found), "n": list(found.values())})


def fit_lexicon(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learns from at most ``most`` labelled texts: entries from three quarters of them, the model from the rest. Equal texts count
    once, as toxic if any of them is. The lexicon is bounded by this sample: an entry stands in several toxic texts of it."""
    sample = F.broadcast(labelled_sample(labels.withColumnRenamed("doc_id", id_col), "toxic", id_col, most))
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(sample, id_col).groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("text"))
    rows = materialize(rows.select("text", "toxic", "h", (F.pmod("h", F.lit(4)) == 0).alias("calibrate")), "sample")
    learn = rows.where("NOT calibrate")
    sizes = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nt, nn = sizes.get(1, 0), sizes.get(0, 0)
    least = max(2, min(8, nt // 10))
    count = lambda toxic: learn.where(F.col("toxic") == toxic).select("text").mapInPandas(_count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))
    often = materialize(count(1).where(F.col("n") >= least), "entries")
    both = often.withColumnRenamed("n", "t").join(count(0), "entry", "left").select("entry", "t", F.coalesce("n", F.lit(0)).alias("c"))
    rate = (F.col("t") + F.col("c")) / F.lit(float(max(1, nt + nn)))
    part = lambda n, of: F.when(n > 0, n * F.log(n / (of * rate))).otherwise(0.0)
    g2 = 2 * (part(F.col("t"), F.lit(float(max(1, nt)))) + part(F.col("c"), F.lit(float(max(1, nn)))))
    odds = F.log((F.col("t") + 0.5) / (nt + 1)) - F.log((F.col("c") + 0.5) / (nn + 1))
    both = materialize(both.withColumn("g2", g2).withColumn("odds", odds), "weighed")
    chosen = both.where((F.col("odds") >= 1.0) & (F.col("g2") >= G2)).select("entry", "odds")
    weights = {r["entry"]: r["odds"] for r in chosen.collect()}
    plain = both.where((F.col("odds") < 0.5) & (F.col("c") >= 8)).select("entry")
    parts = plain.where(F.length("entry") > min(LENGTHS)).select("entry", F.explode(F.transform(F.sequence(F.lit(min(LENGTHS)), F.length("entry") - 1), lambda n: F.substr("entry", F.lit(1), n))).alias("part"))
    learned = {r["entry"] for r in parts.join(chosen.select(F.col("entry").alias("part")), "part").select("entry").distinct().collect()}
    lexicon = Lexicon(weights, sorted({*learned, *(fold(x).strip() for x in exceptions)} - weights.keys()))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.features(t) for t in texts])

    xy = rows.where("calibrate").select("toxic", "h", features("text").alias("x")).orderBy("h", "toxic").collect()
    lexicon.model = Logistic(np.array([r["x"] for r in xy], dtype=float).reshape(-1, 4), np.array([r["toxic"] for r in xy], dtype=float))
    return lexicon


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lexicon: Lexicon | None = None) -> DataFrame:
    """One row per input row: id, held_out (crc32 of the id mod 4 is 2: never trained on), score, predicted (score >= THRESHOLD).

    The score of a whole text rests on its matches and length alone. Null texts count as empty and get the score of a text
    without matches; null ids are scored but never train; repeated rows get equal scores; where nothing is labelled every
    score is 0.5; an empty table gives an empty result. Other columns are ignored.
    """
    fold_col = crc_fold(F.col(id_col), 4)
    if lexicon is None:
        lexicon = fit_lexicon(docs.where(fold_col != 2), labels.where(crc_fold(F.col("doc_id"), 4) != 2), id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts))

    rows = docs.select(F.col(id_col).alias("_id"), (fold_col == 2).alias("held_out"), score(F.col(text_col)).alias("score"))
    return rows.select(F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
