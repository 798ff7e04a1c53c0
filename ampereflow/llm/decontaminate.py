"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND with every passage of every text."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize

SPAN = 128  #: least words of a passage; passages are twice as long as the items of their index and start every half passage
SCORE = 0.5  #: least BM25 score of a passage as a share of the item's score for itself
QUESTION, ANSWER = 0.5, 0.5  #: least overlaps, of 3-word shingles and of words
BLOCK = 4  #: items of a block
SHARD_BYTES = 32_000_000  #: most text of the items in one index; more items make more indexes, searched one after another
_K1, _B = 1.2, 0.75
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def split_item(text: str) -> tuple[list[str], list[str]]:
    """(question, answer) words: the answer follows the last question mark or "answer:", else it is the last sentence."""
    at = max(text.rfind("?") + 1, (m := text.lower().rfind("answer:")) + len("answer:") * (m >= 0))
    if not words_of(text[at:]) or at <= 0:
        at = max(text.rstrip().rstrip(".!").rfind(x) for x in (".", "\n", "!")) + 1
    question, answer = words_of(text[:at]), words_of(text[at:])
    return (question, answer) if question and answer else (words_of(text), words_of(text))


def shingles(words: list[str], k: int = 3) -> set:
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


class Bm25Index:
    """Impacts are divided by the item's score for itself: every item has the same threshold, SCORE.

    An item of at most span / 2 words that stands whole in a text stands whole in one of its passages.
    """

    def __init__(self, items: list[tuple[int, str]], span: int = SPAN) -> None:
        self.span, self.step = span, span // 2
        self.items = [(i, t, words_of(t)) for i, t in items]
        self.items = [x for x in self.items if x[2]]
        n = max(1, len(self.items))
        mean = sum(len(w) for *_, w in self.items) / n or 1
        df = Counter(w for *_, words in self.items for w in set(words))
        idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
        self.postings: dict[str, tuple[list[int], list[float]]] = {}  # items and impacts
        self.blocks: dict[str, tuple[np.ndarray, np.ndarray]] = {}  # blocks and the greatest impact in each
        lists = defaultdict(list)
        for at, (*_, words) in enumerate(self.items):
            tf = Counter(words)
            raw = {w: idf[w] * c * (_K1 + 1) / (c + _K1 * (1 - _B + _B * len(words) / mean)) for w, c in tf.items()}
            own = sum(raw.values())
            for w, x in raw.items():
                lists[w].append((at, x / own))
        for w, posts in lists.items():
            impacts = [x for _, x in posts]
            blocks = np.array([a // BLOCK for a, _ in posts])
            ids, first = np.unique(blocks, return_index=True)
            self.postings[w] = ([a for a, _ in posts], impacts)
            self.blocks[w] = (ids, np.maximum.reduceat(np.array(impacts), first))
        self.number = {w: k for k, w in enumerate(self.blocks)}
        self.n_blocks = -(-len(self.items) // BLOCK)
        self.at = np.cumsum([0, *(len(b) for b, _ in self.blocks.values())])
        self.flat_blocks = np.concatenate([b for b, _ in self.blocks.values()] or [np.zeros(0, dtype=np.int64)])
        self.flat_tops = np.concatenate([t for _, t in self.blocks.values()] or [np.zeros(0)])
        self.parts = [split_item(t) for _, t, _ in self.items]
        self.shingles = [shingles(q) for q, _ in self.parts]
        self.longest = max((len(w) for *_, w in self.items), default=0)

    def search(self, words: set[str], least: float = SCORE) -> list[tuple[int, float]]:
        """All items with a score of at least ``least``: blocks of items whose greatest impacts cannot sum to it are passed over
        at once, the others are walked by WAND."""
        ids = np.array([self.number[w] for w in words if w in self.number], dtype=np.int64)
        return self._among(words, self._reach(ids, np.zeros(len(ids), dtype=np.int64), 1, least)[1], least) if len(ids) else []

    def _among(self, words: set[str], blocks: np.ndarray, least: float) -> list[tuple[int, float]]:
        known = [w for w in words if w in self.number]
        return [x for block in blocks.tolist() for x in self._walk(known, block, least)]

    def _reach(self, ids: np.ndarray, passage: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """For n passages given as pairs of word and passage, each once: (passage, block) in order where the greatest impacts sum to
        ``least`` or more. Work and memory follow the blocks that the words stand in, not all blocks of the index."""
        sizes = self.at[ids + 1] - self.at[ids]
        place = np.repeat(self.at[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        cells = np.repeat(passage, sizes) * self.n_blocks + self.flat_blocks[place]
        tops, at = self.flat_tops[place], None
        if n * self.n_blocks > 4 * len(cells):  # few of all blocks
            at, cells = np.unique(cells, return_inverse=True)
        high = np.nonzero(np.bincount(cells, weights=tops) >= least - 1e-12)[0]
        at = high if at is None else at[high]
        return at // self.n_blocks, at % self.n_blocks

    def _passages(self, words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(first word, blocks) of the passages with blocks that may hold an item, some hundred passages at a time."""
        get = self.number.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        total = max(1, -(-len(words) // self.step) - self.span // self.step + 1)
        slab = max(1, 2_000_000 // max(1, self.n_blocks))
        for low in range(0, total, slab):
            high = min(total, low + slab)
            part = ids[low * self.step : (high - 1) * self.step + self.span]
            at = np.nonzero(part >= 0)[0]
            pairs = [(at // self.step - k) * len(self.number) + part[at] for k in range(self.span // self.step)]
            pairs = np.unique(np.concatenate([p[(at // self.step - k >= 0) & (at // self.step - k < high - low)] for k, p in enumerate(pairs)]))
            passage, blocks = self._reach(pairs % len(self.number), pairs // len(self.number), high - low, SCORE)
            first = np.nonzero(np.diff(passage, prepend=-1))[0]
            for k, found in zip(passage[first].tolist(), np.split(blocks, first[1:]), strict=True) if len(first) else ():
                yield (low + k) * self.step, found

    def _walk(self, words: list[str], block: int, least: float) -> list[tuple[int, float]]:
        """WAND over the postings of one block: lists in order of their next item; the pivot is the first list at which the
        greatest impacts up to it reach ``least``, and no item before the pivot's can."""
        cursors = []
        for w in words:
            items, impacts = self.postings[w]
            a, b = bisect_left(items, block * BLOCK), bisect_left(items, (block + 1) * BLOCK)
            if a < b:
                cursors.append([items[a:b], impacts[a:b], max(impacts[a:b]), 0])
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0][c[3]])
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c[2]
                if bound >= least - 1e-12:
                    pivot = k
                    break
            if pivot is None:
                break
            item = cursors[pivot][0][cursors[pivot][3]]
            score = 0.0
            for c in cursors:
                c[3] = bisect_left(c[0], item, c[3])
                if c[3] < len(c[0]) and c[0][c[3]] == item:
                    score += c[1][c[3]]
                    c[3] += 1
            if score >= least - 1e-12:
                found.append((item, score))
            cursors = [c for c in cursors if c[3] < len(c[0])]
        return found

    def leaks(self, text: str | None) -> list[dict]:
        """The items whose question and answer stand in a text: id, score, overlaps and characters of the passage. Every passage
        retrieved is verified; the best-scoring one that passes is reported, the first on a tie."""
        words = words_of(text)
        if not words or not self.items:
            return []
        best: dict[int, tuple[float, int, float, float]] = {}
        for start, blocks in self._passages(words):
            there, grams = None, None
            for item, score in self._among(set(words[start : start + self.span]), blocks, SCORE):
                if item in best and score <= best[item][0]:
                    continue
                if there is None:
                    near = words[max(0, start - self.longest) : start + self.span + self.longest]
                    there, grams = set(near), shingles(near)
                answer = set(self.parts[item][1])
                question = len(self.shingles[item] & grams) / len(self.shingles[item])
                part = len(answer & there) / len(answer)
                if question >= QUESTION and part >= ANSWER:
                    best[item] = (score, start, question, part)
        places = [m.span() for m in _WORD.finditer(text.lower())] if best else []
        return [
            {"item_id": self.items[item][0], "score": score, "question_overlap": question, "answer_overlap": part, "start": places[at][0], "end": places[min(at + self.span, len(places)) - 1][1]}
            for item, (score, at, question, part) in sorted(best.items())
        ]


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[Bm25Index]:
    """Indexes over all items, each of at most shard_bytes of text (or one item): a size that is checked before collecting.

    Items of more than SPAN / 2 words go to indexes of their own by length, each class twice as long as the one before.
    """
    rows = items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-2 * total // shard_bytes)) if total > shard_bytes else 1
    for k in range(shards):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == k) if shards > 1 else rows
        classes: dict[int, list[tuple[int, str]]] = {}
        for r in sorted((r["id"], r["text"]) for r in part.collect()):
            span = SPAN
            while span < 2 * len(words_of(r[1])):
                span *= 2
            classes.setdefault(span, []).append(r)
        for span, found in sorted(classes.items()) or [(SPAN, [])]:
            yield Bm25Index(found, span)


_LEAK = "item_id:long,score:double,question_overlap:double,answer_overlap:double,start:int,end:int"


def _scanner(shared):
    @F.pandas_udf(f"array<struct<{_LEAK}>>")
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.leaks(t) for t in texts])

    return scan


def _scans(docs: DataFrame, items: DataFrame) -> Iterator:
    """(function that finds the leaks of a text column, is it the last one) for each index. The one index of a usual benchmark goes
    with the query; of several only one is held and sent at a time, so the result of each must be written before the next."""
    context, waiting = docs.sparkSession.sparkContext, None
    for index in indexes(items):
        if waiting is not None:
            yield _scanner(waiting), False
            waiting.unpersist()
        waiting = context.broadcast(index)
    if waiting is not None:
        yield _scanner(waiting), True


def leaked_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text and item found in it: id, item_id, score, question_overlap, answer_overlap, start, end (code points).

    Null and empty texts or items match nothing; items with a null id are left out; null ids of texts and repeated rows pass
    through; equal items are found each under its own id; empty tables give an empty result; other columns are ignored.
    """
    rows, found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), []
    for scan, last in _scans(docs, items):
        part = rows.select(F.col("_id").alias(id_col), F.explode(scan(F.col("_text"))).alias("leak")).select(id_col, "leak.*")
        found.append(part if last and not found else materialize(part, "leaks"))
    return reduce(DataFrame.unionAll, found)


def drop_leaked(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the texts that hold a test item, with the columns of docs whatever they are called. Null and empty texts, null
    ids and repeated rows stay; an empty table stays empty."""
    first = True
    for scan, last in _scans(docs, items):
        name = fresh(docs, "_leaks")
        docs = docs.withColumn(name, scan(F.col(text_col))).where(F.size(name) == 0).drop(name)
        docs = docs if last and first else materialize(docs, "unleaked")
        first = False
    return docs
