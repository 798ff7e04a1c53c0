"""Language-model scoring: a Katz model of any order with Good-Turing discounts and exactly normalised back-off weights.

    p1(w)     = d1(c) c / N;  p1(unknown) = 1 - sum of p1
    pk(w|h)   = dk(c) c(h,w) / c(h) where c(h,w) > 0, else ak(h) pk-1(w|h'), and pk-1(w|h') where h is unknown
    ak(h)     = (1 - sum of seen pk(w|h)) / (1 - sum of pk-1(w|h') over the same w);  h' is h without its first word

Texts are cut into chunks of bounded size. Per chunk, n-grams are counted once and leave it as sorted 64-bit keys, one row per
chunk, order and key range (shard) that holds any; a shard sums its range over all chunks and returns the totals in the order it
got them. So a row carries many n-grams where there are many, there are never more rows than n-grams, a frequent n-gram is one
entry per chunk, and no task holds more than a shard or a chunk. Two tables are the model, written partitioned by order and read
back to score any text: n-grams with counts, and histories with back-off weights. Keys are 64-bit hashes of the words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, materialize

ORDER = 2  #: of the model; see the README for what a third word costs
CHUNK = 1_000_000  #: tokens of a chunk, but for a longer text, which is one by itself
SHARD = 3_000_000  #: tokens of the corpus for each shard
GT = 5  #: counts up to which Good-Turing discounts hold
OVER = 0.1  #: what a larger count gives up, so that every history leaves some mass
END, START = b"\n", b"\v"  #: no word holds white space

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight together: high ones are mostly zero."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes | None, kind: str) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype=kind)
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(blob: bytes | None) -> np.ndarray:
    return np.cumsum(_unpack(blob, "u8"), dtype=np.uint64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts -> chunks: words as places in the chunk's sorted vocabulary of hashes, each text closed by the end token."""
    part, made, n = TaskContext.get().partitionId(), 0, 0

    def empty() -> tuple:
        return [], [], [], [], defaultdict(count().__next__)

    def row() -> pd.DataFrame:
        number[START]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), dtype=np.uint64, count=len(number))
        vocab, place = np.unique(hashes, return_inverse=True)
        flat = place[np.concatenate(tokens)].astype(np.uint32)
        out = {"chunk": (part << 16) + made, "ids": ids, "held": held, "sizes": sizes, "n": len(flat)}
        return pd.DataFrame([out | {"vocab": _pack_keys(vocab), "tokens": _pack(flat), "start": int(place[number[START]])}])

    ids, held, sizes, tokens, number = empty()
    for batch in batches:
        for doc, text, out in zip(batch["id"], batch["text"], batch["held"], strict=True):
            words = [*_words(text), END]
            if ids and n + len(words) > CHUNK:
                yield row()
                made, n = made + 1, 0
                ids, held, sizes, tokens, number = empty()
            n += len(words)
            ids.append(doc)
            held.append(bool(out))
            sizes.append(len(words))
            tokens.append(np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words)))
    if ids:
        yield row()


@dataclass
class _Grams:
    """The distinct n-grams of a chunk in key order: of each its history and last word; of each token which one it closes."""

    at: np.ndarray
    keys: np.ndarray
    history: np.ndarray
    word: np.ndarray
    start: int  #: the n-gram of starts only, which no token closes


class _Chunk:
    def __init__(self, r, order: int) -> None:
        self.vocab = _unpack_keys(r["vocab"])
        tokens = _unpack(r["tokens"], "u4").astype(np.int32)
        self.sizes = np.asarray(r["sizes"], dtype=np.int64)
        self.held = np.asarray(r["held"], dtype=bool)
        self.docs = len(self.sizes)
        self.doc = np.repeat(np.arange(self.docs, dtype=np.int32), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.grams = [_Grams(tokens, self.vocab, None, np.arange(len(self.vocab)), int(r["start"]))]
        for _ in range(1, order):
            self.grams.append(self._longer(self.grams[-1]))

    def _longer(self, low: _Grams) -> _Grams:
        before = np.roll(low.at, 1).astype(np.int64)
        before[self.first] = low.start
        before *= len(self.vocab)
        before += self.grams[0].at
        only = low.start * len(self.vocab) + self.grams[0].start
        codes, at = np.unique(np.append(before, only), return_inverse=True)
        del before
        history, word = codes // len(self.vocab), codes % len(self.vocab)
        keys = low.keys[history] * _MIX
        keys = (keys ^ (keys >> np.uint64(29))) + self.vocab[word]
        keys = (keys ^ (keys >> np.uint64(32))) * _MIX
        keys ^= keys >> np.uint64(29)
        order = np.argsort(keys, kind="stable")
        turned = np.empty(len(order), dtype=np.int32)
        turned[order] = np.arange(len(order), dtype=np.int32)
        at = turned[at]
        return _Grams(at[:-1], keys[order], history[order].astype(np.int32), word[order].astype(np.int32), int(at[-1]))

    def counts(self, k: int) -> np.ndarray:
        """Of each n-gram of k + 1 words: how often it stands in training texts."""
        gram = self.grams[k]
        return np.bincount(gram.at[~self.held[self.doc]], minlength=len(gram.keys))


def _cuts(keys: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of the shards that hold any of the sorted keys."""
    edges = np.array([k * (1 << 64) // shards for k in range(1, shards)], dtype=np.uint64)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]


_SENT = "order int, shard int, chunk long, keys binary, counts binary"
_BACK = "order int, shard int, chunk long, keys binary, totals binary, own binary, stats array<long>"


def _send(order: int, shards: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.to_dict("records"):
                chunk = _Chunk(r, order)
                for k, gram in enumerate(chunk.grams):
                    counts = chunk.counts(k).astype(np.uint32)
                    yield pd.DataFrame([{"order": k + 1, "shard": s, "chunk": r["chunk"], "keys": _pack_keys(gram.keys[a:b]), "counts": _pack(counts[a:b])} for s, a, b in _cuts(gram.keys, shards)])

    return send


def _joined(blobs: list[np.ndarray], kind: str) -> np.ndarray:
    return np.concatenate(blobs) if len(blobs) else np.zeros(0, dtype=kind)


def _sum_shard(group: pd.DataFrame) -> pd.DataFrame:
    """Totals of a shard, returned to each chunk in its own order, and the shard's part of the model (chunk -1). Of the chunks with
    an n-gram in training the first owns it."""
    group = group.sort_values("chunk")
    order, shard = int(group["order"].iloc[0]), int(group["shard"].iloc[0])
    keys, counts = [_unpack_keys(b) for b in group["keys"]], _joined([_unpack(b, "u4") for b in group["counts"]], "u4")
    ends = np.cumsum([len(k) for k in keys]).tolist()
    found, place = np.unique(_joined(keys, "u8"), return_inverse=True)
    del keys
    total = np.bincount(place, weights=counts).astype(np.int64)
    own = np.zeros(len(place), dtype=bool)
    used = np.nonzero(counts)[0]
    own[used[np.unique(place[used], return_index=True)[1]]] = True
    back = total[place]
    rows = [{"order": order, "shard": shard, "chunk": c, "totals": _pack(back[a:b]), "own": _pack(np.packbits(own[a:b])), "stats": None} for c, a, b in zip(group["chunk"], [0, *ends[:-1]], ends, strict=True)]
    known = total > 0
    stats = [int(known.sum()), int(total.sum()), *(int((total == r).sum()) for r in range(1, GT + 2))]
    rows.append({"order": order, "shard": shard, "chunk": -1, "keys": _pack_keys(found[known]), "totals": _pack(total[known]), "stats": stats})
    return pd.DataFrame(rows, columns=[x.split()[0] for x in _BACK.split(", ")])


def _ask_shard(asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """Totals of a shard of the stored model for the chunks that ask; nothing is owned."""
    keys, totals = (_unpack_keys(model["keys"].iloc[0]), _unpack(model["totals"].iloc[0], "i8")) if len(model) else (np.zeros(0, "u8"), np.zeros(0, "i8"))
    keys, totals = np.append(keys, np.uint64(2**64 - 1)), np.append(totals, 0)
    rows = []
    for order, shard, chunk, blob in zip(asked["order"], asked["shard"], asked["chunk"], asked["keys"], strict=True):
        wanted = _unpack_keys(blob)
        place = np.searchsorted(keys, wanted)
        rows.append({"order": order, "shard": shard, "chunk": chunk, "totals": _pack(np.where(keys[place] == wanted, totals[place], 0)), "own": _pack(np.packbits(np.zeros(len(wanted), dtype=bool))), "stats": None})
    return pd.DataFrame(rows, columns=[x.split()[0] for x in _BACK.split(", ")])


def discounts(n: list[int]) -> np.ndarray:
    """d_1 ... d_GT by Good-Turing from the counts of counts n_1 ... n_(GT+1); where these give no proper discounts, 1 - 1/2r."""
    d = np.array([1 - 0.5 / r for r in range(1, GT + 1)])
    if n[0] and all(n[:GT]):
        tail = (GT + 1) * n[GT] / n[0]
        got = np.array([((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail) if tail < 1 else 1.0 for r in range(1, GT + 1)])
        if ((got > 0) & (got < 1)).all():
            d = got
    return d


class Katz:
    """Probabilities by count. stats: for each order the kinds, the sum of counts and n_1 ... n_(GT+1)."""

    def __init__(self, stats: list[list[int]], texts: int) -> None:
        self.kinds, self.total, self.texts = stats[0][0], stats[0][1], texts
        self.d = [discounts(s[2:]) for s in stats]
        few = stats[0][2 : 2 + GT]
        low = sum(r * n for r, n in enumerate(few, 1))
        kept = sum(float(d) * r * n for r, (d, n) in enumerate(zip(self.d[0], few, strict=True), 1)) + (self.total - low) - OVER * (self.kinds - sum(few))
        self.unknown = 1 - kept / self.total if self.total else 1.0

    def gram(self, k: int, c: np.ndarray, history: np.ndarray | int) -> np.ndarray:
        """Discounted share of n-grams of k + 1 words with count c in their history's count; 0 where c is 0."""
        return np.where(c <= GT, np.append(0.0, self.d[k])[np.minimum(c, GT)] * c, c - OVER) / np.maximum(history, 1)

    def word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.gram(0, c, self.total), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.kinds + 1)))


_OUT = "row long, id {}, held_out boolean, n_tokens long, n_known long, base_score double, seen double, order int, shard int, chunk long, keys binary, mass binary, lower binary, ukeys binary, udocs binary, utimes binary"


def _score(model: Katz, order: int, shards: int):
    """A chunk and its totals -> a row for each text with all but the back-off weights; for each shard of histories what the
    weights are made of (mass and lower, of the n-grams that the chunk owns) and which texts need them how often."""

    def score(chunks: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        r = chunks.to_dict("records")[0]
        chunk = _Chunk(r, order)
        back = back.sort_values(["order", "shard"])
        sent, logs = [], np.zeros(len(chunk.doc))
        done = np.zeros(len(chunk.doc), dtype=bool)
        totals, p = [], []
        for k, gram in enumerate(chunk.grams):
            mine = back[back["order"] == k + 1]
            parts = [_unpack(b, "i8") for b in mine["totals"]]
            totals.append(_joined(parts, "i8"))
            if k == 0:
                p.append(model.word(totals[0]))
                continue
            history = totals[k - 1].copy()
            history[chunk.grams[k - 1].start] = model.texts
            p.append(model.gram(k, totals[k], history[gram.history]))
            own = _joined([np.unpackbits(_unpack(b, "u1"), count=len(x)).astype(bool) for b, x in zip(mine["own"], parts, strict=True)], bool)
            # the same n-grams without their first words
            shorter = np.zeros(len(gram.keys), dtype=np.int64)
            shorter[gram.at] = chunk.grams[k - 1].at  # a token that closes the one closes the other
            low = p[k - 1][shorter[own]]
            mass = np.bincount(gram.history[own], weights=p[k][own], minlength=len(history))
            lower = np.bincount(gram.history[own], weights=low, minlength=len(history))
            need = np.nonzero((totals[k][gram.at] == 0) & (history[gram.history[gram.at]] > 0))[0]
            codes, times = np.unique(gram.history[gram.at[need]].astype(np.int64) * chunk.docs + chunk.doc[need], return_counts=True)
            before, doc = codes // chunk.docs, codes % chunk.docs
            have, keys = np.nonzero(mass)[0], chunk.grams[k - 1].keys
            rows: dict[int, dict] = {}
            for s, a, b in _cuts(keys[have], shards):
                rows.setdefault(s, {}).update(keys=_pack_keys(keys[have[a:b]]), mass=_pack(mass[have[a:b]]), lower=_pack(lower[have[a:b]]))
            for s, a, b in _cuts(keys[before], shards):
                rows.setdefault(s, {}).update(ukeys=_pack_keys(keys[before[a:b]]), udocs=_pack(doc[a:b].astype(np.uint32)), utimes=_pack(times[a:b].astype(np.uint32)))
            sent += [{"order": k, "shard": s, "chunk": r["chunk"]} | x for s, x in rows.items()]
        for k in range(order - 1, -1, -1):
            at = chunk.grams[k].at
            here = ~done & ((totals[k][at] > 0) if k else True)
            logs[here] = np.log10(p[k][at[here]])
            done |= here
        words = totals[0][chunk.grams[0].at]
        of_docs = lambda x: np.bincount(chunk.doc, weights=x, minlength=chunk.docs)
        out = {"row": (r["chunk"] << 24) + np.arange(chunk.docs), "id": list(r["ids"]), "held_out": chunk.held, "n_tokens": chunk.sizes}
        out |= {"n_known": of_docs(words > 0).astype(np.int64), "base_score": of_docs(model.base(words)), "seen": of_docs(logs)}
        return pd.concat([pd.DataFrame(out), pd.DataFrame(sent)]).reindex(columns=[x.split()[0] for x in _OUT.split(", ")])

    return score


_PARTS = "order int, shard int, chunk long, docs binary, parts binary, keys binary, weights binary"


def _use(keys: np.ndarray, weight: np.ndarray, group: pd.DataFrame) -> list[dict]:
    """For each chunk of the group: the sums of logarithms of weights that its texts need; histories without a weight have 1."""
    keys, weight = np.append(keys, np.uint64(2**64 - 1)), np.append(weight, 0.0)
    out = []
    for order, shard, chunk, ukeys, udocs, utimes in zip(group["order"], group["shard"], group["chunk"], group["ukeys"], group["udocs"], group["utimes"], strict=True):
        need = _unpack_keys(ukeys)
        if len(need):
            place = np.searchsorted(keys, need)
            doc, at = np.unique(_unpack(udocs, "u4"), return_inverse=True)
            sums = np.bincount(at, weights=_unpack(utimes, "u4") * np.where(keys[place] == need, weight[place], 0.0))
            out.append({"order": order, "shard": shard, "chunk": chunk, "docs": _pack(doc), "parts": _pack(sums)})
    return out


def _back_off(group: pd.DataFrame) -> pd.DataFrame:
    """Back-off weights of a shard's histories (chunk -1) and what the texts need of them."""
    group = group.sort_values("chunk")
    keys, place = np.unique(_joined([_unpack_keys(b) for b in group["keys"]], "u8"), return_inverse=True)
    mass, lower = (np.bincount(place, weights=_joined([_unpack(b, "f8") for b in group[x]], "f8"), minlength=len(keys)) for x in ("mass", "lower"))
    weight = np.log10(np.maximum(1 - mass, 1e-300)) - np.log10(1 - lower) if len(keys) else np.zeros(0)
    model = {"order": int(group["order"].iloc[0]), "shard": int(group["shard"].iloc[0]), "chunk": -1, "keys": _pack_keys(keys), "weights": _pack(weight)}
    return pd.DataFrame([*_use(keys, weight, group), model], columns=[x.split()[0] for x in _PARTS.split(", ")])


def _ask_weights(group: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    keys, weight = (_unpack_keys(model["keys"].iloc[0]), _unpack(model["weights"].iloc[0], "f8")) if len(model) else (np.zeros(0, "u8"), np.zeros(0))
    return pd.DataFrame(_use(keys, weight, group), columns=[x.split()[0] for x in _PARTS.split(", ")])


def _sum_parts(group: pd.DataFrame) -> pd.DataFrame:
    """What the shards found for a chunk's texts, added up: a row for each text."""
    doc, at = np.unique(_joined([_unpack(b, "u4") for b in group["docs"]], "u4").astype(np.int64), return_inverse=True)
    sums = np.bincount(at, weights=_joined([_unpack(b, "f8") for b in group["parts"]], "f8"))
    return pd.DataFrame({"row": (int(group["chunk"].iloc[0]) << 24) + doc, "part": sums})


@dataclass
class KatzModel:
    """A fitted model: grams (order, shard, keys, totals) and weights (order, shard, keys, weights: log10 by history) as written
    tables, and the few numbers that turn counts into probabilities."""

    numbers: Katz
    order: int
    shards: int
    grams: DataFrame
    weights: DataFrame


def _chunked(docs: DataFrame, id_col: str, text_col: str, held: Column) -> tuple[DataFrame, str]:
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held"))
    schema = f"chunk long, ids array<{kind}>, held array<boolean>, sizes array<long>, n long, vocab binary, tokens binary, start long"
    return materialize(texts.mapInPandas(_chunks, schema), "chunks"), kind


def _finish(scored: DataFrame, parts: DataFrame, model: Katz, id_col: str) -> DataFrame:
    rows = scored.where("row IS NOT NULL").join(parts.groupBy("chunk").applyInPandas(_sum_parts, "row long, part double"), "row", "left")
    return rows.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", (F.col("seen") + F.coalesce("part", F.lit(0.0))).alias("score"))


def fit_katz(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, order: int = ORDER) -> tuple[DataFrame, KatzModel]:
    """(scores of all rows as katz_scores gives them, the model learned from the rows that are not held out)."""
    chunks, kind = _chunked(docs, id_col, text_col, crc_fold(F.col(id_col), folds) == held)
    size = chunks.agg(F.sum("n").alias("n"), F.sum(F.size(F.filter("held", lambda h: ~h))).alias("texts")).first()
    shards = max(1, -(-(size["n"] or 0) // SHARD))
    sent = chunks.mapInPandas(_send(order, shards), _SENT)
    counts = materialize(sent.groupBy("order", "shard").applyInPandas(_sum_shard, _BACK), "grams", ("order",))
    stats = [[0] * (GT + 3) for _ in range(order)]
    for r in counts.where("chunk = -1").select("order", F.posexplode("stats").alias("at", "x")).groupBy("order", "at").agg(F.sum("x").alias("x")).collect():
        stats[r["order"] - 1][r["at"]] = r["x"]
    numbers = Katz(stats, size["texts"] or 0)
    replies = counts.where("chunk >= 0").select("order", "shard", "chunk", "totals", "own")
    scored = materialize(chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(_score(numbers, order, shards), _OUT.format(kind)), "scored")
    wanted = scored.where("row IS NULL").drop("row", "id", "held_out", "n_tokens", "n_known", "base_score", "seen")
    parts = materialize(wanted.groupBy("order", "shard").applyInPandas(_back_off, _PARTS), "weights", ("order",))
    grams, weights = counts.where("chunk = -1").select("order", "shard", "keys", "totals"), parts.where("chunk = -1").select("order", "shard", "keys", "weights")
    return _finish(scored, parts.where("chunk >= 0").select("chunk", "docs", "parts"), numbers, id_col), KatzModel(numbers, order, shards, grams, weights)


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, order: int = ORDER) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text).

    Learns from the rows whose crc32(id as text) mod folds is not held. Null texts count as empty: one end token. A null id
    counts as empty text for the fold. Repeated rows count each. Where nothing is learned, every token is unknown and certain.
    Other columns are ignored; an empty table gives an empty result.
    """
    return fit_katz(docs, id_col, text_col, folds, held, order)[0]


def score_texts(docs: DataFrame, model: KatzModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As katz_scores, by the tables of a model fitted before; nothing is learned, and held_out is true for every row."""
    chunks, kind = _chunked(docs, id_col, text_col, F.lit(True))
    asked = chunks.mapInPandas(_send(model.order, model.shards), _SENT)
    replies = asked.groupBy("order", "shard").cogroup(model.grams.groupBy("order", "shard")).applyInPandas(_ask_shard, _BACK)
    replies = replies.select("order", "shard", "chunk", "totals", "own")
    scored = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(_score(model.numbers, model.order, model.shards), _OUT.format(kind))
    scored = materialize(scored, "scored")
    wanted = scored.where("row IS NULL").drop("row", "id", "held_out", "n_tokens", "n_known", "base_score", "seen")
    parts = wanted.groupBy("order", "shard").cogroup(model.weights.groupBy("order", "shard")).applyInPandas(_ask_weights, _PARTS)
    return _finish(scored, parts.select("chunk", "docs", "parts"), model.numbers, id_col)
