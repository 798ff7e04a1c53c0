"""Katz scores against a plain model of dictionaries, and its probabilities against one."""

import math
import zlib
from collections import Counter, defaultdict

import pytest

from ampereflow.llm import katz

SF = "/root/testdata/sf0.001"


def toks(text):
    return [*(text or "").encode().lower().split(), katz.END]


class Plain:
    """Katz back-off by dictionaries and recursion."""

    def __init__(self, texts, order=2):
        self.order, self.texts = order, len(texts)
        self.c = [Counter() for _ in range(order)]
        for t in texts:
            for h, w in self.grams(t):
                for k in range(order):
                    self.c[k][h[order - 1 - k :], w] += 1
        self.n = self.c[0].total()
        self.d = [katz.discounts([Counter(c.values())[r] for r in range(1, katz.GT + 2)]) for c in self.c]
        self.follow = defaultdict(list)
        for c in self.c[1:]:
            for h, w in c:
                self.follow[h].append(w)
        self.words = {w for _, w in self.c[0]}
        self.unknown = 1 - sum(self.p((), w) for w in self.words)

    def grams(self, text):
        words = [katz.START] * (self.order - 1) + toks(text)
        return [(tuple(words[i - self.order + 1 : i]), words[i]) for i in range(self.order - 1, len(words))]

    def seen(self, h, w):
        c, d = self.c[len(h)][h, w], self.d[len(h)]
        total = self.n if not h else self.texts if set(h) == {katz.START} else self.c[len(h) - 1][h[:-1], h[-1]]
        return (d[c - 1] * c if c <= katz.GT else c - katz.OVER) / total

    def p(self, h, w):
        if self.c[len(h)][h, w]:
            return self.seen(h, w)
        if not h:
            return self.unknown
        return self.weight(h) * self.p(h[1:], w)

    def weight(self, h):
        if h not in self.follow:
            return 1.0
        return (1 - sum(self.seen(h, x) for x in self.follow[h])) / (1 - sum(self.seen(h[1:], x) for x in self.follow[h]))

    def score(self, text):
        return sum(math.log10(self.p(h, w)) for h, w in self.grams(text))

    def base(self, text):
        return sum(math.log10((self.c[0][(), w] + 0.5) / (self.n + 0.5 * (len(self.words) + 1))) for w in toks(text))


@pytest.mark.parametrize(("order", "small"), [(2, False), (2, True), (3, True)])
def test_equals_a_plain_model(spark, monkeypatch, order, small):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").repartition(3)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    if small:  # many shards and chunks
        monkeypatch.setattr(katz, "SHARD", 5000)
        monkeypatch.setattr(katz, "CHUNK", 4000)
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in texts}
    plain = Plain([t for k, t in texts.items() if not held[k]], order)
    some = sorted(plain.follow, key=len)
    for h in [(katz.START,) * (order - 1), *some[:3], *some[-3:]]:
        assert abs(sum(plain.p(h, w) for w in [*plain.words, b"never seen"]) - 1) < 1e-9
    scored, model = katz.fit_katz(docs, order=order)
    again = {r["doc_id"]: r for r in katz.score_texts(docs, model).collect()}
    got = {r["doc_id"]: r for r in scored.collect()}
    assert got.keys() == texts.keys() == again.keys()
    for k, r in got.items():
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[k], len(toks(texts[k])), sum(plain.c[0][(), w] > 0 for w in toks(texts[k])), plain.n)
        assert math.isclose(r["base_score"], plain.base(texts[k]), rel_tol=1e-9)
        assert math.isclose(r["score"], plain.score(texts[k]), rel_tol=1e-9)
        # the stored tables alone give the same
        assert again[k]["n_known"] == r["n_known"] and math.isclose(again[k]["score"], r["score"], rel_tol=1e-12)
    better = [got[k]["score"] > got[k]["base_score"] for k in got if held[k]]
    assert sum(better) > 0.9 * len(better)
    # no more rows than n-grams travel, and the model's tables hold each n-gram and each history once
    assert sum(len(katz._unpack_keys(r["keys"])) for r in model.grams.collect()) == sum(map(len, plain.c))
    assert sum(len(katz._unpack_keys(r["keys"])) for r in model.weights.collect()) == len(plain.follow)
    if order == 3 and small:
        fresh = [(1, "the the of unheard words"), (2, None), (3, next(iter(texts.values())) + " the")]
        other = katz.score_texts(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()
        assert all(math.isclose(r["score"], plain.score(dict(fresh)[r["doc_id"]]), rel_tol=1e-9) for r in other)


def test_edge_cases(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "a b", 0), (3, "a b", 0), (None, "A  B\tc", 0), (4, "x " * 60_000, 0), (0, "zzz yyy", 0), (7, "a q", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    texts = [(k, t) for k, t, _ in rows]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, _ in texts]
    assert any(held)
    plain = Plain([t for (_, t), h in zip(texts, held, strict=True) if not h])
    key = lambda k: -1 if k is None else k
    got = sorted((key(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in katz.katz_scores(docs).collect())
    assert got == sorted((key(k), len(toks(t)), round(plain.score(t), 6)) for k, t in texts)
    assert katz.katz_scores(docs.limit(0)).collect() == []
    alone = katz.katz_scores(docs, folds=1, held=0).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in alone} == {(0, 0, 0.0)}
