"""The pipeline against brute force, stage by stage on its own input."""

from itertools import combinations

import corpus_pipeline
from ampereflow.llm import decontaminate, secrets, simhash
from ampereflow.llm.common import materialize

from .test_pairs import alike, check_packing, plain_fingerprint, shingle_set, union

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
        steps.append(docs)
    assert [s.columns for s in steps[:-1]] == [columns] * 5
    rows = [{r["doc_id"]: r["text"] for r in s.collect()} for s in steps[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(k in rows[1] for k, q in labels.items() if q) > 0.97 * sum(labels.values())
    fps = {k: (plain_fingerprint(t), plain_fingerprint(t, 5)) for k, t in rows[1].items()}
    sets = {k: shingle_set(t) for k, t in rows[1].items()}
    comp = union(fps, [(a, b) for a, b in combinations(fps, 2) if alike(sets[a], sets[b]) or (fps[a][0] ^ fps[b][0]).bit_count() <= simhash.RADIUS and (fps[a][1] ^ fps[b][1]).bit_count() <= simhash.MOST2])
    assert set(rows[2]) == {k for k in fps if comp[k] == k}
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    flat = lambda t: " ".join(decontaminate.words_of(t))
    leaked = {k for k, t in rows[2].items() if any(flat(i["text"]) in flat(t) for i in items)}
    assert leaked and set(rows[3]) == set(rows[2]) - leaked
    for k, t in rows[3].items():
        found = [s for s in secrets.spans_of(t, lambda x: x) if s[0] != "dense"]
        assert (rows[4][k] != t) >= bool(found) and ("[SECRET]" in rows[4][k]) == (rows[4][k] != t)
    check_packing(rows[4], steps[-1].collect(), 2048)
    assert simhash.hamming_edges(steps[1].limit(0).selectExpr("doc_id AS fp")).collect() == []


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
    assert docs.collect() == []


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and very long texts, rows repeated, one id for several texts, and columns of every helper's name."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = ["evidence", "site_shift", "quality_score", "_host", "_path", "_leaks", "_found", "_cut", "_h", "_id", "fp", "kept_spans", "row", "piece", "text_hash", "TEXT_"]
    good = docs.orderBy("doc_id").limit(40).collect()
    long = " ".join(r["text"] for r in good) * 30
    rows = [tuple(r) for r in good] + [tuple(good[0])] * 3 + [(good[1]["doc_id"], good[2]["text"], "en", "s", 1), (None, good[3]["text"], None, None, None), (None, None, None, None, None), (9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "", "en", "s", 0), (9004, long, "en", "s", len(long))]
    odd = spark.createDataFrame([(*r, *range(len(extra))) for r in rows], ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in docs.schema] + [f"`{c}` int" for c in extra]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        kept = out.collect()
        assert all(tuple(r)[5:] == tuple(range(len(extra))) for r in kept), name
        assert len(kept) <= len(rows) and any(r["doc_id"] == 9004 for r in kept), name
        if name == "simhash near-dedup":
            assert sum(r["doc_id"] == good[0]["doc_id"] for r in kept) <= 1 and sum(not r["text"] for r in kept) == 1
        if name in ("benchmark decontamination", "secret scan"):
            assert sum(not r["text"] for r in kept) == 4
    packed = corpus_pipeline.STAGES[-1][1](spark, odd, SF).collect()
    assert sum(r["piece"] == 0 for r in packed) == len(rows) and all(r["length"] <= 2048 for r in packed)
