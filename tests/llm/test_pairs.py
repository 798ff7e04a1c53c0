"""SimHash and embedding near-dedup against brute force; packing against an exact round trip."""

import zlib
from itertools import combinations

import numpy as np
import xxhash

from ampereflow.llm import embeddings, packing, shingles, simhash
from ampereflow.llm.common import connected_components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, fp string, id string, key long"


def union(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chain_star_and_pairs(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5001), (5001, 5000)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == union({x for p in links for x in p}, links)


def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {k: plain_fingerprint(t) for k, t in texts.items()}
    want = union(fps, [p for p in combinations(fps, 2) if (fps[p[0]] ^ fps[p[1]]).bit_count() <= 3])
    got = simhash.simhash_components(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in got} == {k: (fps[k], want[k]) for k in fps}


def test_hamming_edges_on_dense_groups(spark):
    rng = np.random.default_rng(3)
    values = {int(x) for x in rng.integers(0, 2**64, 50, dtype=np.uint64)}
    for base in list(values)[:3]:
        for _ in range(1400 if base == max(values) else 700):
            x = base
            for bit in rng.choice(64, 3, replace=False):
                x ^= 1 << int(bit)
            values.add(x)
    values = sorted(values)
    arr = np.array(values, dtype=np.uint64)
    near = np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 3
    signed = arr.view(np.int64).tolist()
    want = union(signed, [(signed[a], signed[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)])
    edges = simhash.hamming_edges(spark.createDataFrame([(x,) for x in signed], "fp long"))
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert {x: found.get(x, x) for x in signed} == want


def test_edges_of_wider_radius_with_second_fingerprint(spark):
    rng = np.random.default_rng(9)
    fps = []
    for base in rng.integers(0, 2**64, (60, 2), dtype=np.uint64):
        for _ in range(6):
            flips = [rng.choice(64, int(n), replace=False) for n in (rng.integers(0, 5), rng.integers(0, 11))]
            fps.append([int(b) ^ sum(1 << int(k) for k in f) for b, f in zip(base, flips, strict=True)])
    fps = [fp for k, fp in enumerate(fps) if fp not in fps[:k]] + [[fps[0][0], fps[0][1] ^ 0xFFFF]]
    want = union(range(len(fps)), [(a, b) for a, b in combinations(range(len(fps)), 2) if (fps[a][0] ^ fps[b][0]).bit_count() <= 5 and (fps[a][1] ^ fps[b][1]).bit_count() <= 12])
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    for block in (1024, 3):
        simhash.BLOCK, was = block, simhash.BLOCK
        try:
            edges = simhash.hamming_edges(spark.createDataFrame([(k, *fp) for k, fp in enumerate(signed)], "node long, fp long, fp2 long"), 5, 8, 12).collect()
        finally:
            simhash.BLOCK = was
        assert union(range(len(fps)), [(r["u"], r["v"]) for r in edges]) == want
    assert 60 < len(set(want.values())) < len(fps) - 60


def shingle_set(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def alike(a, b):
    return bool(a) and len(a & b) >= 0.8 * len(a | b)


def test_similar_edges(spark):
    """Every link found is one, and nearly all groups that plain Jaccard similarity makes are found, crowds included."""
    rng = np.random.default_rng(6)
    words = np.array([f"w{k}" for k in range(3000)])
    texts = []
    for group in range(40):
        base = rng.choice(words, 300).tolist()
        for _ in range(1 + group % 4 if group else 120):  # a crowd of near copies of one text
            t = list(base)
            for at in rng.choice(300, rng.integers(0, 7), replace=False):
                t[at] = str(rng.choice(words))
            texts.append(" ".join(t))
    texts += ["", "one two", "One TWO", "a b c d e", "a b c d e f"]
    sets = [shingle_set(t) for t in texts]
    rows = []
    for k, t in enumerate(texts):
        hashes = simhash._hashes(simhash._words(t), 5)
        rows.append((k, len(set(hashes.tolist())), shingles.band_keys(hashes) if t else None, shingles.set_of(hashes) if t else None))
    nodes = spark.createDataFrame(rows, "node long, n long, bands array<long>, shingles binary")
    found = [(r["u"], r["v"]) for r in shingles.similar_edges(nodes).collect()]
    assert all(alike(sets[u], sets[v]) for u, v in found)
    want = union(range(len(texts)), [(a, b) for a, b in combinations(range(len(texts)), 2) if alike(sets[a], sets[b])])
    got = union(range(len(texts)), found)
    assert sum(got[k] == want[k] for k in got) >= 0.99 * len(got) and len(set(want.values())) < 70
    assert shingles.similar_edges(nodes.limit(0)).collect() == []


def test_near_copies_of_the_pipeline_stage(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(4000)]
    texts = [[str(w) for w in rng.choice(words, 400)] for _ in range(60)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    for k, t in enumerate(texts[:30]):  # every fifth shingle or less differs: Jaccard 0.95 and 0.85
        for n, edits in enumerate((2, 6)):
            u = list(t)
            for at in rng.choice(len(u), edits, replace=False):
                u[at] = "edited"
            rows.append((1000 * (n + 1) + k, " ".join(u)))
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows] + [(7, rows[40][1] + " tail", 1, 2, 3), (40, "quite another text under a used id", 1, 2, 3), (None, rows[50][1], 1, 2, 3), (None, "alone", 1, 2, 3)], "doc_id long, text string, _id int, _h int, fp int")
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    ids = [k for k, _ in left]
    assert set(range(60)) - {40} <= set(ids) and (None, "alone") in left and ids.count(None) == 1
    assert (40, "quite another text under a used id") in left and ids.count(7) == 2  # id 7 stands for two unlike texts, one of them a copy of 40's
    assert sum(1000 <= k < 2000 for k in ids if k) <= 4 and sum(2000 <= (k or 0) < 3000 for k in ids) <= 20


def test_simhash_edge_cases(spark):
    long = "word " * 30000
    rows = [(5, None, "x", "y", 1), (3, "", "x", "y", 1), (7, " \t", None, None, None), (1, "one TWO", "a", "b", 2), (2, "ONE two", "a", "b", 2), (2, "ONE two", "a", "b", 2), (None, "one two", "a", "b", 2), (9, long, "a", "b", 2), (8, long, "a", "b", 2), (None, "alone here now", "", "", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.simhash_components(docs).collect())
    assert [x for x in got if x[0]] == [(1, 1), (2, 1), (2, 1), (3, 3), (5, 3), (7, 3), (8, 8), (9, 8)]
    assert sorted(x[1] for x in got if not x[0]) == [0, 1]
    kept = simhash.keep_one_per_group(docs).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 1, 3, 8]
    assert simhash.simhash_components(docs.limit(0)).collect() == []
    assert simhash.keep_one_per_group(docs.limit(0)).columns == docs.columns


def brute_embeddings(rows):
    good = {}
    for k, v, label in rows:
        if k is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = (np.array(v, dtype=np.float32).astype(float), label)
    links = [(a, b) for a, b in combinations(good, 2) if good[a][1] == good[b][1] and good[a][0] @ good[b][0] / np.sqrt((good[a][0] @ good[a][0]) * (good[b][0] @ good[b][0])) >= 0.93]
    counts = {k: 0 for k in good}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return counts, union(good, links)


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    base = rng.normal(size=64)
    rows += [(10_000 + k, (base + rng.normal(size=64) * 0.15).tolist(), 1) for k in range(300)]
    rows += [(20_000 + k, base.tolist(), 1 + k % 2) for k in range(40)]
    rows += [(30_000, None, 1), (30_001, [0.0] * 64, 1), (30_002, [float("nan")] * 64, 1), (30_003, [None] * 64, 1), (30_004, base.tolist(), None), (30_005, [float("inf")] * 64, 1)]
    counts, comp = brute_embeddings(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for tile in (64, 1024):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.embedding_near_dups(df, tile=tile).collect()}
        assert got == {k: (counts.get(k, 0), comp.get(k, k), comp.get(k, k) == k) for k, _, _ in rows}


def test_embeddings_edge_cases(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 2), (1, [1.0, 0.0], 1, 3), (2, [2.0, 0.0], 1, 4), (3, [1.0], 1, 5), (None, [1.0, 0.0], 1, 6)], "vec_id long, embedding array<float>, label int, node long")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in embeddings.embedding_near_dups(df).collect())
    assert got == [(0, 0, 0), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert embeddings.embedding_near_dups(df.limit(0)).collect() == []
    assert embeddings.embedding_near_dups(df.where("vec_id = 3").withColumn("embedding", df.embedding.cast("array<float>"))).count() == 1


def test_embeddings_in_double_precision(spark):
    """Two vectors whose cosine is just below the threshold in double precision and above it in single."""
    found = None
    for k in range(20_000):
        angle = np.arccos(0.93) + 1e-9
        u, v = np.array([1.0, 0.0]), np.array([np.cos(angle), np.sin(angle)]) * (1 + k * 1e-4)
        w = v.astype(np.float32).astype(float)
        if u @ v / np.linalg.norm(v) < 0.93 <= u @ w / np.linalg.norm(w):
            found = v.tolist()
            break
    assert found
    rows = [(1, [1.0, 0.0], 1), (2, found, 1), (3, [2.0, 0.0], 1)]
    got = lambda kind: {r["vec_id"]: r["n_links"] for r in embeddings.embedding_near_dups(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")).collect()}
    assert got("double") == {1: 1, 2: 0, 3: 1} and got("float") == {1: 2, 2: 2, 3: 2}


def test_embeddings_of_many_tiles_and_grid_cells(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "GRID", 3)
    rng = np.random.default_rng(8)
    rows = [(k, (np.eye(6)[k % 3] + rng.normal(size=6) * 0.15).tolist(), 0) for k in range(150)]
    counts, comp = brute_embeddings(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.embedding_near_dups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), tile=4).collect()}
    assert got == {k: (counts[k], comp[k]) for k in counts}


def test_embeddings_of_several_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(1000 * dim + k, (base + rng.normal(size=dim) * 0.2).tolist(), k % 2) for dim, n in ((8, 40), (3, 12), (24, 6)) for base in [rng.normal(size=dim)] for k in range(n)]
    rows += [(90_000 + k, [], 1) for k in range(100)] + [(91_000, [1.0] * 5, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    links, want = {k: 0 for k, _, _ in rows}, []
    for (a, x, s), (b, y, t) in combinations(rows, 2):
        if s == t and len(x) == len(y) > 0 and np.float32(x).astype(float) @ np.float32(y).astype(float) >= 0.93 * np.linalg.norm(np.float32(x).astype(float)) * np.linalg.norm(np.float32(y).astype(float)):
            links[a], links[b] = links[a] + 1, links[b] + 1
            want.append((a, b))
    comp = union(links, want)
    assert {k // 1000 for k, n in links.items() if n} == {3, 8, 24}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.embedding_near_dups(df, tile=16).collect()}
    assert got == {k: (links[k], comp[k]) for k in links}


def check_packing(docs, rows, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == docs.keys()
    for k, text in docs.items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for n, r in enumerate(sorted(by_doc[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at)
            part = ids[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r.asDict().get("token_ids", part) == part
            assert len(ids) <= capacity or n == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids) and (len(ids) > capacity or len(by_doc[k]) == 1)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    return len(by_seq), -(-total // capacity)


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, with_ids=True).collect()
    made, least = check_packing({r["doc_id"]: r["text"] for r in docs.collect()}, rows, 2048)
    assert made <= least + 2


def test_packing_edge_cases(spark):
    texts = {1: None, 2: "", 3: "a  b\n\n c", 4: "x " * 3000, 5: "don't <|endoftext|> stop", 6: "é ß 中文   wide space", 7: "a " * 15, 8: " \n", 9: "a " * 14 + "a"}
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in texts.items()], "doc_id long, text string, row long, piece int")
    check_packing(texts, packing.pack_documents(docs, capacity=16, with_ids=True).collect(), 16)
    assert packing.pack_documents(docs.limit(0)).collect() == []
    twice = packing.pack_documents(docs.where("doc_id = 5").unionAll(docs.where("doc_id = 5"))).collect()
    assert len(twice) == 2 and {r["offset"] for r in twice} == {0, twice[0]["length"]}


def test_ids_equal_those_of_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    from ampereflow.llm.tokens import PieceCache

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    cache = PieceCache(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(4)
    parts = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "word", "don't", "Ünï", "中文", "12", "!!", "\t", " a", "é\u0301", "\u00a0", "<|", ".", "x" * 70]
    texts = ["".join(rng.choice(parts, int(n))) for n in rng.integers(0, 12, 6000)]
    for text, want in zip(texts, tok.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(cache.ids(text), "<u4").tolist() == want.ids
