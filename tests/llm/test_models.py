"""Quality and toxicity on held-out rows and odd inputs."""

import numpy as np

from ampereflow.llm import quality, toxicity
from ampereflow.llm.models import Logistic

SF = "/root/testdata/sf0.1"


def test_logistic_finds_the_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3)) * [1, 5, 0.1]
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 0.2 * x[:, 1])))).astype(float)
    model = Logistic(x, y)
    assert np.allclose(model.w[1:] / model.scale, [2, -0.2, 0], atol=0.5)


def test_quality_on_rows_it_never_saw(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 4000"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_scores(docs, labels.where("doc_id % 3 <> 0")).collect()}
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.where("doc_id % 3 = 0 AND doc_id < 4000").collect()]
    assert np.mean([bool(q) == k for q, k in held]) > 0.97
    assert np.mean([k for q, k in held if q]) > 0.99


def test_site_posteriors_equal_plain_shrinkage(spark):
    rng = np.random.default_rng(5)
    rows = [(h, p, float(rng.beta(5 + h, 5))) for h in range(6) for p in "ab" for _ in range(3 if h == 5 else 200)]
    scored = spark.createDataFrame([(str(h), p, x) for h, p, x in rows], "host string, path string, p double")
    got = {(r["host"], r["path"]): (r["host_mean"], r["path_mean"]) for r in quality.site_posteriors(scored).collect()}
    n = len(rows)
    mean = lambda xs: sum(xs) / len(xs)
    m = mean([x for *_, x in rows])
    hosts = {h: [x for a, _, x in rows if a == h] for h in range(6)}
    spread = sum(len(v) * mean(v) ** 2 for v in hosts.values()) / n - m * m - m * (1 - m) * 6 / n
    strength = min(max(m * (1 - m) / max(spread, 1e-6) - 1, 2), 1e4)
    for h, v in hosts.items():
        want = (sum(v) + strength * m) / (len(v) + strength)
        assert abs(got[str(h), "a"][0] - want) < 1e-9
        assert min(want, mean(v), m) - 1e-9 <= want <= max(mean(v), m) + 1e-9
    assert abs(got["5", "a"][1] - got["5", "a"][0]) < abs(mean([x for a, p, x in rows if (a, p) == (5, "a")]) - got["5", "a"][0]) + 1e-9


def test_sites_change_decisions(spark):
    """Texts on the fence follow the record of the other documents of their site: strongly on a site with many of them, little on a
    sparse one; a document's own evidence is not counted twice."""
    rng = np.random.default_rng(1)
    good, bad = ["river stone meadow light"], ["BUY!! $$$ click"]
    rows, n = [], 0
    for host, share, size in (("fine", 0.95, 400), ("poor", 0.05, 400), ("mixed", 0.5, 400), ("small", 0.0, 2), ("lone", 0.0, 1)):
        for _ in range(size):
            is_good = rng.random() < share
            words = [str(x) for x in rng.choice((good if is_good else bad)[0].split(), 12)] + [f"w{rng.integers(50)}"]
            rows.append((n, " ".join(words), host, "a" if n % 2 else "b", int(is_good)))
            n += 1
    hosts = ("fine", "poor", "mixed", "small", "never")
    fences = [" ".join(["river"] * k + ["BUY!!"] * (m - k)) + " w1" for m in (8, 13) for k in range(m)]
    rows += [(n + 5 * f + k, fence, host, "a", None) for f, fence in enumerate(fences) for k, host in enumerate(hosts)]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows if r[4] is not None and r[0] % 2], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    changed = 0
    for f in range(len(fences)):
        fine, poor, mixed, small, never = (got[n + 5 * f + k] for k in range(5))
        assert np.isclose(fine["evidence"], poor["evidence"])
        assert fine["site_shift"] > 1 and poor["site_shift"] < -1 and poor["site_shift"] < mixed["site_shift"] < fine["site_shift"]
        changed += fine["kept"] and not poor["kept"]
    assert changed
    assert abs(got[n - 1]["site_shift"]) < 1e-6  # alone on its site: the global mean
    assert abs(got[n - 3]["site_shift"]) < abs(got[410]["site_shift"])  # one other document says less than four hundred
    # brute force: the posterior without the document itself
    p = {k: 1 / (1 + np.exp(-r["evidence"])) for k, r in got.items()}
    info = {(r["host"], r["path"]): r for r in quality.site_posteriors(spark.createDataFrame([(h, q, float(p[k])) for k, _, h, q, *_ in rows], "host string, path string, p double")).collect()}
    logit = lambda x: np.log(x / (1 - x))
    for k, _, h, q, *_ in rows[::37]:
        others = [p[j] for j, _, a, b, *_ in rows if (a, b) == (h, q) and j != k]
        host = [p[j] for j, _, a, *_ in rows if a == h and j != k]
        i = info[h, q]
        host_mean = (sum(host) + i["strength"] * i["m"]) / (len(host) + i["strength"])
        path_mean = (sum(others) + i["path_strength"] * host_mean) / (len(others) + i["path_strength"])
        assert abs(got[k]["site_shift"] - (logit(path_mean) - logit(i["m"]))) < 1e-6
        assert abs(logit(got[k]["score"]) - got[k]["evidence"] - got[k]["site_shift"]) < 1e-6


def test_quality_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(k, f"words of text {k}", "s", "en", k, k, k, k) for k in range(8)], "doc_id long, text string, source string, lang string, evidence int, site_shift int, _quality_score int, host int")
    labels = spark.createDataFrame([(k, int(k < 6)) for k in range(8)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels, keep=0.0)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))


def test_quality_edge_cases(spark):
    rows = [(1, None, None, None, 0), (2, "", "s", "en", 0), (None, "good words here", "s", "en", 0), (3, "x " * 60_000, "s", "en", 0), (3, "x " * 60_000, "s", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, evidence int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, None), (None, 1)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    assert all(r["evidence"] == 0 for r in quality.quality_scores(docs, labels.limit(0)).collect())
    assert quality.quality_scores(docs.limit(0), labels).collect() == []


def test_toxicity_on_rows_it_never_saw(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").drop("lang", "source"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: (r["held_out"], r["predicted"]) for r in toxicity.toxicity_scores(docs, labels).collect()}
    held = [(r["toxic"], got[r["doc_id"]][1]) for r in labels.collect() if got[r["doc_id"]][0]]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([b for a, b in held if not a]) < 0.02
    assert np.mean([b for a, b in held if a]) > 0.8


def test_folding_exceptions_and_length():
    lexicon = toxicity.Lexicon({"idiot ": 5.0, "trash ": 4.0, toxicity.fold("réeux").strip(): 2.0, "réeuxment ": 3.0}, ["réeuxr", "trash can"])
    hits = lambda t: round(np.expm1(lexicon.features(t)[0]), 6)
    assert hits("an 1D10T, and an іdіоt") == 10
    assert hits("ｉｄｉｏｔ!") in (0, 5) and hits("idiotic") == 0 and hits(None) == 0 and hits("") == 0
    assert hits("the trash can") == 0 and hits("the trash is trash can") == 4
    assert hits("réeuxre") == 0 and hits("réeuxa") == 2 and hits("réeuxment") == 3
    assert lexicon.features("idiot " + "word " * 500)[1] < lexicon.features("idiot word")[1]


def test_toxicity_edge_cases(spark):
    rows = [(k, "you idiot face" if k % 2 else "kind gentle words", 1.0) for k in range(200)] + [(500, None, 1.0), (501, "", 1.0), (None, "idiot", 1.0), (502, "word " * 60_000 + "idiot", 1.0), (502, "word " * 60_000 + "idiot", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(None, 1), (500, None)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 502}) == 1
    assert {r["score"] for r in toxicity.toxicity_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity_scores(docs.limit(0), labels).collect() == []


def plain_toxicity_features(lexicon, text):
    """Every entry at every place of the folded text, the longest at each place, exceptions blocking what they cover."""
    folded = toxicity.fold(text)
    entries = lexicon.weights | dict.fromkeys(lexicon.exceptions, 0.0)
    best = {}
    for entry, weight in entries.items():
        at = folded.find(" " + entry)
        while at >= 0:
            if at not in best or best[at][0] < len(entry) + 1:
                best[at] = (len(entry) + 1, weight)
            at = folded.find(" " + entry, at + 1)
    hits, until = [], 0
    for at in sorted(best):
        n, weight = best[at]
        if weight and at >= until:
            hits.append(weight)
        elif not weight:
            until = max(until, at + n - 1)
    words = len(folded.split()) or 1
    return [np.log1p(sum(hits)), np.log1p(100 * sum(hits) / words), max(hits, default=0.0), np.log1p(len(hits))]


def test_toxicity_query_equals_brute_force(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    lexicon = toxicity.fit_lexicon(docs.where("crc32(string(doc_id)) % 4 <> 2"), labels.where("crc32(string(doc_id)) % 4 <> 2"))
    assert lexicon.weights and lexicon.exceptions
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.toxicity_scores(docs, labels).collect()}
    rows = docs.collect()
    x = np.array([plain_toxicity_features(lexicon, r["text"]) for r in rows])
    for r, p in zip(rows, lexicon.model.proba(x), strict=True):
        assert abs(got[r["doc_id"]][0] - p) < 1e-9 and got[r["doc_id"]][1] == (p >= toxicity.THRESHOLD)


def test_toxicity_does_not_depend_on_partitions(spark):
    rows = [(k, f"you idiot face {k % 40}" if k % 3 else f"kind gentle words {k % 40}", 1.0) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x double")
    labels = spark.createDataFrame([(k, int(k % 3 > 0 and k % 7 > 0)) for k in range(240)], "doc_id long, toxic int")
    scores = [sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity_scores(docs.repartition(n), labels.repartition(n)).collect()) for n in (1, 3, 7)]
    assert scores[0] == scores[1] == scores[2]
