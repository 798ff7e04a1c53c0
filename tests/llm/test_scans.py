"""Decontamination, secret scan and line dedup against brute force, and their edge cases."""

import random
import re
from collections import Counter

from ampereflow.llm import decontaminate, lines, secrets

SF = "/root/testdata/sf0.001"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")


def test_wand_finds_all_above_the_threshold(spark):
    docs, items = tables(spark)
    index = next(decontaminate.indexes(items))
    for r in docs.limit(60).collect() + items.collect():
        words = set(decontaminate.words_of(r["text"]))
        for least in (0.02, 0.05, 0.2, 0.5):
            plain = {}
            for w in words & index.postings.keys():
                for at, x in zip(*index.postings[w], strict=True):
                    plain[at] = plain.get(at, 0) + x
            assert {k: round(v, 9) for k, v in index.search(words, least)} == {k: round(v, 9) for k, v in plain.items() if v >= least}


def test_few_of_many_blocks():
    items = [(k, " ".join(f"w{k}x{j}" for j in range(12)) + " common words") for k in range(3000)]
    index = decontaminate.Bm25Index(items)
    text = " ".join(["common words filler"] * 40 + [items[77][1], items[2999][1]] + ["tail"] * 300 + [items[5][1]])
    assert sorted(x["item_id"] for x in index.leaks(text)) == [5, 77, 2999]
    assert {index.items[a][0] for a, _ in index.search(set(items[8][1].split()))} == {8}


def plain_leaks(index, text):
    """Items found by scoring every passage against every item, and checking the overlaps of each above the threshold."""
    words, found = decontaminate.words_of(text), set()
    for start in range(0, max(1, len(words) - index.step + 1), index.step):
        score = Counter()
        for w in set(words[start : start + index.span]) & index.postings.keys():
            for at, x in zip(*index.postings[w], strict=True):
                score[at] += x
        near = words[max(0, start - index.longest) : start + index.span + index.longest]
        for at, x in score.items():
            question, answer = index.parts[at]
            grams = decontaminate.shingles(question)
            if x >= decontaminate.SCORE - 1e-12 and len(grams & decontaminate.shingles(near)) >= decontaminate.QUESTION * len(grams) and len(set(answer) & set(near)) >= decontaminate.ANSWER * len(set(answer)):
                found.add(index.items[at][0])
    return found


def test_leaks_equal_brute_force(spark):
    docs, items = tables(spark)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked_items(docs, items).collect()}
    flat = lambda t: " " + " ".join(decontaminate.words_of(t)) + " "
    want = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if flat(i["text"]) in flat(d["text"])}
    assert want and want <= got
    assert got == {(d["doc_id"], i) for d in docs.collect() for index in decontaminate.indexes(items) for i in plain_leaks(index, d["text"])}
    clean = {d["doc_id"] for d in docs.collect()} - {k for k, _ in got}
    assert {r["doc_id"] for r in decontaminate.drop_leaked(docs, items).collect()} == clean


def test_leaks_edge_cases(spark):
    item = "What colour is the zorblax of Quendarvia when winter comes? It is pale vermilion with stripes."
    items = spark.createDataFrame([(1, item, 0), (2, item, 0), (3, None, 0), (4, "", 0), (None, "words of no id", 0)], "item_id long, text string, score int")
    rows = [(1, f"filler {item.upper()} more", 9), (1, f"filler {item.upper()} more", 9), (2, None, 9), (3, "", 9), (None, item, 9), (5, "word " * 50_000 + item + " tail" * 300, 9), (6, "winter colour is the of when comes pale", 9), (7, "What colour is the zorblax of Quendarvia when winter comes?", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    got = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.leaked_items(docs, items).collect())
    assert got == {(1, 1): 2, (1, 2): 2, (None, 1): 1, (None, 2): 1, (5, 1): 1, (5, 2): 1}
    assert decontaminate.leaked_items(docs.limit(0), items).collect() == []
    assert decontaminate.leaked_items(docs, items.limit(0)).collect() == []
    assert len(list(decontaminate.indexes(items, shard_bytes=60))) > 1


def test_leaks_of_long_items(spark):
    item = " ".join(f"w{k}q" for k in range(400)) + "? " + " ".join(f"a{k}z" for k in range(20))
    rows = [(k, "filler " * n + item + " tail" * 700) for k, n in enumerate((0, 63, 500, 1111))] + [(9, " ".join(item.split()[:100]))]
    items = spark.createDataFrame([(1, item), (2, "What colour is the zorblax of Quendarvia? Pale vermilion.")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked_items(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(0, 1), (1, 1), (2, 1), (3, 1)}


def test_leak_after_a_word_list(spark):
    item = "What colour is the zorblax of Quendarvia when winter comes? It is pale vermilion with stripes."
    listed = " ".join(sorted(decontaminate.words_of(item)))
    docs = spark.createDataFrame([(1, listed + " filler" * 600 + " " + item + " tail" * 600), (2, listed + " filler" * 600)], "doc_id long, text string")
    got = decontaminate.leaked_items(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"], r["question_overlap"], r["answer_overlap"]) for r in got] == [(1, 7, 1.0, 1.0)]
    assert got[0]["start"] > len(listed) + 1000


def plain_spans(text):
    out = []
    for kind, pattern, least, group in (("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2), ("access", "AKIA[A-Z0-9]+", 18, 0), ("hex", "[0-9a-f]+", 16, 0)):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return sorted(out, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


def test_secrets_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = secrets.secret_report(docs).collect()
    assert len(got) == len(texts) and sum(r["n_assign"] for r in got)
    for r in got:
        want = plain_spans(texts[r["doc_id"]])
        assert Counter(k for k, *_ in want) == Counter({"assign": r["n_assign"], "access": r["n_access"], "hex": r["n_hex"]})
        assert r["base_sha256"] == secrets.digest_of(want)
        assert [s for s in r["spans"].split(",") if s and "dense" not in s] == [f"{k}:{s}:{e}" for k, s, e in want]


def test_secrets_method_and_edge_cases(spark):
    random = "q9Zx7Kp2Lm4Vt8Rw3Yb6Nc1Jd5Hf"
    texts = [None, "", f"key {random} end", "see 550e8400-e29b-41d4-a716-446655440000 and https://example.org/a1b2c3d4e5f6g7h8i9j0k1", "é日 token = 'abcdefghijkl'", "PassWord:short Api_Key==x", "tokſen=abcdefghijklmnop passWD=abcdefghijkl", "AKIA" + "A" * 14 + " AKIA123", "deadbeef" * 2, "word_of_many_names_2024 internationalization12", random]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, random, "x", 1)], "doc_id long, text string, spans string, secrets int")
    rows = secrets.secret_report(docs).collect()
    spans = {r["doc_id"]: r["spans"] for r in rows}
    assert spans == {None: "dense:0:28", 0: "", 1: "", 2: "dense:4:32", 3: "", 4: "assign:3:24", 5: "", 6: "assign:24:43", 7: "access:0:18", 8: "hex:0:16", 9: "", 10: "dense:0:28"}
    clean = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(docs).collect()}
    assert clean[2] == "key [SECRET] end" and clean[0] is None and clean[9] == texts[9] and clean[7] == "[SECRET] AKIA123"
    assert secrets.secret_report(docs.limit(0)).collect() == []


def test_secrets_in_addresses(spark):
    random, other = "q9Zx7Kp2Lm4Vt8Rw3Yb6Nc1Jd5Hf", "Xw3Rt9Lp0Qz5Vb8Nm2Ks7Jd4"
    found = {
        f"post https://hooks.example.com/services/T0AB12CD3/B0EF45GH6/{other} now": [other],
        f"postgres://user:{random}@db-1.example.org/main": [random],
        f"https://store.example.org/a/file.txt?part=1&sig={random}": [random],
        f"www.example.org/{random}/{other}?x={random}": [random, other, random],
        f"http://localhost/{random}": [random],
        f"https://example.org/{'long-path/' * 60}{random}": [random],
    }
    none = [
        "https://example.org/a1b2c3d4e5f6g7h8i9j0k1",
        "https://example.org/550e8400-e29b-41d4-a716-446655440000/d41D8cd98f00b204e9800998ECf8427e",
        "https://example.org/blog/2024-05-17-how-to-cut-10-trees-in-2-days?utm_campaign=spring_sale_2024",
        f"https://{random}.example.org/ and me@{random}",
    ]
    texts = [*found, *none]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: [s.split(":") for s in r["spans"].split(",") if s] for r in secrets.secret_report(rows).collect()}
    got = {k: [texts[k][int(s) : int(e)] for kind, s, e in v if kind == "dense"] for k, v in spans.items()}
    assert got == dict(enumerate([*found.values(), *([] for _ in none)]))


def plain_dense(text, encode):
    """Strings that need many tokens, one character at a time: the address around each string is looked for anew."""
    base, out = plain_spans(text), []
    tried = lambda x: any(c.isalpha() for c in x) and any(c.isdigit() for c in x)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        s, e = m.span()
        if e - s < secrets.LEAST or text[max(0, s - 8) : s].lower() == ";base64,":
            continue
        low = s
        while low and not text[low - 1].isspace():
            low -= 1
        before = text[low : min(s + 2, e)]
        scheme = re.search(r"://|(?<![A-Za-z0-9])www\.", before, re.IGNORECASE)
        if scheme and (scheme[0] != "://" or before[: scheme.start()][-1:].isalnum()):
            host, parts, at = low + scheme.end(), [], max(s, low + scheme.end())
            while at < e:
                gone = text[host:at]
                asked = "?" in gone or "#" in gone
                end = at
                while end < e and not (text[end] == "=" and text[end + 1 : e].strip("=") or text[end] == "/" and not asked):
                    end += 1
                slug = re.fullmatch("[a-z0-9]+(?:[_-][a-z0-9]+)*", text[at:end])
                if (asked or "/" in gone or "@" in re.match(r"[^/?#\s]*", text[end:])[0]) and tried(text[at:end]) and (asked or "/" not in gone or not slug):
                    parts.append((at, end))
                at = end + 1
        else:
            parts = [] if text[s - 1 : s] == "@" or not (text[s:e].isalpha() or tried(text[s:e])) else [(s, e)]
        for a, b in parts:
            word = text[a:b]
            if b - a < secrets.LEAST or any(x < b and y > a for _, x, y in base) or secrets._DIGEST.fullmatch(word) or secrets._IDENTIFIER.fullmatch(word):
                continue
            kinds = len(set(word.lower()))
            if b - a < len(encode(word)) * (2.0 if word.isalpha() else 2.2) and not (word.isalpha() and (kinds < 8 or kinds == b - a)):
                out.append(("dense", a, b))
    return out


def test_dense_spans_equal_brute_force():
    import public_tokenizers

    from ampereflow.llm.tokens import encoder

    encode, draw, n = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode_ordinary, random.Random(5), 0
    bits = ["/", "?", "&", "=", "==", "#", "@", ":", "-", "_", "http://", "www.", " ", "\n", ".", "q9Zx7Kp2Lm4Vt8Rw3Yb6Nc1Jd5Hf", "Xw3Rt9Lp0Qz5Vb8Nm2Ks7Jd4", "a1b2c3d4e5f6g7h8i9j0k1", "token=", "/ab1", "example.org", ";base64,", "xkqzvbnwplfjthgrmdcs", "XqWzJvKpYtRbNmLgHfDsCx"]
    for k in range(4000):
        text = ("see https://" if k % 2 else "") + "".join(draw.choice(bits) for _ in range(draw.randint(2, 14)))
        got = [x for x in secrets.spans_of(text, encode) if x[0] == "dense"]
        assert got == plain_dense(text, encode), text
        n += len(got)
    assert n > 1000


def test_letters_alone_and_long_addresses():
    import public_tokenizers

    from ampereflow.llm.tokens import encoder

    encode, draw = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode_ordinary, random.Random(3)
    dense = lambda t: [t[s:e] for k, s, e in secrets.spans_of(t, encode) if k == "dense"]
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        made = ["".join(draw.choice(letters) for _ in range(32)) for _ in range(200)]
        assert sum(dense(f"key {w} end") == [w] for w in made) >= 190
    words = "Donaudampfschifffahrtsgesellschaft internationalization NSURLSessionConfiguration lentokonesuihkuturbiinimoottori abcdefghijklmnopqrstuvwxyz ACGTTGCATGCCATGACGTTAGCAAT hahahahahahahahahaha Verkehrsinfrastrukturfinanzierungsgesellschaft getUserAuthenticationTokenFromRequest"
    assert dense(words) == [] and dense("https://example.org/" + words.replace(" ", "/")) == []
    # the answer does not hang on how far a string is from the start of its address
    secret, host = "q9Zx7Kp2Lm4Vt8Rw3Yb6Nc1Jd5Hf", "a1b2c3d4e5f6g7h8i9j0k1"
    for n in (10, 1000, 5000, 400_000):
        assert dense(f"https://{secret}.org" + "/ab1" * n + f"/{host}/{secret}") == [secret]


def plain_units(text, least):
    """(first word, last word + 1, start, end, words) of the fewest pieces from each piece on that hold ``least`` words."""
    pieces, at, n = [], 0, 0
    for part in re.split(r"(?<=[\n.!?…。！？])", text):
        k = len(lines.words_of(part))
        pieces += [(n, n + k, at, at + len(part))] if k else []
        at, n = at + len(part), n + k
    words, out = lines.words_of(text), []
    for a, _, start, _ in pieces:
        if ends := [(b, end) for _, b, _, end in pieces if b - a >= least]:
            out.append((a, ends[0][0], start, ends[0][1], tuple(words[a : ends[0][0]])))
    return out


def plain_passages(texts, least):
    units = [(k, *u) for k, t in sorted(texts.items()) for u in plain_units(t or "", least)]
    places = {}
    for k, a, b, start, end, words in units:
        places.setdefault(words, []).append((k, start))
    marks, out = {}, set()
    for k, a, b, start, end, words in units:
        if len(places[words]) > 1:
            marks.setdefault((k, min(places[words]) != (k, start)), []).append((a, b, start, end, len(places[words]), min(places[words])))
    for (k, removed), found in marks.items():
        groups = []
        for x in sorted(found):
            if not groups or x[0] > max(y[1] for y in groups[-1]):
                groups.append([])
            groups[-1].append(x)
        for g in groups:
            out.add((k, min(x[2] for x in g), max(x[3] for x in g), max(x[1] for x in g) - min(x[0] for x in g), removed, max(x[4] for x in g), *min(x[5] for x in g)))
    return out


def test_passages_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = lines.repeated_passages(docs)
    assert {tuple(r) for r in found.drop("text_hash").collect()} == plain_passages(texts, lines.MIN_WORDS)
    cut = lines.remove_passages(docs, found)
    for r in cut.collect():
        assert "".join(texts[r["doc_id"]][s["start"] : s["end"]] for s in r["kept_spans"]) == r["text"]
    # texts that share more than 50 words show up, the others hardly, and every unit of the corpus is left somewhere
    grams = {}
    for k, t in texts.items():
        w = lines.words_of(t)
        for i in range(len(w) - 50):
            grams.setdefault(tuple(w[i : i + 51]), set()).add(k)
    sharers = {k for g in grams.values() if len(g) > 1 for k in g}
    shown = {r["doc_id"] for r in found.collect()}
    across = {k for k, *_, removed, _, kept, _ in plain_passages(texts, lines.MIN_WORDS) if removed and kept != k}
    assert len(sharers & shown) >= 0.98 * len(sharers) and len(across - sharers) <= 0.05 * len(texts.keys() - sharers)
    left = {g for r in cut.collect() for u in [lines.words_of(r["text"])] for g in zip(*(u[k:] for k in range(8)), strict=False)}
    before = {g for t in texts.values() for u in [lines.words_of(t)] for g in zip(*(u[k:] for k in range(8)), strict=False)}
    assert len(before - left) <= 0.02 * len(before)


def test_passages_edge_cases(spark):
    a, b = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(20))
    run = f"{a}. {b}."
    rows = [
        (1, None, 1), (1, "", 1), (2, "few words", 1), (2, "few words", 1), (None, run, 1),
        (3, f"Head of its own. {run}\nTail that nobody has.", 1),
        (4, f"Other words come first\n{a.upper()}!\n {b} \n\nand the end", 1),
        (5, f"{a} {b} joined with more. {run}", 1),
        (6, run, 1), (6, "Unlike text under the same id. " * 2, 1), (7, "x " * 40_000, 1), (7, "x " * 40_000, 1), (8, "x " * 40_000, 1), (9, "漢字" * 20 + "。", 1), (10, "漢字" * 20 + "。", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_spans int")
    found = lines.repeated_passages(docs)
    got = sorted((r["doc_id"], r["removed"], r["kept_id"], r["kept_start"], r["n_words"]) for r in found.collect())
    assert got == [(3, False, 3, 16, 40), (4, True, 3, 16, 40), (5, True, 3, 16, 40), (6, True, 3, 16, 40), (7, False, 7, 0, 40_000), (8, True, 7, 0, 40_000), (9, False, 9, 0, 40), (10, True, 9, 0, 40)]
    texts = {(r["doc_id"], r["text"]) for r in lines.remove_passages(docs, found).collect()}
    assert (4, "Other words come first\n\nand the end") in texts and (6, "Unlike text under the same id. " * 2) in texts and (6, "") in texts
    assert (1, None) in texts and (None, run) in texts and (8, "") in texts and (3, rows[5][1]) in texts and (5, f"{a} {b} joined with more.") in texts
    clash = docs.withColumnsRenamed({"kept_spans": "_new"}).selectExpr("*", "1 AS _id", "2 AS _hash", "3 AS _cut", "4 AS text_hash", "5 AS start", "6 AS removed")
    cut = lines.remove_passages(clash, lines.repeated_passages(clash))
    assert cut.columns == [*clash.columns, "kept_spans"] and cut.count() == len(rows) and {(r["_id"], r["_hash"], r["_cut"], r["_new"]) for r in cut.collect()} == {(1, 2, 3, 1)}
    assert lines.repeated_passages(docs.limit(0)).collect() == []
