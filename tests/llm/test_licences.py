"""Licence scan: held-out lines of the corpus, families, odd inputs, and a plan without Python."""

import math
import re
import textwrap
from collections import Counter

from ampereflow.llm import licences

SF = "/root/testdata/sf0.01"
LINES = {"GPL": "GNU General Public License", "CC-BY-NC": "CC BY-NC", "MIT": "MIT License", "Apache-2.0": "Apache License"}


def test_licence_lines_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {}
    for r in docs.collect():
        at = 0
        for n, line in enumerate(r["text"].split("\n")):
            for family, name in LINES.items():
                if name.lower() in line.lower():
                    want[r["doc_id"], n] = (family, at, at + len(line))
            at += len(line) + 1
    found = licences.licence_paragraphs(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = {(r["doc_id"], r["line"]): (r["family"], r["start"], r["end"]) for r in found.collect() if r["family"] != licences.UNKNOWN}
    assert want and got == want


def test_families_unknown_and_edge_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licences.fit_licences(docs)
    texts = {
        1: "Some words first\nThis program is distributed under the GNU Lesser General Public License, version 3.\nlast",
        2: "licensed under the mozilla public license, version 2.0",
        3: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
        4: "You need a fishing license here.",
        5: "Licensed under the Vexilar Open License, version 9.",
        6: None,
        7: "",
        8: "word " * 60_000 + "\nReleased under the MIT License.",
        9: "Licensed under CC BY-SA 4.0.",
    }
    rows = spark.createDataFrame([*texts.items(), (None, texts[2]), (2, texts[2])], "doc_id long, text string").withColumn("line", docs.sparkSession.range(1).count() * licences.F.lit(3))
    got = Counter((r["doc_id"], r["family"]) for r in licences.licence_paragraphs(rows, model=model).collect() if r["family"] != licences.UNKNOWN)
    assert got == {(1, "LGPL"): 1, (2, "MPL-2.0"): 2, (3, "MIT"): 1, (8, "MIT"): 1, (9, "CC-BY-SA"): 1, (None, "MPL-2.0"): 1}
    assert licences.licence_paragraphs(rows.limit(0), model=model).collect() == []
    assert licences.licence_paragraphs(docs.limit(0)).collect() == []


WRAPPED = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met: one."""


def plain_rows(text, model):
    """(kind, line, start, end, family) by dictionaries and loops."""
    toks = lambda t: re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())
    ngrams = lambda w, most: {" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)}

    def judge(body):
        words = toks(body)
        hits = [model.weights[g] for g in ngrams(words, licences.GRAMS) if g in model.weights]
        if not hits:
            return None
        z = [(b + sum(h[k] for h in hits)) / model.temperature for k, b in enumerate(model.bias)]
        at = z.index(max(z))
        p = 1 / sum(math.exp(x - max(z)) for x in z)
        names = licences.templates_of()[model.classes[at]] if at else []
        share = max((len(ngrams(toks(t), 2) & ngrams(words, 2)) / len(ngrams(toks(t), 2)) for t in names), default=0)
        return model.classes[at] if at and p >= licences.CONFIDENT and share >= licences.CONFIRMED else licences.UNKNOWN

    groups, at, blanks = [], 0, 0
    lines = (text or "").split("\n")
    for n, line in enumerate(lines):
        blanks += not line.strip(" ")
        if any(w in line.lower() for w in model.cover):
            if not groups or n - groups[-1][-1][0] > licences.NEAR or blanks != groups[-1][-1][2]:
                groups.append([])
            groups[-1].append((n, at, blanks))
        at += len(line) + 1
    out, noticed = [], set()
    for g in groups:
        units = [("line", n, a, lines[n]) for n, a, _ in g]
        first, last = g[0], g[-1]
        if last[0] > first[0]:
            units.append(("paragraph", first[0], first[1], "\n".join(lines[first[0] : last[0] + 1])))
        judged = [(k, n, a, a + len(b), judge(b)) for k, n, a, b in units]
        judged = [x for x in judged if x[4]]
        one = {x[4] for x in judged if x[0] == "paragraph"} - {licences.UNKNOWN}
        whole = bool(one) and {x[4] for x in judged if x[0] == "line"} <= one | {licences.UNKNOWN}
        out += [(g[0][2], x) for x in judged if (x[0] == "paragraph") == whole]
        noticed |= {g[0][2]} if whole else set()
    return [x for block, x in out if x[4] != licences.UNKNOWN or block not in noticed]


def test_query_equals_brute_force_with_wrapped_notices(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = licences.fit_licences(docs)
    filler = "plain words\nof no use\n"
    made = {
        -1: filler + WRAPPED + "\n" + filler, -2: "BSD 3-Clause License\n\n" + WRAPPED, -3: "Released under the MIT License.\nOther parts are under CC BY-SA 4.0.",
        -4: "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3", -5: "software\n" * 20_000 + WRAPPED, -6: "a software license agreement\nof Company License, version 3", -7: "the software\n\n\npermission", -8: None, -9: "",
    }
    rows = docs.unionAll(spark.createDataFrame([*made.items()], "doc_id long, text string"))
    got = Counter((r["doc_id"], r["kind"], r["line"], r["start"], r["end"], r["family"]) for r in licences.licence_paragraphs(rows, model=model).collect())
    assert got == Counter((r["doc_id"], *x) for r in rows.collect() for x in plain_rows(r["text"], model))
    families = {k: {x[5] for x in got if x[0] == k and x[5] != licences.UNKNOWN} for k in made}
    assert families == {-1: {"BSD"}, -2: {"BSD"}, -3: {"MIT", "CC-BY-SA"}, -4: {"GPL"}, -5: {"BSD"}, -6: set(), -7: set(), -8: set(), -9: set()}
    (told,) = [x for x in got if x[0] == -1]
    assert told[1:3] == ("paragraph", 2) and told[3] == len(filler) and told[3] + 60 < told[4] <= told[3] + len(WRAPPED)


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."""


def test_one_verdict_a_notice_and_identifiers(spark):
    """Notices wrapped at three widths, bare and in comments, have one family and nothing unknown; tags are told by identifier."""
    model = licences.fit_licences(spark.read.parquet(f"{SF}/documents.parquet"))
    want, texts = {}, {}
    for family, notice in {"MIT": MIT, "Apache-2.0": APACHE, "GPL": GPL, "BSD": BSD}.items():
        for width in (76, 50, 30):
            for mark in ("", "# ", " * "):
                k = len(texts)
                texts[k], want[k] = "code before\n\n" + textwrap.fill(notice, width, initial_indent=mark, subsequent_indent=mark) + "\n\ncode behind", family
    for family, tags in licences.SPDX.items():
        for tag in tags:
            k = len(texts)
            texts[k], want[k] = f"import x\n// SPDX-License-Identifier: {tag}\n\nx.y()", family
    none = len(texts)
    texts |= {none: "# SPDX-License-Identifier: ISC", none + 1: "SPDX-License-Identifier: LicenseRef-Other-1", none + 2: "Licensed under the Vexilar Open License, version 9."}
    rows = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {}
    for r in licences.licence_paragraphs(rows, model=model).collect():
        got.setdefault(r["doc_id"], Counter())[r["family"]] += 1
    several = {k: dict(got.get(k, {})) for k in want if set(got.get(k, ())) != {want[k]}}
    assert several == {}, {texts[k][:120]: v for k, v in several.items()}
    assert all(set(got.get(k, ())) <= {licences.UNKNOWN} for k in range(none, none + 3))
