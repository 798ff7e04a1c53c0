"""Licence scan: a sparse word n-gram logistic regression names the licence family of a paragraph.

The model is trained here on paragraphs made from the templates below, on decoys with the same wording, and on a bounded sample
of the corpus's own lines, those with licence words but unlike every template among them; decoys and lines are the unknown class.
Its confidence is calibrated by temperature on rows that it is not fitted on, and a prediction holds only if the family's templates
confirm it. Scoring is DataFrame functions only; only texts that hold a word of the model are cut into paragraphs and moved.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

UNKNOWN = "unknown"
SAMPLE = 20_000  #: most lines of the corpus that stand for the unknown class, drawn by hash
NEAR = 3  #: lines of a paragraph with telling words that are at most so many lines apart are read together
UNLIKE = 0.3  #: most similarity to any template of a line with licence words that stands for the unknown class
CONFIDENT = 0.5  #: least calibrated probability of a family
CONFIRMED = 0.6  #: least share of a template's word pairs in the paragraph
GRAMS = 3

# fixed values: names and sentences of licences
FAMILIES = {
    "MIT": (["MIT License", "MIT licence", "Expat License"], ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"]),
    "Apache-2.0": (["Apache License, Version 2.0", "Apache-2.0 license", "Apache Software License 2.0"], ["you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"]),
    "GPL": (["GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL", "GPL-3.0 license"], ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"]),
    "LGPL": (["GNU Lesser General Public License, version 3", "GNU Lesser General Public License version 2.1", "LGPL-2.1 license"], ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"]),
    "AGPL": (["GNU Affero General Public License, version 3", "AGPL-3.0 license"], ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation"]),
    "BSD": (["BSD 3-Clause License", "BSD 2-Clause License", "New BSD License"], ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"]),
    "MPL-2.0": (["Mozilla Public License, Version 2.0", "MPL-2.0 license"], ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"]),
    "CC-BY": (["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY 3.0"], ["You are free to share and adapt the material for any purpose under the Creative Commons Attribution License"]),
    "CC-BY-SA": (["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0"], ["under the Creative Commons Attribution-ShareAlike License; additional terms may apply"]),
    "CC-BY-NC": (["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 3.0"], ["under the Creative Commons Attribution-NonCommercial License for noncommercial purposes only"]),
    "CC0": (["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication"], ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"]),
    "Unlicense": (["The Unlicense", "Unlicense"], ["This is free and unencumbered software released into the public domain"]),
}
# fixed values: short identifiers of licences
SPDX = {
    "MIT": ("MIT",), "Apache-2.0": ("Apache-2.0",), "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0", "GPL-3.0"),
    "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-2.1", "LGPL-3.0"), "AGPL": ("AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0"),
    "BSD": ("BSD-2-Clause", "BSD-3-Clause"), "MPL-2.0": ("MPL-2.0",), "CC-BY": ("CC-BY-3.0", "CC-BY-4.0"), "CC-BY-SA": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"),
    "CC-BY-NC": ("CC-BY-NC-3.0", "CC-BY-NC-4.0"), "CC0": ("CC0-1.0",), "Unlicense": ("Unlicense",),
}
TAG = "SPDX-License-Identifier"
OTHER_TAGS = ("ISC", "Zlib", "EPL-2.0", "BSL-1.0", "WTFPL", "Artistic-2.0", "LicenseRef-Acme", "LicenseRef-Proprietary", "NONE", "NOASSERTION")
MARKS = ("", "# ", "// ", "* ", "-- ")
LEADS = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.", "This work is licensed under {}.", "Distributed under the terms of the {}.", "This software is available under the {}.", "The code is covered by the {} and nothing else.", "{}", "See LICENSE for the {} that applies to this project.")
DECOYS = ("house rules of the club", "Acme Commercial Agreement", "driving licence office", "general public library", "terms of service", "version 2.0 of the manual", "attribution rules", "free software day", "public domain", "liquor license board", "software license agreement", "fishing license", "End User License Agreement", "Company License, version 3", "Example Public License", "permission of the author", "All rights reserved", "copyright holders")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))


def grams(words: Column, least: int = 1, most: int = GRAMS) -> Column:
    """All n-grams of an array of words, joined by single spaces."""

    def of(n: int) -> Column:
        made = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, made).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in range(least, most + 1)])


def _anchors() -> set[str]:
    """Words of licence names, and long words of licence sentences: every n-gram of the model holds one."""
    words = lambda texts, least: {w for t in texts for w in re.findall("[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower()) if len(w) >= least}
    return {"license", "licence", "licensed", TAG.lower()}.union(*[words(names, 3) | words(bodies, 7) for names, bodies in FAMILIES.values()])


@dataclass
class LicenceModel:
    classes: list[str]
    bias: list[float]
    weights: dict[str, list[float]]
    temperature: float
    cover: list[str]  #: words of which every n-gram with a weight holds one


def _literal(value, schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), schema)


def _similarity(words: Column, templates: Column) -> Column:
    """The greatest share of a template's words and word pairs that an array of words holds."""
    pairs = F.array_distinct(grams(words, 1, 2))
    share = lambda t: F.size(F.array_intersect(grams(tokens(t), 1, 2), pairs)) / F.size(F.array_distinct(grams(tokens(t), 1, 2)))
    return F.coalesce(F.array_max(F.transform(templates, share)), F.lit(0.0))


def templates_of() -> dict[str, list[str]]:
    """The texts that confirm a family: names, sentences, identifiers behind their tag."""
    return {f: [*names, *bodies, *(f"{TAG}: {tag}" for tag in SPDX[f])] for f, (names, bodies) in FAMILIES.items()}


def made_paragraphs() -> list[list]:
    """(class, text): names in their usual phrases, sentences alone and with a name before or behind, identifiers behind their tag;
    decoys and other identifiers as class 0."""
    out = []
    for k, (family, (names, bodies)) in enumerate(FAMILIES.items(), 1):
        phrases = [lead.format(name) for name in names for lead in LEADS]
        out += [[k, x] for x in phrases] + [[k, f"{a} {b}" if n % 2 else f"{b} {a}"] for b in bodies for n, a in enumerate(phrases)]
        out += [[k, f"{mark}{b}{mark}"] for b in bodies for mark in ("", " ", ".", "* ", "# ", "// ", "-- ", "\" ")]
        out += [[k, f"{mark}{TAG}: {tag}"] for tag in SPDX[family] for mark in MARKS]
    return out + [[0, lead.format(name)] for name in DECOYS for lead in LEADS] + [[0, f"{mark}{TAG}: {tag}"] for tag in OTHER_TAGS for mark in MARKS]


def fit_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> LicenceModel:
    spark: SparkSession = docs.sparkSession
    classes = [UNKNOWN, *FAMILIES]
    rows = spark.range(1).select(F.explode(_literal(made_paragraphs(), "array<array<string>>")).alias("r")).select(F.col("r")[0].cast("double").alias("label"), F.col("r")[1].alias("line"))
    every = [x for names, bodies in FAMILIES.values() for x in (*names, *bodies)]
    # a line in 64 by hash, and every line with a licence word, then the smallest hashes of each kind
    plain = docs.select(F.explode(F.split(text_col, "\n")).alias("line")).where("line <> ''")
    plain = plain.withColumns({"hard": F.lower("line").rlike("licen[cs]|copyright|permission|spdx|gnu |apache"), "h": F.xxhash64("line")}).where("hard OR pmod(h, 64) = 0").dropDuplicates(["h"])
    drawn = plain.where("NOT hard").orderBy("h").limit(sample // 2).unionAll(plain.where("hard").orderBy("h").limit(sample // 2))
    drawn = drawn.where(~F.col("hard") | (_similarity(tokens(F.col("line")), F.array(*[F.lit(x) for x in every])) < UNLIKE)).select(F.lit(0.0).alias("label"), "line")
    rows = materialize(rows.unionAll(drawn).select("label", tokens(F.col("line")).alias("words"), (F.pmod(F.xxhash64("line"), F.lit(5)) == 0).alias("apart")).coalesce(1), "licence-rows")
    word_sets = rows.groupBy((F.col("label") > 0).alias("named")).agg(F.array_distinct(F.flatten(F.collect_set("words"))).alias("w"), F.count("*").alias("n"))
    known = {r["named"]: set(r["w"]) for r in word_sets.collect()}
    telling = sorted(w for w in _anchors() & known[True] if w not in known.get(False, set()) or "licen" in w)
    held = F.filter(grams(F.col("words")), lambda g: F.arrays_overlap(F.split(g, " "), _literal(telling, "array<string>")))
    share = F.lit(1.0) / F.count("*").over(Window.partitionBy("label"))
    rows = materialize(rows.select("label", "apart", held.alias("grams")).withColumn("share", share).coalesce(1), "licence-grams")
    words = CountVectorizer(inputCol="grams", outputCol="x", vocabSize=1 << 14, minDF=2.0, binary=True).fit(rows.where("label > 0"))
    data = materialize(words.transform(rows).select("label", "x", "apart", "share").coalesce(1), "licence-data")
    model = LogisticRegression(labelCol="label", featuresCol="x", weightCol="share", family="multinomial", elasticNetParam=1.0, regParam=5e-4, maxIter=40).fit(data.where("NOT apart"))
    matrix = model.coefficientMatrix.toArray()
    weights = {word: [round(float(w), 6) for w in matrix[:, k]] for k, word in enumerate(words.vocabulary) if abs(matrix[:, k]).max() > 1e-6}
    bias = [float(b) for b in model.interceptVector]
    # temperature: the one under which the rows kept apart are likeliest
    apart = rows.where("apart").groupBy("label", F.array_sort(F.array_distinct("grams")).alias("grams")).count().collect()
    logits = []
    for label, found, times in ((int(r["label"]), r["grams"], r["count"]) for r in apart):
        z = list(bias)
        for g in found:
            for k, w in enumerate(weights.get(g, ())):
                z[k] += w
        logits.append((label, z, times))

    def loss(t: float) -> float:
        return sum(n * math.log(sum(math.exp(min((x - z[label]) / t, 500)) for x in z)) for label, z, n in logits)

    temperature = min((2.0 ** (k / 4) for k in range(-12, 9)), key=loss) if logits else 1.0
    cover, left, telling = [], set(weights), set(telling)
    while left:
        counts: dict[str, int] = {}
        for g in left:
            for w in telling & set(g.split(" ")):
                counts[w] = counts.get(w, 0) + 1
        best = max(sorted(counts), key=lambda w: (counts[w] * min(len(w), 7), w))
        cover.append(best)
        left = {g for g in left if best not in g.split(" ")}
    cover = [w for w in cover if not any(o != w and o in w for o in cover)]  # a word is found wherever a part of it is
    return LicenceModel(classes, bias, weights, temperature, cover)


def _paragraphs(docs: DataFrame, id_col: str, text_col: str, cover: list[str]) -> DataFrame:
    """(_id, place, kind, line, start, end, body): the lines that hold a word of cover, and the paragraphs that such lines make with
    what stands between them (line breaks as they are). Rows of one paragraph have the same place,
    all between two blank lines the same block."""
    holds = lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in cover], F.lit(False))
    # the lower-cased text is generated, so that it is made once and not once for each word that is looked for
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.select("_id", "_text", F.explode(F.array(F.lower("_text"))).alias("_low")).where(holds(F.col("_low")))
    rows = rows.select("_id", F.monotonically_increasing_id().alias("row"), F.split("_text", "\n").alias("lines")).repartition("row")
    lines = rows.select("_id", "row", F.posexplode("lines").alias("line", "body"))
    lines = lines.select("*", holds(F.lower("body")).alias("hold"), (F.trim("body") == "").alias("blank"))
    w = Window.partitionBy("row").orderBy("line")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"start": F.coalesce(F.sum(F.length("body") + 1).over(before), F.lit(0)), "blanks": F.sum(F.col("blank").cast("int")).over(upto)})
    held = F.when(F.col("hold"), F.struct("line", "blanks"))
    lines = lines.withColumns({"last": F.max(held).over(before), "here": F.max(held).over(upto)})
    new = F.col("hold") & F.coalesce((F.col("line") - F.col("last.line") > NEAR) | (F.col("blanks") != F.col("last.blanks")), F.lit(True))
    lines = lines.withColumn("place", F.sum(new.cast("int")).over(upto)).where(F.col("hold") | (F.col("line") - F.col("here.line") < NEAR) & (F.col("blanks") == F.col("here.blanks")))
    part = F.struct("line", "start", "body", "hold")
    found = lines.groupBy("_id", "row", "place").agg(F.array_sort(F.collect_list(part)).alias("l"), F.min("blanks").alias("blanks"), F.max(F.when(F.col("hold"), F.col("line"))).alias("to"))
    found = found.withColumn("l", F.filter("l", lambda x: x["line"] <= F.col("to")))
    unit = lambda kind, line, start, body: F.struct(F.lit(kind).alias("kind"), line.alias("line"), start.cast("int").alias("start"), body.alias("body"))
    whole = F.when(F.size("l") > 1, F.array(unit("paragraph", F.col("l")[0]["line"], F.col("l")[0]["start"], F.array_join(F.transform("l", lambda x: x["body"]), "\n"))))
    single = F.transform(F.filter("l", lambda x: x["hold"]), lambda x: unit("line", x["line"], x["start"], x["body"]))
    found = found.select("_id", F.struct("row", "place").alias("place"), F.struct("row", "blanks").alias("block"), F.explode(F.concat(F.coalesce(whole, F.filter(single, lambda x: F.lit(False))), single)).alias("u"))
    return found.select("_id", "place", "block", "u.*").withColumn("end", F.col("start") + F.length("body"))


def licence_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None) -> DataFrame:
    """One row per line or paragraph with any n-gram of the model: id, kind, line (number of the first one), start, end (code
    points), family, probability, template_similarity, predicted (the model's class before confirmation).

    Lines with telling words that stand near each other in one paragraph (no blank line between) are read alone and together. Where
    the paragraph is confirmed and no line alone is confirmed as another family, it is told, as one notice wrapped over lines; else
    its lines are, those not confirmed as unknown: a notice has one verdict, and a paragraph of two licences one for each line. What
    stands further on before the next blank line belongs to a notice told before or behind it, and is told only if confirmed. family is unknown where the calibrated probability is below CONFIDENT or no template confirms it. Null
    and empty texts give no rows; null ids and repeated rows pass through; an empty table gives an empty result; other columns are
    ignored.
    """
    model = model or fit_licences(docs, id_col, text_col)
    rows = _paragraphs(docs, id_col, text_col, model.cover).withColumn("words", tokens(F.col("body")))
    table = _literal(model.weights, "map<string,array<double>>")
    hits = F.filter(F.transform(F.array_distinct(grams(F.col("words"))), lambda g: F.element_at(table, g)), lambda w: w.isNotNull())
    rows = rows.withColumn("hits", hits).where(F.size("hits") > 0)
    start = F.array(*[F.lit(b) for b in model.bias])
    rows = rows.withColumn("z", F.aggregate("hits", start, lambda acc, w: F.zip_with(acc, w, lambda a, b: a + b), lambda acc: F.transform(acc, lambda x: x / model.temperature)))
    rows = rows.withColumn("top", F.array_max("z")).withColumn("at", F.array_position("z", F.col("top")).cast("int"))
    probability = 1 / F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    rows = rows.withColumn("probability", probability).withColumn("predicted", F.element_at(F.array(*[F.lit(c) for c in model.classes]), F.col("at")))
    templates = templates_of()
    shapes = F.element_at(_literal(templates, "map<string,array<string>>"), F.col("predicted"))
    rows = rows.withColumn("template_similarity", _similarity(F.col("words"), shapes))
    rows = rows.withColumn("sure", (F.col("probability") >= CONFIDENT) & (F.col("template_similarity") >= CONFIRMED) & (F.col("at") > 1))
    is_line, w = F.col("kind") == "line", Window.partitionBy("place")
    whole = F.max(F.when(F.col("sure") & ~is_line, F.col("predicted"))).over(w)  # a place has one paragraph at most
    rows = rows.withColumn("whole", whole)
    other = F.bool_or(is_line & F.col("sure") & (F.col("predicted") != F.col("whole"))).over(w)
    rows = rows.withColumn("as_one", F.col("whole").isNotNull() & ~F.coalesce(other, F.lit(False))).where(is_line != F.col("as_one"))
    rows = rows.withColumn("noticed", F.bool_or("as_one").over(Window.partitionBy("block"))).where(F.col("sure") | ~F.col("noticed"))
    return rows.select(F.col("_id").alias(id_col), "kind", "line", "start", "end", F.when(F.col("sure"), F.col("predicted")).otherwise(UNKNOWN).alias("family"), "probability", "template_similarity", "predicted")
