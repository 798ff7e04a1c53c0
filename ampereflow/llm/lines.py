"""Substring dedup by hashing lines and paragraphs: normalised units are grouped by digest over the whole corpus, the earliest
place stays and the others go.

A text is cut at line breaks and sentence ends. From each cut on, the fewest pieces that together hold ``min_words`` words are one
unit, so a passage is found wherever it starts on a line of its own or behind another sentence. Overlapping units of one text are
joined into passages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import fresh, materialize

MIN_WORDS = 35  #: words of a unit: a passage of over 50 words loses a part of a sentence at either end

_PIECE = re.compile(r"[^\n.!?…。！？]+")
_WORD = re.compile(r"[฀-๿぀-ヿ㐀-䶿一-鿿]|\w+")  # a letter of scripts without spaces is a word


def words_of(text: str) -> list[str]:
    """Lower case, marks and white space dropped."""
    return _WORD.findall(text.lower())


def units_of(text: str, min_words: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(first word, last word + 1, start, end, digest) of each unit; start and end are code points of the original text."""
    words: list[str] = []
    pieces = []
    for m in _PIECE.finditer(text):
        found = words_of(m[0])
        if found:
            pieces.append((len(words), len(words) + len(found), m.start(), min(m.end() + 1, len(text))))
            words += found
    last = 0
    for first, _, start, _ in pieces:
        while last < len(pieces) and pieces[last][1] - first < min_words:
            last += 1
        if last == len(pieces):
            break
        upto, end = pieces[last][1], pieces[last][3]
        yield first, upto, start, end, xxhash.xxh3_128_digest(" ".join(words[first:upto]).encode("utf-8", "replace"))


def _units(min_words: int):
    names = ["id", "text_hash", "word", "upto", "start", "end", "digest"]

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text, h in zip(batch["id"], batch["text"], batch["text_hash"], strict=True):
                out += [(doc, h, *u) for u in units_of(text, min_words)]
                if len(out) >= 100_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return units


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per passage made of units that the corpus holds more than once: id, text_hash, start, end (code points of the
    original text), n_words, removed (an earlier place holds it; else it is the earliest itself), copies (most places of one of
    its units), kept_id, kept_start (the earliest place among those of its units).

    Earlier is by id, then start. Every word of a removed passage stays at some earlier place. Repeats within one text count.
    Texts of fewer than min_words words, null and empty ones give no row. Rows with a null id are left alone and make nothing
    repeated. Rows repeated with equal id and text are one place; rows with one id and different texts are told apart by
    text_hash. Other columns are ignored; an empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    units = materialize(rows.mapInPandas(_units(min_words), f"id {id_type}, text_hash long, word int, upto int, start int, end int, digest binary"), "units")
    place = F.struct("id", "start", "text_hash")
    first = units.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("copies"))
    # written, so that the join has a shuffle of its own on either side and adaptive execution can split a frequent unit's rows
    first = materialize(first.where("first <> last").drop("last"), "first-units")
    found = units.join(first, "digest").withColumn("removed", place != F.col("first"))
    # sets are made before the shuffle too, so rows repeated many times under one id do not meet in one task
    of_text = found.groupBy("id", "text_hash", "removed").agg(F.collect_set(F.struct("word", "upto", "start", "end", "copies", "first")).alias("u"))
    of_text = of_text.select("id", "text_hash", "removed", F.explode("u").alias("u")).select("id", "text_hash", "removed", "u.*")
    by_text = Window.partitionBy("id", "text_hash", "removed").orderBy("word")
    of_text = of_text.withColumn("new", F.coalesce(F.col("word") > F.max("upto").over(by_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)))
    passages = of_text.withColumn("passage", F.sum(F.col("new").cast("int")).over(by_text)).groupBy("id", "text_hash", "removed", "passage")
    merged = passages.agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("upto") - F.min("word")).alias("n_words"),
        F.max("copies").alias("copies"),
        F.min("first").alias("first"),
    )
    return merged.select(F.col("id").alias(id_col), "text_hash", "start", "end", "n_words", "removed", "copies", F.col("first.id").alias("kept_id"), F.col("first.start").alias("kept_start"))


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: str = "kept_spans") -> DataFrame:
    """docs with the removed passages cut from text; the column ``kept`` (replaced if docs has one of that name) holds where each
    remaining piece stood in the original. A null text stays null; a text that goes entirely is empty."""
    cuts = passages.where("removed").groupBy(F.col(id_col).alias("_id"), "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("cut"))
    id_name, hash_name, cut_name, new_name = (fresh(docs, x) for x in ("_id", "_hash", "_cut", "_new"))
    cuts = cuts.select(F.col("_id").alias(id_name), F.col("text_hash").alias(hash_name), F.col("cut").alias(cut_name))

    @pandas_udf("text string, kept array<struct<start:int,end:int>>")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, cuts, strict=True):
            at, left = 0, []
            for s, e in sorted((x["start"], x["end"]) for x in (spans if spans is not None else [])):
                if s > at:
                    left.append((at, s))
                at = max(at, e)
            if text and at < len(text):
                left.append((at, len(text)))
            out.append((text if text is None else "".join(text[s:e] for s, e in left), [{"start": s, "end": e} for s, e in left]))
        return pd.DataFrame(out, columns=["text", "kept"])

    joined = docs.join(cuts, (F.col(id_col) == F.col(id_name)) & (F.xxhash64(text_col) == F.col(hash_name)), "left")
    joined = joined.withColumn(new_name, cut(F.col(text_col), F.col(cut_name)))
    return joined.withColumn(text_col, F.col(f"{new_name}.text")).withColumn(kept, F.col(f"{new_name}.kept")).drop(id_name, hash_name, cut_name, new_name)
