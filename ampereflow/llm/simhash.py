"""SimHash near-dedup with pigeonring filtering.

A fingerprint's 64 bits form a ring of ``segments`` equal pieces. If two fingerprints differ in at most ``radius`` bits, some
piece starts a chain whose every prefix of l pieces differs in at most floor(l * radius / segments) bits. The longest prefix with a
budget of at most one bit is the join key (equal, or with one bit flipped in the pieces that may differ); longer prefixes prune
candidates before the full Hamming check. A second fingerprint over longer shingles may have to confirm a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import shingles
from .common import connected_components, fresh, materialize, remove_written

BLOCK = 1024  #: most fingerprints that are compared at once
#: Near copies for keep_one_per_group: texts whose five-word shingles have a Jaccard similarity of 0.8 or more. At 0.8 the angle of
#: the shingle sets makes 7.5 of 64 bits differ for three words and 9.7 for five, so fingerprints within RADIUS hold less than half
#: of these pairs, and a wider one would shorten the join keys and let candidates grow with the square of the corpus. What is beyond
#: comes from min-hash bands, confirmed on the shingle sets (shingles.py). MOST2 keeps unlike texts apart at any size of corpus.
RADIUS, SEGMENTS, SHINGLE2, MOST2 = 5, 8, 5, 12
_SEED = 42


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included."""
    grams = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=_SEED), grams), dtype="<u8")


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash64(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of word shingles, repeats included; no words: 0."""
    words = _words(text)
    return _majority(_hashes(words, shingle)) if words else 0


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long; a null text counts as empty."""
    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash64(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, fp(docs[text_col]))


def hex_fingerprint(name: str):
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))


def _star(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Edges from each node with a neighbour to the smallest node of its component in the bipartite graph near[a, b]."""
    la, lb = a.copy(), b.copy()
    top = np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(near, lb[None, :], top).min(1))
        nb = np.minimum(lb, np.where(near, na[:, None], top).min(0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return [(int(x), int(y)) for x, y in {*zip(a.tolist(), la.tolist(), strict=True), *zip(b.tolist(), lb.tolist(), strict=True)} if x != y]


def _link_blocks(radius: int, segments: int, chain: int, most2: int | None):
    width = 64 // segments
    full = (1 << 64) - 1
    prefixes = [((1 << (n * width)) - 1, n * radius // segments) for n in range(chain + 1, segments)]

    def fits(x: int, at: int) -> bool:
        shift = at * width
        turned = ((x >> shift) | (x << (64 - shift))) & full
        return all((turned & mask).bit_count() <= most for mask, most in prefixes) and x.bit_count() <= radius

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for at, exact, every in zip(batch["seg"], batch["exact"], batch["every"], strict=True):
                # members are (node, fp) or (node, fp, fp2) one after another
                a, b = (np.asarray(x, dtype=np.int64).reshape(-1, 2 + (most2 is not None)) for x in (exact, every))
                if len(a) * len(b) <= 64:
                    for x in a.tolist():
                        for y in b.tolist():
                            if x[0] != y[0] and fits((x[1] ^ y[1]) & full, int(at)) and (most2 is None or ((x[2] ^ y[2]) & full).bit_count() <= most2):
                                out.append((max(x[0], y[0]), min(x[0], y[0])))
                    continue
                x = a[:, 1].view(np.uint64)[:, None] ^ b[:, 1].view(np.uint64)[None, :]
                near = np.bitwise_count(x) <= radius
                turned = x if not at else (x >> np.uint64(int(at) * width)) | (x << np.uint64(64 - int(at) * width))
                for mask, most in prefixes:
                    near &= np.bitwise_count(turned & np.uint64(mask)) <= most
                if most2 is not None:
                    near &= np.bitwise_count(a[:, 2].view(np.uint64)[:, None] ^ b[:, 2].view(np.uint64)[None, :]) <= most2
                out += _star(a[:, 0].copy(), b[:, 0].copy(), near)
            pairs = list(dict.fromkeys(out))
            yield pd.DataFrame({"u": np.array([p[0] for p in pairs], dtype=np.int64), "v": np.array([p[1] for p in pairs], dtype=np.int64)})

    return link


def hamming_edges(fps: DataFrame, radius: int = 3, segments: int = 4, most2: int | None = None) -> DataFrame:
    """Edges (u, v) that connect exactly the nodes reachable by links of at most ``radius`` differing bits in fp and, where most2 is
    given, at most most2 in fp2.

    fps: node (distinct longs; without such a column fp is the node), fp and with most2 fp2. Within a bucket a spanning forest of
    the links is returned, not all pairs; a bucket larger than BLOCK is cut into blocks that are compared two at a time, each pair
    of blocks a row of its own.
    """
    budget = lambda n: n * radius // segments
    if 64 % segments or budget(1):
        raise ValueError("segments must divide 64 and exceed radius")
    chain = max(n for n in range(1, segments) if budget(n) <= 1)
    equal = max(n for n in range(1, chain + 1) if budget(n) == 0)  # pieces without any difference
    width = 64 // segments
    low = (1 << (chain * width)) - 1
    turned = f"(shiftrightunsigned(fp, seg * {width}) | shiftleft(fp, 64 - seg * {width}))"
    steps = F.array(*[F.lit(p) for p in [-1, *range(equal * width, chain * width)]])
    if "node" not in fps.columns:
        fps = fps.withColumn("node", F.col("fp"))
    member = F.array("node", "fp", *(["fp2"] if most2 is not None else []))
    entries = (
        fps.select(member.alias("m"), "node", "fp", F.explode(F.array(*[F.lit(k) for k in range(segments)])).alias("seg"))
        .select("m", "node", "seg", F.expr(f"{turned} & {low}L").alias("key"), F.explode(steps).alias("bit"))
        .where("bit < 0 OR shiftrightunsigned(key, bit) & 1L = 0")
        .select("m", "node", "seg", F.expr("IF(bit < 0, key, key | shiftleft(1L, bit))").alias("key"), F.expr("bit < 0").alias("is_exact"))
        .repartition("seg", "key")
    )
    counts = entries.groupBy("seg", "key").agg(F.count_if("is_exact").alias("n_exact"), F.count("*").alias("n")).where("n_exact > 0 AND n > 1")
    members = entries.join(counts.drop("n_exact"), ["seg", "key"]).select("seg", "key", "m", "node", "is_exact", F.expr(f"CAST(ceil(n / {BLOCK}.0) AS INT)").alias("blocks"))
    members = members.withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
    grouped = members.groupBy("seg", "key", "block", "blocks").agg(F.flatten(F.collect_list(F.when(F.col("is_exact"), F.col("m")))).alias("exact"), F.flatten(F.collect_list("m")).alias("every"))
    blocks = materialize(grouped, "blocks")
    alone = blocks.where("blocks = 1").select("seg", "exact", "every")
    many = blocks.where("blocks > 1")
    crossed = many.select("seg", "key", "exact").join(many.select("seg", "key", "every"), ["seg", "key"]).select("seg", "exact", "every")
    return alone.unionAll(crossed).where("size(exact) > 0").mapInPandas(_link_blocks(radius, segments, chain, most2), "u long, v long")


def _with_sketch(rows: DataFrame, shingle: int, shingle2: int) -> DataFrame:
    """(id, h) with both fingerprints and, of texts with words, min-hash bands and shingle set of the longer shingles; each text is
    read once."""
    @pandas_udf("struct<fp:long,fp2:long,n:long,bands:array<long>,shingles:binary>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        out = []
        for words in map(_words, texts):
            if not words:
                out.append((0, 0, 0, None, None))
                continue
            long = _hashes(words, shingle2)
            fps = np.array([_majority(_hashes(words, shingle)), _majority(long)], dtype=np.uint64).view(np.int64).tolist()
            every = shingles.set_of(long)
            out.append((*fps, len(every) // 4, shingles.band_keys(long), every))
        return pd.DataFrame(out, columns=["fp", "fp2", "n", "bands", "shingles"])

    return rows.withColumn("of", sketch("text")).select("id", "h", "of.*")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, segments: int, shingle2: int | None = None, most2: int | None = None) -> DataFrame:
    """(id, h (xxhash64 of the text), fp, root (a node of the component), component_id) for each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    if shingle2:
        keys = ["fp", "fp2", "sig"]
        sketches = _with_sketch(rows, shingle, shingle2).withColumn("sig", F.xxhash64("bands"))
        sketches = materialize(sketches.withColumn("node", F.monotonically_increasing_id()), "sketches")
        rows = materialize(sketches.select("id", "h", *keys), "fingerprints")
        nodes = materialize(sketches.groupBy(*keys).agg(F.min("id").alias("least"), F.min("node").alias("node")), "nodes")
        own = sketches.select("node", "n", "bands", "shingles").join(nodes.select("node"), "node", "left_semi")
        links = materialize(shingles.similar_edges(own), "similar")
        remove_written(sketches)
        near = hamming_edges(nodes.select("node", "fp", "fp2"), radius, segments, most2).unionByName(links)
    else:
        keys = ["fp"]
        rows = materialize(with_fingerprint(rows, "text", shingle).select("id", "h", *keys), "fingerprints")
        nodes = rows.groupBy(*keys).agg(F.min("id").alias("least"))
        nodes = materialize(nodes.withColumn("node", F.col("fp")), "nodes")
        near = hamming_edges(nodes.select("node", *keys), radius, segments)
    comp = connected_components(near)
    rooted = nodes.join(comp, "node", "left").select(*keys, "least", F.coalesce("root", "node").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(first, "root").select(*keys, "root", "component_id"), keys).select("id", "h", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, segments: int = 4) -> DataFrame:
    """One row per input row: id, fp (signed long) and component_id, the smallest id reachable by links of at most radius bits.

    Null texts count as empty; texts without words have fingerprint zero and link like any other; equal fingerprints are one
    node, so thousands of copies cost one comparison. Rows repeated under one id give equal rows. A row with a null id links
    too but names no component; it gets null where all its component's ids are null. Other columns are ignored. An empty table
    gives an empty result.
    """
    found = _components(docs, id_col, text_col, shingle, radius, segments)
    return found.select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = RADIUS, segments: int = SEGMENTS, shingle2: int = SHINGLE2, most2: int = MOST2) -> DataFrame:
    """docs without near copies, one row of each component: the one with the smallest id, and of several with that id the one whose
    text has the smallest hash. Texts are linked by both fingerprints, see RADIUS and MOST2, or by similar sets of five-word shingles.

    Null texts count as empty; empty texts are copies of each other. A row with a null id stays only where no row of its component
    has an id. Of rows that repeat both id and text one stays; rows with one id and unlike texts are unlike documents. All columns
    are kept, whatever they are called; an empty table stays empty.
    """
    comp = materialize(_components(docs, id_col, text_col, shingle, radius, segments, shingle2, most2), "components")
    roots = comp.where("id <=> component_id").groupBy("root").agg(F.min(F.struct("id", "h")).alias("k")).select("k.id", "k.h").distinct()
    kid, kh = fresh(docs, "_id"), fresh(docs, "_h")
    roots = roots.select(F.col("id").alias(kid), F.col("h").alias(kh))
    kept = docs.join(roots, F.col(id_col).eqNullSafe(F.col(kid)) & (F.xxhash64(text_col) == F.col(kh)), "left_semi")
    return kept.dropDuplicates([id_col, text_col])
