"""Best-fit packing by sums of squares: each document goes where the squared counts of open bins per residual gap become smallest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .tokens import piece_cache

#: Documents in one packing group: groups are packed apart, each leaving a bin or two that are not full (see the README).
GROUP = 20_000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first. Open bins are counted per residual gap and a full bin counts nowhere; a bin
    is opened only when no gap is wide enough, which together with the falling order leaves the fewest bins."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64), 0
    never = np.iinfo(np.int64).max
    for k in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[k])
        fits = counts[s:]  # bins with gap s, s + 1, ...
        change = np.where(fits > 0, 2 * (counts[: capacity + 1 - s] - fits) + 2, never)
        if fits[0]:
            change[0] = 1 - 2 * fits[0]  # a bin becomes full
        best = int(change.argmin())
        if change[best] < never:
            gap = s + best
            at = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, at, made = capacity, made, made + 1
        bins[k], offsets[k] = at, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_bins[gap - s].append(at)
    return bins, offsets


def _cut(capacity: int, path: str, tokenizer_path: str, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row, full = TaskContext.get().partitionId(), 0, 0
        cache = piece_cache(path, tokenizer_path)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                ids = cache.ids(text or "") + end
                n = len(ids) // 4
                first = n % capacity or capacity
                starts = [0, *range(first, n, capacity)]
                ends = [*starts[1:], n]
                parts = [ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)]
                made = {"row": (part << 33) + row, "id": doc, "first": first, "crcs": [zlib.crc32(x) for x in parts], "full": -1 - ((part << 40) + full)}
                out.append(made | ({"ids": [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in parts]} if with_ids else {}))
                row, full = row + 1, full + len(parts)
            yield pd.DataFrame(out, columns=["row", "id", "first", "crcs", "full", *(["ids"] if with_ids else [])])

    return cut


def _pack(capacity: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["first", "row"], ascending=[False, True])
        bins, offsets = sum_of_squares(group["first"].to_numpy(), capacity)
        return pd.DataFrame({"row": group["row"], "sequence_id": group["grp"].astype("int64") * (1 << 32) + bins, "offset": offsets})

    return pack


def pack_documents(docs: DataFrame, ranks_path: str | None = None, tokenizer_path: str | None = None, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset, and with with_ids its token_ids. ranks_path is
    a file of byte-pair ranks; tokenizer_path names the tokenizer file whose added tokens are one id each (None: there are none).

    A document is its ids and then end_id; one longer than capacity is cut into pieces of capacity ids, the first piece taking
    what is over. Full pieces are sequences of their own; first pieces are packed in groups of about GROUP documents drawn by
    hash, so no task holds more than a group's lengths. A null text is empty (its end alone). Rows with equal or null ids are
    packed as documents of their own. Other columns are ignored; an empty table gives an empty result.
    """
    if ranks_path is None:
        import public_tokenizers

        ranks_path, tokenizer_path = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, id {id_type}, first long, crcs array<long>, full long" + (", ids array<array<int>>" if with_ids else "")
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(_cut(capacity, ranks_path, tokenizer_path, end_id, with_ids), schema), "tokens")
    short = rows.where(F.col("first") < capacity).select("row", "first")
    groups = max(1, -(-short.count() // GROUP))
    placed = short.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("grp").applyInPandas(_pack(capacity), "row long, sequence_id long, offset long")
    pieces = rows.join(placed, "row", "left").select("id", "first", "crcs", "full", "sequence_id", "offset", *(["ids"] if with_ids else []), F.posexplode("crcs").alias("piece", "crc"))
    head = F.col("piece") == 0
    return pieces.select(
        F.col("id").alias(id_col),
        "piece",
        F.when(head, 0).otherwise(F.col("first") + (F.col("piece") - 1) * capacity).cast("long").alias("start"),
        F.when(head, F.col("first")).otherwise(capacity).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.coalesce(F.when(head, F.col("sequence_id")), F.col("full") - F.col("piece")).alias("sequence_id"),
        F.coalesce(F.when(head, F.col("offset")), F.lit(0)).cast("long").alias("offset"),
        *([F.get("ids", F.col("piece")).alias("token_ids")] if with_ids else []),
    )
