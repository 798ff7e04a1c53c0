"""Conversation structure repair: cheapest edits to alternating turns by Four-Russians block tables over cost vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered

BLOCK = 3  #: symbols of a table block
CHUNK = 4096  #: neighbouring rows that one cost matrix stands for
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
ROLES = ("system", "user", "assistant")

# States of the pattern (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a.
_NEVER = 1 << 40
_STATES = range(4)
_KEEP = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (2, 3): 3, (3, 2): 2}  #: (state, symbol) -> state
_NEXT = (2, 2, 3, 2)  #: state after the user or assistant turn that may follow, by rerole or insertion
_ROLE = {2: "user", 3: "assistant"}
Costs = tuple[int, int, int, int]

# A row is initial * 4 + fault; initial: 0 other, 1 s, 2 u, 3 a; fault: 0 none, 1 truncated, 2 blank, 3 duplicate.
BLANK, DUPLICATE = 2, 3


def symbol(code: int) -> int:
    """What the edits depend on: 0 must go, 1 to 4 other, s, u, a, 5 to 8 the same and truncated."""
    initial, fault = divmod(code, 4)
    return 0 if fault >= BLANK else 1 + initial + 4 * fault


def _inserts(costs: list[int]) -> Costs:
    for _ in range(2):
        costs = [min(costs[q], INSERT + costs[_NEXT[q]]) for q in _STATES]
    return tuple(min(c, _NEVER) for c in costs)


#: Cost from each state when no row is left, and that of ending in one given state.
END = _inserts([0, _NEVER, _NEVER, 0])
UNITS = [_inserts([0 if p == q else _NEVER for p in _STATES]) for q in _STATES]


def _edits(sym: int, q: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of a row, in ASCII order but for Insert."""
    yield "D", DELETE, q
    if sym:
        initial, more = (sym - 1) % 4, TRUNCATED * (sym > 4)
        if (q, initial) in _KEEP:
            yield "K", more, _KEEP[q, initial]
        yield "R", REROLE + more, _NEXT[q]


@cache
def before(sym: int, costs: Costs) -> Costs:
    """Costs in front of a row from the costs behind it."""
    return _inserts([min(c + costs[p] for _, c, p in _edits(sym, q)) for q in _STATES])


def normal(costs: Costs) -> tuple[Costs, int]:
    least = min(costs)
    return tuple(c - least if c < _NEVER else _NEVER for c in costs), least


@cache
def block_tables() -> tuple[dict, dict]:
    """For each block of BLOCK symbols, and each single symbol, (block, normalised costs behind) -> (normalised costs in front, what
    was taken off); for all cost vectors that arise from the end of a conversation or from a single state."""
    known = {normal(v)[0] for v in (END, *UNITS)}
    left = list(known)
    while left:
        behind = left.pop()
        for s in range(9):
            new = normal(before(s, behind))[0]
            if new not in known:
                known.add(new)
                left.append(new)
    one = {(s, v): normal(before(s, v)) for v in known for s in range(9)}
    table = {}
    for block in product(range(9), repeat=BLOCK):
        for v in known:
            costs, taken = v, 0
            for s in reversed(block):
                costs, less = one[s, costs]
                taken += less
            table[block, v] = costs, taken
    return table, one


def boundaries(symbols: tuple[int, ...], behind: Costs) -> tuple[list[Costs], int]:
    """Normalised costs at the block boundaries, the last being ``behind``, and what the chunk costs on top. The first block may be
    short."""
    table, one = block_tables()
    costs, taken = normal(behind)
    at, found = len(symbols), [costs]
    while at >= BLOCK:
        costs, less = table[symbols[at - BLOCK : at], costs]
        at, taken = at - BLOCK, taken + less
        found.append(costs)
    for s in reversed(symbols[:at]):
        costs, less = one[s, costs]
        taken += less
    found += [costs] * bool(at)
    return found[::-1], taken


def front(symbols: tuple[int, ...], behind: Costs) -> Costs:
    found, taken = boundaries(symbols, behind)
    return tuple(c + taken if c < _NEVER else _NEVER for c in found[0])


def matrix(symbols: tuple[int, ...]) -> list[int]:
    """Cost of passing the chunk from state q to state p, at 4 * q + p."""
    columns = [front(symbols, unit) for unit in UNITS]
    return [columns[p][q] for q in _STATES for p in _STATES]


def trace(symbols: tuple[int, ...], behind: Costs, state: int, last: bool) -> tuple[str, int, int, list[tuple[int, str | None]]]:
    """(initials, cost, state behind, what stays) of the cheapest edits, the ASCII-least of these. What stays: (row, new role or
    None), row -1 for an insertion. Blocks are passed by lookup from the end; from the front, each block is expanded backward into
    the costs between its rows, and the least initial that keeps to these costs is taken."""
    found, _ = boundaries(symbols, behind)
    audit, total, stays, row = [], 0, [], 0
    for k, costs in enumerate(found[1:]):
        block = symbols[row : len(symbols) - BLOCK * (len(found) - 2 - k)]
        inner = [costs]
        for s in reversed(block):
            inner.append(before(s, inner[-1]))
        inner.reverse()
        for n, s in enumerate(block):
            while True:
                ahead, after = inner[n], inner[n + 1]
                options = [("I", INSERT, _NEXT[state], ahead), *((e, c, p, after) for e, c, p in _edits(s, state))]
                edit, cost, state = min((e, c, p) for e, c, p, v in options if c + v[p] == ahead[state])
                audit.append(edit)
                total += cost
                if edit == "I":
                    stays.append((-1, _ROLE[state]))
                    continue
                if edit != "D":
                    stays.append((row + n, None if edit == "K" else _ROLE[state]))
                break
        row += len(block)
    while last and END[state]:
        audit.append("I")
        total, state = total + INSERT, _NEXT[state]
        stays.append((-1, _ROLE[state]))
    return "".join(audit), total, state, stays


def _with_matrix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["costs"] = [matrix(tuple(map(symbol, codes))) for codes in batch["codes"]]
        yield batch


def _costs_behind(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of each conversation from its end: the costs behind each, and whether it is the last."""
    key, costs = None, END
    for batch in batches:
        behind, last = [], []
        for k, m in zip(batch["key"], batch["costs"], strict=True):
            last.append(k != key)
            key, costs = k, END if k != key else costs
            behind.append(costs)
            costs = normal(tuple(min(int(m[4 * q + p]) + costs[p] for p in _STATES) for q in _STATES))[0]
        yield batch.drop(columns="costs").assign(behind=behind, last=last)


_OUT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_LEGAL = {(1, 2), (2, 3), (3, 2)}


class _Repair:
    """One conversation as its chunks and rows pass by, in order: sums, edits and a running digest, never its texts."""

    def __init__(self, key: str) -> None:
        self.key, self.state, self.cost, self.audit, self.sums = key, 0, 0, [], {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.digest, self.any, self.stays, self.first, self.before, self.low, self.high, self.turns = hashlib.sha256(), False, [], 0, None, None, None, 0

    def emit(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) * self.any}{role}:{text}".encode())
        self.any = True

    def settle(self) -> None:
        """Insertions that stand behind the chunk's last row."""
        for _, role in self.stays[::-1]:
            self.emit(role, "")
        self.stays = []

    def chunk(self, h) -> None:
        self.settle()
        codes = [int(c) for c in h.codes]
        for c in codes:
            initial, fault = divmod(c, 4)
            if fault:
                self.sums[("truncated", "blank", "duplicate")[fault - 1]] += 1
            self.sums["illegal"] += self.before is not None and (self.before, initial) not in _LEGAL
            self.before = initial
        if h.low is not None:
            low, high = int(h.low), int(h.high)
            self.turns += h.turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        audit, cost, self.state, stays = trace(tuple(map(symbol, codes)), tuple(int(c) for c in h.behind), self.state, h.last)
        self.audit.append(audit)
        self.cost, self.stays, self.first = self.cost + cost, stays[::-1], h.pos

    def row(self, pos: int, role: str, text: str) -> None:
        at = pos - self.first
        inserted = len(self.stays)
        while inserted and self.stays[inserted - 1][0] < 0:
            inserted -= 1
        if not inserted or self.stays[inserted - 1][0] != at:
            return  # deleted
        for _, new in self.stays[: inserted - 1 : -1] if inserted < len(self.stays) else []:
            self.emit(new, "")
        self.emit(self.stays[inserted - 1][1] or role, text)
        del self.stays[inserted - 1 :]

    def result(self) -> dict:
        self.settle()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"key": self.key, "gaps": gaps, **self.sums, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now = None
    for batch in batches:
        out = []
        for r in batch.itertuples():
            if now is None or now.key != r.key:
                out += [now.result()] if now else []
                now = _Repair(r.key)
            if r.kind == 1:
                now.chunk(r)
            elif r.kind == 2:
                now.row(r.pos, r.role, r.text)
        if out:
            yield pd.DataFrame(out)
    if now:
        yield pd.DataFrame([now.result()])


def damaged(conversations: DataFrame) -> DataFrame:
    """(key, turn, role, text) after the test damage: by crc32 of conv_id:turn modulo 20, 0 drops a row, 1 empties its text, 2 removes
    [.!?], 3 repeats it, 4 makes it the user's. Nulls count as one space, but for turn, which stays null."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fold = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    rows = conversations.select(_key(), F.col("turn").cast("long").alias("turn"), text["role"].alias("role"), text["text"].alias("text"), fold.alias("fold")).where("fold <> 0")
    role = F.when(F.col("fold") == 4, "user").otherwise(F.col("role")).alias("role")
    body = F.when(F.col("fold") == 1, "").when(F.col("fold") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")
    return rows.select("key", "turn", role, body, F.explode(F.expr("IF(fold = 3, array(0, 1), array(0))")).alias("copy")).drop("copy")


def _key() -> Column:
    """The id as text that tells a null from any value."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of conversations (key, turn, role, text).

    Rows are ordered by turn, nulls first, then by the first 32 characters of role and of text, then by a hash of both; equal rows
    are alike. That order and the faults come from sorts, partial minima and joins on the row's place, so that one conversation may
    be spread over many tasks, as are the cost matrices of its runs of ``chunk`` places. Only these matrices, one for each run, meet
    in one task for each conversation; then its rows pass one task in order, since SHA-256 reads its input one after another.
    """
    initial = F.expr("CASE substring(role, 1, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END")
    blank, ends = ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    heads = {"_role": F.substring("role", 1, 32), "_text": F.substring("text", 1, 32), "_hash": F.xxhash64("role", "text"), "_any": F.rand(7)}
    told = {"initial": initial, "blank": blank, "ends": ends, "same": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))}
    order = ["key", "turn", *heads]
    placed = materialize(numbered(rows.withColumns(heads | told), order).drop(*heads), "placed-turns")
    narrow = placed.select("key", "turn", "pos", "initial", "blank", "ends", "same", F.expr(f"pos div {int(chunk)}").alias("chunk"))
    firsts = narrow.where("NOT blank").groupBy("key", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    code = F.expr(f"initial * 4 + CASE WHEN blank THEN {BLANK} WHEN first IS NULL THEN {DUPLICATE} WHEN ends THEN 0 ELSE 1 END")
    marked = narrow.join(firsts, "pos", "left").select("key", "chunk", "turn", "pos", code.alias("code"))
    codes = F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]).alias("codes")
    runs = marked.groupBy("key", "chunk").agg(F.min("pos").alias("pos"), codes, F.min("turn").cast("string").alias("low"), F.max("turn").cast("string").alias("high"), F.size(F.collect_set("turn")).alias("turns"))
    head = "key string, chunk long, pos long, codes array<int>, low string, high string, turns int"
    runs = materialize(runs.mapInPandas(_with_matrix, f"{head}, costs array<long>"), "run-costs")
    runs = runs.repartition("key").sortWithinPartitions("key", F.desc("chunk")).mapInPandas(_costs_behind, f"{head}, behind array<long>, last boolean")
    turns = placed.where("NOT blank").select("key", F.expr(f"pos div {int(chunk)}").alias("chunk"), "pos", "role", "text", F.lit(2).alias("kind"))
    stream = runs.withColumn("kind", F.lit(1)).unionByName(turns, allowMissingColumns=True)
    return stream.repartition("key").sortWithinPartitions("key", "chunk", "kind", "pos").mapInPandas(_repaired, _OUT)


def repaired_conversations(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row for each conv_id: faults after the test damage, and the cheapest repair.

    Null ids are one conversation. Conversations of which no row is left have zeros, no edits and the digest of nothing. Null roles
    and texts are one space; a role whose initial is not s, u or a cannot stay as it is. Repeated rows are duplicates, all but one.
    Empty table: empty result. Other columns are not read.
    """
    found = repair(damaged(conversations), chunk)
    ids = conversations.select("conv_id", _key()).groupBy("key").agg(F.first("conv_id").alias("conv_id"))
    out = ids.join(found, "key", "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
