"""Conversation repair against a plain search over all edits."""

import hashlib
import re
import zlib
from functools import cache
from itertools import product

import numpy as np

from ampereflow.llm import repair

SF = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")


def plain_edits(rows):
    """(cost, audit, roles) of the cheapest edits of rows (initial, must go, truncated), by prefixes of the pattern."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(k, last, inserts):
        found = [(0, "", ())] if k == len(rows) and last in ("", "a") else []
        if inserts < 3:
            for c in step[last].replace("s", ""):
                cost, audit, out = best(k, c, inserts + 1)
                found.append((cost + 5, "I" + audit, ((None, c), *out)))
        if k < len(rows):
            initial, gone, truncated = rows[k]
            cost, audit, out = best(k + 1, last, 0)
            found.append((cost + 2, "D" + audit, out))
            for c in "" if gone else step[last]:
                edit, price = ("K", 0) if c == initial else ("R", 1)
                if c != "s" or edit == "K":
                    cost, audit, out = best(k + 1, c, 0)
                    found.append((cost + price + 5 * truncated, edit + audit, ((k, c), *out)))
        return min(found, default=(10**9, "", ()))

    return best(0, "", 0)


def plain(rows):
    """The contract over Python rows (conv_id, turn, role, text)."""
    convs, space = {}, lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        fold, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        if fold == 0:
            continue
        text = "" if fold == 1 else re.sub("[.!?]", "", text) if fold == 2 else text
        kept += [(turn, "user" if fold == 4 else role, text)] * (2 if fold == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in kept:
            mark = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not mark else "duplicate" if (role, text) in seen else "truncated" if mark[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, stays = plain_edits(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(kept, faults, strict=True)))
        assert PATTERN.fullmatch("".join(c for _, c in stays))
        names = {"s": None, "u": "user", "a": "assistant"}
        lines = [f"{names[c]}:" if k is None else f"{kept[k][1] if kept[k][1][:1] == c else names[c]}:{kept[k][2]}" for k, c in stays]
        turns = [t for t, _, _ in kept if t is not None]
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), pairs, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df, **more):
    got = [tuple(r) for r in repair.repaired_conversations(df, **more).collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def test_block_tables_give_the_cheapest_and_least_edits():
    rng = np.random.default_rng(1)
    short = [list(x) for n in range(4) for x in product(range(16), repeat=n)][:: 3]
    for codes in [*short, *(rng.integers(0, 16, n).tolist() for n in rng.integers(4, 30, 300)), *(rng.choice([4, 8, 12, 13], n).tolist() for n in rng.integers(4, 40, 200))]:
        rows = tuple(("?sua"[c // 4], c % 4 >= 2, c % 4 == 1) for c in codes)
        want = plain_edits(rows)
        symbols = tuple(map(repair.symbol, codes))
        audit, cost, state, stays = repair.trace(symbols, repair.END, 0, True)
        assert (cost, audit) == want[:2] and state in (0, 3)
        assert [k for k, _ in stays] == [-1 if k is None else k for k, _ in want[2]]
        at = len(codes) // 2  # the same over two chunks
        behind = repair.front(symbols[at:], repair.END)
        m = repair.matrix(symbols[at:])
        assert behind == tuple(min(m[4 * q + p] + repair.END[p] for p in range(4)) for q in range(4))
        first, c1, state, _ = repair.trace(symbols[:at], behind, 0, False)
        rest, c2, _, _ = repair.trace(symbols[at:], repair.END, state, True)
        assert (c1 + c2, first + rest) == want[:2]


def test_tables_hold_every_block():
    table, one = repair.block_tables()
    vectors = {v for _, v in one}
    assert len(table) == 9**repair.BLOCK * len(vectors) and all(min(v) == 0 for v in vectors)
    assert {costs for costs, _ in table.values()} <= vectors


def test_query_equals_plain_search(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert result(df) == want
    assert result(df, chunk=2) == want


def test_odd_rows(spark):
    long = "word " * 200_000 + "end."
    rows = [(None, k, r, f"t{k}.") for k, r in enumerate(("user", "assistant", None, "user"))] + [(1, None, "user", "a."), (1, None, "assistant", "b?"), (1, 3, None, None), (1, 4, "", ""), (1, 9, "tool", "x")]
    rows += [(2, k, "user" if k % 2 else "assistant", "same text.") for k in range(40)] + [(3, 5, "system", "s!")] * 6 + [(4, 0, "user", long), (4, 1, "assistant", long + " \t\n")]
    rows += [(5, None, "user", "\x1cx ")] + [(6, k, ("system", "user", "assistant", "other")[k % 4], f"{k} said" + "." * (k % 3 > 0)) for k in range(200)] + [(n, 0, "user", "gone.") for n in range(100, 140)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, key string, pos int, chunk int").repartition(5)
    want = plain(rows)
    got = result(df, chunk=16)
    assert got == want and got[2][2] > 10 and any(v[5:] == (0, "", hashlib.sha256(b"").hexdigest()) for v in got.values())
    assert result(df.limit(0)) == {}
    assert repair.repaired_conversations(df).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
