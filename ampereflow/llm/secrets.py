"""Secret scan: assignment, access-key and hex patterns, and strings that a public vocabulary needs unusually many tokens for."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .tokens import encoder

KINDS = ("assign", "access", "hex", "dense")
#: Characters per token below which a mixed string counts as random.
RATIO = 2.2
LEAST = 20  #: characters of a string that is tried
#: The same limit for letters alone, below which words of long-worded languages do not fall, and the fewest different letters.
LETTERS_RATIO, LETTERS = 2.0, 8

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs: the same as all runs of which those of 16 and more stay
_TRIED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_WORDS = ("password", "passwd", "secret", "token", "api")
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
_IDENTIFIER = re.compile(
    r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}"  # UUID
    r"|(?:[A-Za-z]+[_/-])+[A-Za-z]*[0-9]{0,8}"  # snake or path names with a number
    r"|[A-Za-z]+[0-9]{1,4}"  # word and number
    r"|[0-9_+/=-]+"  # numbers, dates, rules
    r"|(?:sha\d+|md5)-.*",  # integrity strings
    re.IGNORECASE,
)
_SLUG = re.compile(r"[a-z0-9]+(?:[_-][a-z0-9]+)*")  # of lower-case letters and digits
_ADDRESS = re.compile(r"://|(?<![A-Za-z0-9])www\.", re.IGNORECASE)
_CHUNK = re.compile(r"\S+")


def _mixed(word: str) -> bool:
    return any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def _tried(word: str) -> bool:
    """Letters and digits, or letters only without a break: words joined by marks are names."""
    return any(c.isalpha() for c in word) and (word.isalpha() or any(c.isdigit() for c in word))


class _Addresses:
    """The addresses of a text, found in one pass: a chunk without white space that holds a scheme or www., from there to its end.
    However long an address is, its parts are found alike, each in time of its own length."""

    def __init__(self, text: str):
        self.text, self.found = text, []  # (behind the scheme, end, first slash, first ? or #, last @ of the authority)
        if "://" not in text and "www." not in text.lower():
            return
        for chunk in _CHUNK.finditer(text):
            m = _ADDRESS.search(text, *chunk.span())
            if m and (m[0] != "://" or text[chunk.start() : m.start()][-1:].isalnum()):
                host, end = m.end(), chunk.end()
                first = lambda c, host=host, end=end: at if (at := text.find(c, host, end)) >= 0 else end
                slash, query = first("/"), min(first("?"), first("#"))
                self.found.append((host, end, slash, query, text.rfind("@", host, min(slash, query))))
        self.hosts = [x[0] for x in self.found]

    def around(self, s: int):
        """The address in which a string lies that starts at s, perhaps with the slashes of the scheme, or None."""
        k = bisect_right(self.hosts, s + 2) - 1 if self.found else -1
        return self.found[k] if k >= 0 and s < self.found[k][1] else None

    def parts(self, address, s: int, e: int):
        """(start, end, is a path segment) of the userinfo, path segments and query values between s and e."""
        host, _, slash, query, sign = address
        asked, last = query < s, s + len(self.text[s:e].rstrip("="))  # closing equal signs belong to the value
        at = max(s, host)
        cuts = [k for k in range(at, e) if self.text[k] == "=" and last > k + 1 or self.text[k] == "/" and not asked]
        for end in [*cuts, e]:
            if at < e and (asked or slash < at):
                yield at, end, not asked
            elif at < e and sign >= end:
                yield at, end, False
            at = end + 1


def spans_of(text: str, encode, ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points by start, then kind as listed.

    Tried for their ratio are strings of LEAST and more characters with letters and digits, or of letters alone without a mark
    between them (in addresses: letters and digits only, as path segments and values of letters are words)."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    base = sorted((s, e) for _, s, e in found)
    ends: list[int] = []  # the furthest end of the base spans up to each, which makes the test for overlap a search
    for _, e in base:
        ends.append(max(e, ends[-1]) if ends else e)

    def covered(a: int, b: int) -> bool:
        k = bisect_left(base, (b, 0))
        return k > 0 and ends[k - 1] > a

    addresses = _Addresses(text)
    for m in _TRIED.finditer(text):
        word, (s, e) = m[0], m.span()
        if not _tried(word):
            continue
        if text[max(0, s - 8) : s].lower().endswith((";base64,",)):
            continue  # data inside a data: address
        address = addresses.around(s)
        if address:
            parts = [(a, b) for a, b, segment in addresses.parts(address, s, e) if b - a >= LEAST and _mixed(text[a:b]) and not (segment and _SLUG.fullmatch(text, a, b))]
        else:
            parts = [] if text[s - 1 : s] == "@" else [(s, e)]
        for a, b in parts:
            word = text[a:b]
            if covered(a, b) or _DIGEST.fullmatch(word) or _IDENTIFIER.fullmatch(word):
                continue
            if word.isalpha() and not LETTERS <= len(set(word.lower())) < len(word):
                continue  # a sequence of few letters, or an alphabet
            if len(word) < (min(ratio, LETTERS_RATIO) if word.isalpha() else ratio) * len(encode(word)):
                found.append(("dense", a, b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def with_secret_spans(docs: DataFrame, text_col: str = "text", name: str = "secrets", ranks_path: str | None = None, ratio: float = RATIO) -> DataFrame:
    """Adds an array of (kind, start, end); a null text counts as empty. Works row by row: whole texts, no shuffle."""
    if ranks_path is None:
        import public_tokenizers

        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")

    @pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(texts: pd.Series) -> pd.Series:
        encode = encoder(ranks_path).encode_ordinary
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t or "", encode, ratio)] for t in texts])

    return docs.withColumn(name, scan(docs[text_col]))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256 (of kind:start:end of the three patterns), spans (all).

    Null texts count as empty; null ids and repeated rows pass through; an empty table gives an empty result.
    """
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("_found", lambda s: s["kind"] == kind)).cast("long")
    scanned = with_secret_spans(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", "_found")
    return scanned.select(
        F.col("_id").alias(id_col),
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(F.filter("_found", lambda s: s["kind"] != "dense")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("_found")).alias("spans"),
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", ranks_path: str | None = None, ratio: float = RATIO) -> DataFrame:
    """docs with every span replaced by mark; overlapping spans count as one. Rows without secrets, null and empty texts are
    unchanged; null ids and repeated rows pass through; columns keep their names whatever these are; empty tables stay empty."""
    if ranks_path is None:
        import public_tokenizers

        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")

    @pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        encode, out = encoder(ranks_path).encode_ordinary, []
        for text in texts:
            merged: list[list[int]] = []
            for s, e in sorted((s, e) for _, s, e in spans_of(text or "", encode, ratio)):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            for s, e in reversed(merged):
                text = text[:s] + mark + text[e:]
            out.append(text)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, redact(F.col(text_col)))


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans if k != "dense").encode()).hexdigest()
