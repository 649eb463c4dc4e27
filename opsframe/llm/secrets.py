"""Secrets in texts: a trigram index of each shard narrows the rules, regexes decide.

From every rule's parsed pattern a Boolean query follows: clauses that must all
hold, each an alternative of trigram sets. A shard's inverted index maps the
trigrams of all queries to the documents that have them; its postings are
intersected and united as the query says, and the regex reads the whole text of
the candidates. A rule whose pattern demands no trigram reads every text.
"""

from __future__ import annotations

import re
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 8_000_000
MOST_STRINGS = 64
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters; the span is the whole match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    either_case: bool = False

    def compiled(self) -> re.Pattern[str]:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


# The kinds and patterns that results are compared by. A run of
# hexadecimal digits of 16 or more is what `[0-9a-f]+` with 16 characters finds.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED = (
    # Up to its END line; without one, with the lines of base64 that follow.
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:(?:[^-]|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----|(?:\s*+[A-Za-z0-9+/=]{32,}+)*+)",
    ),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}", either_case=True),
    Rule("login_url", r"://[^\s/:@]++:[^\s/:@]++@"),
)
RULES = BASE + ADDED

Clause = frozenset[frozenset[bytes]]


def trigram_query(rule: Rule) -> list[Clause]:
    """Clauses that any text with a match satisfies; none if no trigram is mandatory."""
    clauses: list[Clause] = []

    def closed(strings: set[str]) -> None:
        sets = [
            frozenset(raw[i : i + 3] for i in range(len(raw) - 2))
            for raw in (s.encode().lower() for s in strings)
        ]
        if sets and all(sets):
            clauses.append(frozenset(sets))

    def strings_of(nodes) -> set[str] | None:
        """Every string that the nodes match, or None if they are too many or unbounded."""
        found = {""}
        for op, value in nodes:
            one = exact(op, value)
            if one is None or len(found) * len(one) > MOST_STRINGS:
                return None
            found = {a + b for a, b in product(found, one)}
        return found

    def exact(op, value) -> set[str] | None:
        if op is parser.LITERAL:
            return {chr(value)}
        if op is parser.AT:
            return {""}
        if op is parser.IN and all(o is parser.LITERAL for o, _ in value):
            return {chr(v) for _, v in value}
        if op is parser.SUBPATTERN:
            return strings_of(value[-1])
        if op is parser.BRANCH:
            parts = [strings_of(x) for x in value[1]]
            return None if None in parts else set().union(*parts)
        if op is parser.MAX_REPEAT and value[1] <= 2:
            once = strings_of(value[2])
            if once is not None and len(once) <= 4:
                runs = [{"".join(x) for x in product(once, repeat=n)} for n in range(value[0], value[1] + 1)]
                return set().union(*runs)
        return None

    def walk(nodes) -> None:
        run = {""}
        for op, value in nodes:
            one = exact(op, value)
            if one is not None and len(run) * len(one) <= MOST_STRINGS:
                run = {a + b for a, b in product(run, one)}
                continue
            closed(run)
            run = one if one is not None else {""}
            if op is parser.SUBPATTERN:
                walk(value[-1])
            elif op is parser.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
        closed(run)

    walk(parser.parse(rule.pattern))
    return clauses


class PostingIndex:
    """For each searched trigram the numbers of a shard's documents that have it, in order."""

    def __init__(self, texts: list[bytes], codes: np.ndarray) -> None:
        whole = np.frombuffer(b"\0\0".join(x.lower() for x in texts) + b"\0\0", np.uint8)
        whole = whole.astype(np.int32)
        grams = (whole[:-2] << 16) | (whole[1:-1] << 8) | whole[2:]
        searched = np.zeros(1 << 24, bool)
        searched[codes] = True
        at = np.nonzero(searched[grams])[0]
        ends = np.cumsum([len(x) + 2 for x in texts])
        keys = np.searchsorted(codes, grams[at]) * len(texts) + np.searchsorted(ends, at, "right")
        self.n = len(texts)
        self.keys = np.unique(keys)
        self.codes = codes

    def postings(self, gram: bytes) -> np.ndarray:
        row = int(np.searchsorted(self.codes, int.from_bytes(gram, "big")))
        a, b = np.searchsorted(self.keys, [row * self.n, (row + 1) * self.n])
        return self.keys[a:b] - row * self.n

    def candidates(self, clauses: list[Clause]) -> np.ndarray:
        found = np.arange(self.n)
        for clause in clauses:
            any_of = np.empty(0, np.int64)
            for grams in clause:
                all_of = None
                for gram in grams:
                    some = self.postings(gram)
                    all_of = some if all_of is None else np.intersect1d(all_of, some, True)
                any_of = np.union1d(any_of, all_of)
            found = np.intersect1d(found, any_of, True)
        return found


def _scan(rules: tuple[Rule, ...]):
    queries = [trigram_query(rule) for rule in rules]
    grams = {g for clauses in queries for clause in clauses for some in clause for g in some}
    codes = np.array(sorted(int.from_bytes(g, "big") for g in grams), np.int64)

    def shard(texts: list[bytes]) -> list[list[dict]]:
        found: list[list[tuple]] = [[] for _ in texts]
        index = PostingIndex(texts, codes)
        for order, (rule, clauses) in enumerate(zip(rules, queries, strict=True)):
            regex = rule.compiled()
            for doc in index.candidates(clauses).tolist():
                for m in regex.finditer(texts[doc].decode()):
                    if len(m[rule.group]) >= rule.least:
                        found[doc].append((m.start(), order, m.end()))
        return [
            [{"kind": rules[o].kind, "start": a, "end": b} for a, o, b in sorted(some)]
            for some in found
        ]

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found: list[list[dict]] = []
            texts: list[bytes] = []
            size = 0
            for raw in batch.cast(pa.binary()):
                texts.append(raw.as_py() or b"")
                size += len(texts[-1])
                if size >= SHARD_BYTES:
                    found += shard(texts)
                    texts, size = [], 0
            if texts:
                found += shard(texts)
            yield pa.array(found, kind)

    return F.arrow_udf(of, SPANS)


def scanned(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: every rule's matches as (kind, start, end).

    Matches of one kind are leftmost and do not overlap, matches of different
    kinds may. Offsets are code points, end exclusive; spans are sorted by
    start, then by the order of the rules. Null and empty texts have none. Rows
    stay as they are; a column ``secrets`` that was there is replaced.
    """
    return docs.withColumn("secrets", _scan(rules)(F.col(text_col)))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
