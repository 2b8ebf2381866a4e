"""Secret scan with a trigram index: the trigrams of a block of texts are extracted once and inverted into postings, each
rule's pattern gives a Boolean query over trigrams, the postings answer it, and only the candidates meet the pattern
itself. A rule whose pattern has no mandatory trigram scans every text.

The index is split by documents: each task indexes the rows it reads, a bounded block at a time, so that no text and no
posting list leaves its task and a lost executor costs only its own blocks.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.common import byte_chunks, folded, pick, text_bytes

#: Literal alternatives followed through a pattern before the analysis settles for what it has.
ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the group that holds the secret and the least length of that group.

    Patterns are read with ASCII rules: "either case" is a matter of A-Z alone.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The base rules of the contract, then those the method adds. A rule takes time in proportion to a text,
# whatever that is: a run of token characters begins one web token at most.
RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9._~+/-]{20,}=*)", 1, 20),
]

#: A query: None is "every text"; three bytes are a trigram; ("and" | "or", parts) combines queries.
Query = object


def _lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _both(a: Query, b: Query) -> Query:
    return b if a is None else a if b is None else a if a == b else ("and", (a, b))


def _any(parts: list[Query]) -> Query:
    if any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_literals(words: set[str]) -> Query:
    """A text that holds one of ``words`` holds all trigrams of that word."""

    def one(w: str) -> Query:
        out: Query = None
        raw = w.encode()
        for i in range(len(raw) - 2):
            out = _both(out, raw[i : i + 3])
        return out

    return _any([one(w) for w in sorted(words)])


_TOKEN = re.compile(r"""(?P<behind>\(\?<!\[[^\]\\]*\]\))|\\x(?P<code>[0-9A-Fa-f]{2})|\\(?P<escaped>.)|(?P<set>\[\^?\]?(?:\\.|[^\]\\])*\])|(?P<open>\((?:\?[aimsux]*(?:-[imsx]+)?:)?)(?!\?)
    |(?P<repeat>[*+?]|\{\d+(?:,\d*)?\})\??|(?P<plain>[^()|\\\[*+?{])|(?P<other>[()|])""", re.X | re.S)
_RANGE = re.compile(r"\\(.)|(.)-(.)|(.)", re.S)


def _parsed(pattern: str):
    """A pattern as nested parts: ("word", strings), ("sequence", parts), ("any of", sequences), ("some", least, most, part)
    or ("open",) for what may be anything. A set that must not stand before is passed over. Raises ValueError for what it
    doesn't know, such as other look-around."""
    at = 0

    def sequence(closing: bool):
        nonlocal at
        branches, parts = [], []
        while at < len(pattern):
            m = _TOKEN.match(pattern, at)
            if not m:
                raise ValueError(f"unknown syntax at {at} of {pattern}")
            at = m.end()
            if m["behind"]:  # what must not stand before takes no trigram away
                continue
            if m["open"]:
                parts.append(sequence(True))
            elif m["repeat"]:
                bounds = {"*": (0, None), "+": (1, None), "?": (0, 1)}.get(m["repeat"])
                if bounds is None:
                    low, _, high = m["repeat"][1:-1].partition(",")
                    bounds = int(low), int(high) if high else (None if "," in m["repeat"] else int(low))
                parts.append(("some", *bounds, parts.pop()))
            elif m["other"] == "|":
                branches.append(("sequence", parts))
                parts = []
            elif m["other"]:
                if m["other"] == "(" or not closing:
                    raise ValueError(f"unknown syntax at {at} of {pattern}")
                break
            else:
                parts.append(("word", _strings(m)))
        branches.append(("sequence", parts))
        return branches[0] if len(branches) == 1 else ("any of", branches)

    return sequence(False)


def _strings(m: re.Match) -> set[str] | None:
    """The characters one token can be, lower-cased; None if they are too many to follow."""
    if m["code"]:
        return {_lower(chr(int(m["code"], 16)))}
    if m["escaped"]:
        return None if m["escaped"].isalnum() else {m["escaped"]}
    if m["plain"]:
        return None if m["plain"] in ".^$" else {_lower(m["plain"])}
    inside = m["set"][1:-1]
    found = [] if inside.startswith("^") else [x.groups() for x in _RANGE.finditer(inside)]
    simple = found and not any(lo or (esc and esc.isalnum()) for esc, lo, _, _ in found)
    return {_lower(esc or one) for esc, _, _, one in found} if simple and len(found) <= 8 else None


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match of ``pattern`` satisfies; A-Z count as a-z.

    Walks the pattern in order and keeps the set of literal strings the last stretch can be; a part that is no literal
    ends the stretch, whose strings' trigrams then become mandatory. An alternation of literals multiplies the strings,
    any other alternation is the "or" of its branches. A pattern with syntax it doesn't know asks for every text.
    """
    try:
        return _walk(_parsed(pattern))
    except ValueError:
        return None


def _walk(part) -> Query:
    kind = part[0]
    if kind == "any of":
        return _any([_walk(b) for b in part[1]])
    if kind == "some":
        return _walk(part[3]) if part[1] > 0 else None
    query: Query = None
    stretch: set[str] = {""}
    for inner in part[1] if kind == "sequence" else [part]:
        words = _literals(inner)
        if words is not None and len(stretch) * len(words) <= ALTERNATIVES:
            stretch = {a + b for a in stretch for b in words}
            continue
        query = _both(query, _of_literals(stretch))
        stretch = words or {""}
        if words is None and inner[0] != "word":
            query = _both(query, _walk(inner))
    return _both(query, _of_literals(stretch))


def _literals(part) -> set[str] | None:
    """All strings ``part`` can match, lower-cased, if they are few literals; else None."""
    kind = part[0]
    if kind == "word":
        return part[1]
    if kind == "any of":
        branches = [_literals(b) for b in part[1]]
        return None if any(b is None for b in branches) else set().union(*branches)
    if kind == "some":
        words = _literals(part[3]) if part[1:3] == (0, 1) else None
        return None if words is None else words | {""}
    out = {""}
    for inner in part[1]:
        words = _literals(inner)
        if words is None or len(out) * len(words) > ALTERNATIVES:
            return None
        out = {a + b for a in out for b in words}
    return out


class Postings:
    """Inverted index of a block of texts: for each trigram of their bytes (A-Z lower-cased) the rows that hold it."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray) -> None:
        low = folded(raw)
        codes = low[: len(raw)].astype(np.int64) << 16 | low[1 : len(raw) + 1].astype(np.int64) << 8 | low[2 : len(raw) + 2]
        self.rows = len(bounds) - 1
        row = np.repeat(np.arange(self.rows), np.diff(bounds))
        whole = np.arange(len(raw)) + 3 <= bounds[row + 1] if len(raw) else np.empty(0, bool)
        # Trigram by trigram, and by row in each: every pair once.
        pairs = np.sort((codes << 32 | row)[whole])
        self.pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs

    def holding(self, trigram: bytes) -> np.ndarray:
        """Rows that hold a trigram, ascending."""
        code = int.from_bytes(trigram, "big")
        lo, hi = np.searchsorted(self.pairs, [code << 32, (code + 1) << 32])
        return self.pairs[lo:hi] & 0xFFFFFFFF

    def candidates(self, query: Query) -> np.ndarray:
        """Rows that satisfy ``query``: postings intersected for "and", united for "or"; all rows for None."""
        if query is None:
            return np.arange(self.rows)
        if isinstance(query, bytes):
            return self.holding(query)
        op, parts = query
        out = self.candidates(parts[0])
        for p in parts[1:]:
            if op == "and" and not len(out):
                break
            out = (np.intersect1d if op == "and" else np.union1d)(out, self.candidates(p))
        return out


def _verifier(rule: Rule):
    """Function from a text to the rule's spans. A pattern that is one repeated character set is matched by runs of at
    least the wanted length, which are the same matches without the short runs that would be dropped."""
    pattern = rule.pattern
    if re.fullmatch(r"\[[^\]\\]+\]\+", pattern) and rule.group == 0:
        pattern = pattern[:-1] + "{%d,}" % rule.least
    matcher = re.compile(pattern, re.ASCII)
    return lambda text: [m.span() for m in matcher.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan_block(raw: np.ndarray, bounds: np.ndarray, rules: list[Rule] = RULES) -> list[list[tuple[int, int, int]]]:
    """Per text of a block (bytes and bounds) its spans as (start, rule number, end), in order of start and then rule."""
    index, data = Postings(raw, bounds), raw.tobytes()
    texts: dict[int, str] = {}
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(index.rows)]
    for number, rule in enumerate(rules):
        spans = _verifier(rule)
        for row in index.candidates(trigram_query(rule.pattern)).tolist():
            if row not in texts:
                texts[row] = data[bounds[row] : bounds[row + 1]].decode()
            out[row] += [(a, number, b) for a, b in spans(texts[row])]
    for found in out:
        found.sort()
    return out


def scan_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per document of ``docs`` (doc_id, text): spans array<struct<kind, start, end>> in code points, end exclusive.

    A null or empty text has no span. Documents keep their number as it is, repeated rows each give a row. Other columns
    play no part, whatever their names.
    """

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            raw, bounds = text_bytes(batch.column(1))
            for lo, hi in byte_chunks(bounds):
                found = scan_block(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], rules)
                spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in f] for f in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(spans, kind)], names=["doc_id", "spans"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def redact(text: str, spans: list[dict], mask: str = "[secret]") -> str:
    """The text with each span replaced by ``mask``; overlapping spans are masked once."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at : s["start"]], mask]
        at = max(at, s["end"])
    return "".join(out) + text[at:]


def secret_digest(docs: DataFrame) -> DataFrame:
    """The columns of the contract, from the spans of :func:`scan_secrets`."""
    from pyspark.sql import functions as F

    base = [r.kind for r in RULES if r.base]
    found = scan_secrets(docs)
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, base), F.sha2(text(of_base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    """sha256 of spans as text, for tests."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
