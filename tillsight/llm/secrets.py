"""Operator 3, secret scans by sliding-window entropy.

Three fixed patterns give the base spans. Beyond them, every long run of token characters is
a candidate; a window slides over it, keeps the counts of its characters and the sum of
c * log2(c) incrementally, and windows whose Shannon entropy reaches the threshold of the
candidate's character class are joined to `entropy` spans. Candidates on the allow list
(UUIDs, host and path of web addresses, repeated alphabets) are passed over; base spans always
stay. User info, query and fragment of an address are scanned like any other text. An address
ends before quotes, commas, brackets, braces, other marks that paths rarely have, and non-ASCII.
So a key that is part of an address's path (a webhook's, for one) is passed over by design.

Offsets are code points, end exclusive. Defined cases: a null or empty text has no spans; rows
are independent, so repeated rows give equal results; a column named like a result is replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillsight.llm.common import add_columns, sha256, whole

KINDS = ("assign", "access", "hex", "entropy")


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# Key words, value characters and least lengths of the base patterns.
KEYS = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"""(?:{KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# Class of a candidate: the first pattern that fits it whole, and its least entropy in bits. A window of 20
# random characters of the class reaches it in about 19 of 20 cases; letters of one case in about half of
# them, for long words come as near as that.
CLASSES = (
    (re.compile(r"[0-9]+"), 2.65),
    (re.compile(r"[0-9a-fA-F]+"), 3.0),
    (re.compile(r"[A-Z]?[a-z]+|[A-Z]+"), 3.65),
    (re.compile(r"[A-Za-z]+"), 3.7),
    (re.compile(r"[A-Za-z0-9]+"), 3.7),
    (re.compile(r".+"), 3.75),
)
ALLOWED = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
    r"(?:/[A-Za-z0-9_-]{1,15})+/?",  # path of short names
    r"(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|[0-9]{1,6})(?:[-_/=+](?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|[0-9]{1,6}))*",  # words and numbers, joined
    r"[a-z]*(?:[A-Z][a-z]{1,15})+",  # words in camel case
    r"0123456789.*|.*ABCDEFGHIJKLMNOPQRSTUVWXYZ.*|.*abcdefghijklmnopqrstuvwxyz.*",  # alphabets
)
# A web address up to its path; the group is its user info.
ADDRESS = re.compile(r"""https?://([^\s/?#@"'<>]*@)?[A-Za-z0-9._-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~%/:@+=-]*)?""")


@dataclass(frozen=True)
class Rules:
    """window: characters looked at together; allowed: patterns that suppress a candidate they fit whole."""

    window: int = 20
    allowed: tuple[str, ...] = ALLOWED


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def entropy_spans(text: str, rules: Rules) -> list[tuple[int, int, str]]:
    """(start, end, "entropy") of the joined windows of high entropy."""
    allowed = re.compile("|".join(f"(?:{p})" for p in rules.allowed), re.DOTALL) if rules.allowed else None
    found, addresses = [], None
    for m in CANDIDATE.finditer(text):
        candidate = m[0]
        least = next(bits for pattern, bits in CLASSES if pattern.fullmatch(candidate))
        if allowed and allowed.fullmatch(candidate):
            continue
        if addresses is None:
            addresses = [(a.end(1) if a[1] else a.start(), a.end()) for a in ADDRESS.finditer(text)]
        at = bisect(addresses, (m.start(), len(text) + 1)) - 1
        if at >= 0 and m.end() <= addresses[at][1]:
            continue
        found += [(m.start() + a, m.start() + b, "entropy") for a, b in dense(candidate, rules.window, least)]
    return found


def dense(candidate: str, window: int, least: float) -> list[tuple[int, int]]:
    """The parts of a candidate that windows with at least `least` bits cover."""
    terms = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]  # c * log2(c)
    bound = window * (math.log2(window) - least) + 1e-9  # the entropy is log2(window) - sum / window
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for at, c in enumerate(candidate):
        n = counts.get(c, 0)
        total += terms[n + 1] - terms[n] if n < window else 0.0
        counts[c] = n + 1
        if at >= window:
            gone = candidate[at - window]
            n = counts[gone]
            total += terms[n - 1] - terms[n] if n <= window else 0.0
            counts[gone] = n - 1
        if at >= window - 1 and total <= bound:
            start = at - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1)
            else:
                spans.append((start, at + 1))
    return spans


def all_spans(text: str, rules: Rules) -> list[tuple[int, int, str]]:
    return sorted(base_spans(text) + entropy_spans(text, rules), key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """text with every stretch of overlapping spans replaced by one mark."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, rules: Rules = Rules(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with the counts of base spans, the digest of their list, and the list of all spans."""

    def work(texts: list[str]) -> dict[str, list]:
        found = [all_spans(t, rules) for t in texts]
        base = [[s for s in spans if s[2] != "entropy"] for spans in found]
        counts = {f"n_{k}": [sum(s[2] == k for s in spans) for spans in base] for k in KINDS[:3]}
        return counts | {"base_sha256": [sha256(listed(b).encode()) for b in base], "spans": [listed(s) for s in found]}

    fields = {f"n_{k}": "long" for k in KINDS[:3]} | {"base_sha256": "string", "spans": "string"}
    return add_columns(docs, whole(text), fields, work, keep)


def redact_secrets(docs: DataFrame, rules: Rules = Rules(), mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """docs whose texts have their secrets replaced by a mark; a null text becomes empty."""

    def work(texts: list[str]) -> dict[str, list]:
        return {text: [redact(t, all_spans(t, rules), mark) for t in texts]}

    return add_columns(docs, whole(text), {text: "string"}, work).select(*docs.columns)
