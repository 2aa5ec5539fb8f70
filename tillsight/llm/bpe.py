"""Byte-level BPE vocabularies: file, pre-tokens and exact merging, shared by encoding and counting."""

from __future__ import annotations

import functools
import json
import re
import sys
from dataclasses import dataclass

from tokenizers import Regex, pre_tokenizers

# The pieces and white space of the byte-level pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}| ?{numbers}| ?{others}|[{space}]+(?![^{space}])|[{space}]+"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE: token bytes by id, single bytes' ids, merges (left, right) -> (rank, merged)."""

    tokens: dict[int, bytes]
    byte_ids: tuple[int, ...]
    merges: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]

    def special_pattern(self) -> re.Pattern | None:
        names = sorted(self.special, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec.get("normalizer"):
        raise ValueError(f"not a plain byte-level BPE: {path}")
    alphabet = byte_alphabet()
    raw = lambda token: bytes(alphabet[c] for c in token)
    ids = {token: i for token, i in model["vocab"].items()}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    single = {raw(t)[0]: i for t, i in ids.items() if len(t) == 1}
    tokens = {i: raw(t) for t, i in ids.items() if t not in special} | {i: t.encode() for t, i in special.items()}
    return Vocabulary(tokens, tuple(single[b] for b in range(256)), merges, special)


@functools.cache
def pre_token_pattern() -> re.Pattern:
    """The pre-tokenizer's pattern with its Unicode classes, as the library knows them, spelled out for `re`.

    `re` looks up characters below U+10000 in a table but walks through ranges above; those
    stand behind a look-ahead, so that ordinary text never meets them.
    """
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))

    def ranges(kind: str) -> tuple[str, str]:
        split = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}+"), "removed", invert=True)
        runs = [r for r, _ in split.pre_tokenize_str(everything)]
        return tuple("".join(f"{re.escape(r[0])}-{re.escape(r[-1])}" for r in runs if (r[0] > "\uffff") == high) for high in (False, True))

    def run(low: str, high: str) -> str:
        return rf"(?>(?:[{low}]+|(?=[\U00010000-\U0010ffff])[{high}]+)+)"

    (letters, high_letters), (numbers, high_numbers) = ranges("L"), ranges("N")
    others = run(rf"^{SPACE}{letters}{numbers}\U00010000-\U0010ffff", rf"^{high_letters}{high_numbers}\x00-\uffff")
    return re.compile(PIECES.format(letters=run(letters, high_letters), numbers=run(numbers, high_numbers), others=others, space=SPACE))


def split_special(text: str, pattern: re.Pattern | None) -> list[str]:
    """Ordinary text at even places, special strings at odd ones."""
    return pattern.split(text) if pattern is not None else [text]
