"""Operator 2, BPE encoding and decoding by forced boundaries.

Two bytes that stand side by side inside no vocabulary token can never end up in one token,
so a cut between them is certain. Pre-tokens are cut at all such places, the fragments are
merged independently and their ids concatenated; decoding joins the tokens' bytes.

Defined cases: a null or empty text has no ids; special strings inside a text become their
special id, as the library does by default; rows are independent, so repeated rows give equal
results and an empty table gives an empty one; a column named like a result is replaced.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame

from tillsight.llm import bpe
from tillsight.llm.common import add_columns, sha256, whole
from tillsight.llm.token_counts import merger

CACHED_PRE_TOKENS = 1 << 17  # entries of a worker's cache, emptied when full


class Encoder:
    """The ids of texts as packed little-endian 32-bit integers, and back."""

    def __init__(self, path: str):
        self.path = path
        self.vocabulary = vocabulary = bpe.load(path)
        self.find = bpe.pre_token_pattern().findall
        self.special = vocabulary.special_pattern()
        self.inside = inside_pairs(vocabulary)
        self.packed = {name: id_.to_bytes(4, "little") for name, id_ in vocabulary.special.items()}
        self.known: dict[str, bytes] = {}

    def learn(self, pre_tokens: list[str]) -> None:
        """Encode pre-tokens that are not known: cut all of them at once, then merge the different fragments."""
        data = [t.encode() for t in pre_tokens]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        parts, last = cut(b"".join(data), ends, self.inside)
        different = list(dict.fromkeys(parts))
        ids, counts = merger(self.path).merge(different)
        packed, stops = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        encoded = dict(zip(different, (packed[a:b] for a, b in zip([0, *stops], stops))))
        pieces = [encoded[part] for part in parts]
        for pre_token, start, stop in zip(pre_tokens, [0, *last], last):
            self.known[pre_token] = b"".join(pieces[start:stop])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of whole texts."""
        split = [bpe.split_special(t, self.special) for t in texts]
        found = [[self.find(part) for part in parts[::2]] for parts in split]
        if len(self.known) >= CACHED_PRE_TOKENS:
            self.known.clear()
        if new := list({t for parts in found for part in parts for t in part} - self.known.keys()):
            self.learn(new)
        out = []
        for parts, names in zip(found, split):
            ordinary = [b"".join(map(self.known.__getitem__, part)) for part in parts]
            special = [self.packed[name] for name in names[1::2]] + [b""]
            out.append(b"".join(x for both in zip(ordinary, special) for x in both))
        return out

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids)).decode("utf-8", "replace")


def inside_pairs(vocabulary: bpe.Vocabulary) -> np.ndarray:
    """256 x 256 flags: the byte pairs that occur inside some token."""
    inside = np.zeros((256, 256), bool)
    for id_, token in vocabulary.tokens.items():
        if len(token) > 1 and id_ not in vocabulary.special.values():
            codes = np.frombuffer(token, np.uint8)
            inside[codes[:-1], codes[1:]] = True
    return inside


def cut(data: bytes, ends: np.ndarray, inside: np.ndarray) -> tuple[list[bytes], list[int]]:
    """The fragments of some joined pre-tokens, and the number of fragments up to the end of each."""
    codes = np.frombuffer(data, np.uint8)
    forced = np.append(~inside[codes[:-1], codes[1:]], True)
    forced[ends - 1] = True
    stops = np.flatnonzero(forced) + 1
    bounds = stops.tolist()
    return [data[a:b] for a, b in zip([0, *bounds], bounds)], (np.searchsorted(stops, ends) + 1).tolist()


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """docs with `ids` (array of int) and `n_tokens`; if asked, also `round_trip`, whether the decoded ids are the text."""

    def work(texts: list[str]) -> dict[str, list]:
        codec = encoder(path)
        packed = codec.encode(texts)
        made = {"ids": [np.frombuffer(p, "<u4").astype("i4") for p in packed], "n_tokens": [len(p) // 4 for p in packed]}
        return made | ({"round_trip": [codec.decode(p) == t for p, t in zip(packed, texts)]} if decoded else {})

    fields = {"ids": "array<int>", "n_tokens": "long"} | ({"round_trip": "boolean"} if decoded else {})
    return add_columns(docs, whole(text), fields, work, keep)


def encode_digests(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with `n_tokens`, and digests of the ids and of the text decoded from them."""

    def work(texts: list[str]) -> dict[str, list]:
        codec = encoder(path)
        packed = codec.encode(texts)
        return {
            "n_tokens": [len(p) // 4 for p in packed],
            "ids_sha256": [sha256(p) for p in packed],
            "decoded_sha256": [sha256(codec.decode(p).encode()) for p in packed],
        }

    return add_columns(docs, whole(text), {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, work, keep)
