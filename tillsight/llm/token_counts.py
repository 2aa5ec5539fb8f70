"""Operator 4, token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch that are not yet known lie one after another in one array of
symbols. A round finds the lowest rank of every sequence, applies that pair in all sequences
at once and closes the gaps; a sequence without a known pair leaves with its length as count.

All occurrences of a pair are applied together only if its product takes part in higher ranks
alone; for other pairs only the leftmost is applied in a round, so that the order is always
that of merging one pair after another.

Defined cases: a null or empty text counts 0 bytes and 0 tokens; special strings inside a text
count as one token; rows are independent; a column named like a result is replaced.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame

from tillsight.llm import bpe
from tillsight.llm.common import add_columns, whole

CACHED_PRE_TOKENS = 1 << 17  # entries of a worker's cache, emptied when full
NONE = np.iinfo(np.int64).max


class Merger:
    """The merges of a vocabulary as sorted arrays."""

    def __init__(self, path: str):
        vocabulary = bpe.load(path)
        self.special = vocabulary.special_pattern()
        self.find = bpe.pre_token_pattern().findall
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)
        pairs = np.array([(a, b, rank, made) for (a, b), (rank, made) in vocabulary.merges.items()], np.int64).reshape(-1, 4)
        self.base = int(max(vocabulary.tokens, default=0)) + 1
        keys = pairs[:, 0] * self.base + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], NONE), np.append(pairs[order, 2], NONE)
        self.made = np.zeros(int(pairs[:, 2].max(initial=-1)) + 1, np.int64)
        self.made[pairs[:, 2]] = pairs[:, 3]
        first_use = np.full(self.base, NONE)
        np.minimum.at(first_use, pairs[:, 0], pairs[:, 2])
        np.minimum.at(first_use, pairs[:, 1], pairs[:, 2])
        self.together = np.zeros(len(self.made), bool)
        self.together[pairs[:, 2]] = first_use[pairs[:, 3]] > pairs[:, 2]
        self.known: dict[str, int] = {}

    def pair_ranks(self, symbols: np.ndarray, sequence: np.ndarray) -> np.ndarray:
        """The rank of each symbol with its right neighbour in the sequence; NONE without one."""
        ranks = np.full(len(symbols), NONE)
        same = np.flatnonzero(sequence[:-1] == sequence[1:])
        keys = symbols[same] * self.base + symbols[same + 1]
        at = np.searchsorted(self.keys, keys)
        ranks[same] = np.where(self.keys[at] == keys, self.ranks[at], NONE)
        return ranks

    def merge(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that survive in some non-empty byte strings, string after string, and their number in each."""
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        counts = sizes.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(strings), np.uint8)]
        sequence = np.repeat(np.arange(len(sizes)), sizes)
        done = []
        while len(symbols):
            ranks = self.pair_ranks(symbols, sequence)
            starts = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.minimum.reduceat(ranks, starts)
            counts[sequence[starts]] = sizes
            active = np.repeat(lowest < NONE, sizes)
            done.append((sequence[~active], symbols[~active]))
            hit = np.flatnonzero(active & (ranks == np.repeat(lowest, sizes)))
            if not len(hit):
                break
            first = np.append(True, sequence[hit[1:]] != sequence[hit[:-1]])
            # of hits that overlap (a run of one symbol) every second one is applied
            run = np.append(True, np.diff(hit) > 1)
            place = hit - hit[np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))]
            hit = hit[np.where(self.together[ranks[hit]], place % 2 == 0, first)]
            symbols[hit] = self.made[ranks[hit]]
            active[hit + 1] = False
            symbols, sequence = symbols[active], sequence[active]
        owner = np.concatenate([o for o, _ in done]) if done else sequence
        order = np.argsort(owner, kind="stable")
        return (np.concatenate([s for _, s in done]) if done else symbols)[order], counts

    def count(self, texts: list[str]) -> list[int]:
        """The tokens of each text."""
        split = [bpe.split_special(t, self.special) for t in texts]
        found = [[self.find(part) for part in parts[::2]] for parts in split]
        if len(self.known) >= CACHED_PRE_TOKENS:
            self.known.clear()
        new = list({t for parts in found for part in parts for t in part} - self.known.keys())
        if new:
            self.known.update(zip(new, self.merge([t.encode() for t in new])[1].tolist()))
        get = self.known.__getitem__
        return [sum(sum(map(get, part)) for part in parts) + len(s) // 2 for parts, s in zip(found, split)]


@functools.cache
def merger(path: str) -> Merger:
    return Merger(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens)."""

    def work(texts: list[str]) -> dict[str, list]:
        counts = merger(path).count(texts)
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts]}

    return add_columns(docs, whole(text), {"n_bytes": "long", "n_tokens": "long", "over_limit": "boolean"}, work, keep)
