"""Operator 7, benchmark decontamination with an FM-index for each shard of documents.

A shard is a bounded slice of an Arrow batch. Its words become symbols: words of the benchmark
have a number, all others break the sequence, and stretches too short for any window are left
out. Over that sequence an FM-index is built: suffix order, Burrows-Wheeler symbols in a wavelet
matrix, and every eighth suffix position. All windows of the benchmark are searched backwards
at once; the rows found are walked to the next sampled position, which gives their places, and
the words they cover are merged to spans. Nothing is shuffled.

The benchmark is the query set and is taken in blocks of a bounded size; a block is collected
and broadcast. With more than one block the documents are written to the shared folder between
them, so that a worker holds one block at a time.

Defined cases: a null or empty text has no words, hits or items; a null item text has no
windows; items without an id are named by the empty string; equal windows of several items
count for each of them; repeated rows give equal results; an empty benchmark hits nothing; a
column named like a result is replaced.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import map_batches, pieces, save, whole, without

WINDOW = 10
BLOCK_BYTES = 4 << 20  # text of the benchmark that is broadcast at once
SHARD_BYTES = 16 << 20  # text of documents under one index
SAMPLED = 8  # every so many suffix positions are kept

# Bytes outside words become spaces; capital letters become small ones.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


# ---- the index --------------------------------------------------------------------------


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        below = self.words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[at >> 6] + np.bitwise_count(below)


class WaveletMatrix:
    """A sequence of numbers below 2**levels with rank and access in `levels` steps."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels = []
        for shift in range(levels - 1, -1, -1):
            bits = (values >> shift & 1).astype(np.uint8)
            self.levels.append((shift, Bits(bits), len(bits) - int(bits.sum())))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a symbol's occurrences before `at` end on the last level."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbols >> shift & 1 == 1, zeros + ones, at - ones)
        return at

    def follow(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at some places, and those places on the last level."""
        symbols = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            symbols |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbols, at


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence whose last symbol is its only zero, in order, by prefix doubling."""
    n, step = len(symbols), 1
    rank = symbols.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (max(n, int(rank.max())) + 2) + after
        order = np.argsort(key, kind="stable")
        changes = np.append(0, np.cumsum(key[order[1:]] != key[order[:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = changes
        if changes[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Counts and places of words' sequences in one sequence of symbols (1 and above)."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        text = np.append(symbols, 0).astype(np.int64)
        self.size = len(text)
        order = suffix_order(text)
        levels = max(1, int(kinds).bit_length())
        transformed = text[order - 1]
        self.wavelet = WaveletMatrix(transformed, levels)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds + 1))])
        self.first = self.wavelet.place(np.arange(kinds + 1), np.zeros(kinds + 1, np.int64))
        sampled = order % SAMPLED == 0
        self.sampled, self.positions = Bits(sampled.astype(np.uint8)), order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of suffixes that begin with each pattern, searched backwards."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size)
        for step in range(patterns.shape[1]):
            on = np.flatnonzero((lengths > step) & (low < high))
            if not len(on):
                break
            symbol = patterns[on, lengths[on] - 1 - step]
            base = self.smaller[symbol] - self.first[symbol]
            low[on] = base + self.wavelet.place(symbol, low[on])
            high[on] = base + self.wavelet.place(symbol, high[on])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row's suffix: steps back to a sampled one."""
        out, steps = np.empty(len(rows), np.int64), 0
        left, at = np.arange(len(rows)), rows
        while len(left):
            hit = self.sampled.get(at)
            out[left[hit]] = self.positions[self.sampled.rank(at[hit])] + steps
            left, at, steps = left[~hit], at[~hit], steps + 1
            symbols, places = self.wavelet.follow(at)
            at = self.smaller[symbols] + places - self.first[symbols]
        return out


# ---- the benchmark ----------------------------------------------------------------------


class Phrases:
    """The windows of some items as rows of word numbers, with the items that have each."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            numbers = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words_of(text)]
            for start in range(max(1, len(numbers) - window + 1) if numbers else 0):
                owners[tuple(numbers[start : start + window])].add(name)
        self.owners = [sorted(o) for o in owners.values()]
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.patterns = np.zeros((len(owners), window), np.int64)
        for row, phrase in enumerate(owners):
            self.patterns[row, : len(phrase)] = phrase
        self.shortest = int(self.lengths.min(initial=window))

    def find(self, texts: list[str]) -> tuple[list[int], list[np.ndarray], list[set[str]]]:
        """For each text of a shard: its words, the hit ones as flags, and the items with occurrences."""
        each = [np.fromiter(map(self.numbers.get, words_of(t), repeat(1)), np.int32) for t in texts]
        sizes = np.array([len(n) for n in each], np.int64)
        numbers = np.concatenate([*each, np.zeros(0, np.int32)])
        ends = np.cumsum(sizes)
        hits, items = np.zeros(len(numbers) + 1, np.int64), [set() for _ in texts]
        for at, row in zip(*self.occurrences(numbers, ends)):
            hits[at] += 1
            hits[at + self.lengths[row]] -= 1
            items[int(np.searchsorted(ends, at, side="right"))].update(self.owners[row])
        covered = np.cumsum(hits[:-1]) > 0
        return sizes.tolist(), np.split(covered, ends[:-1]) if len(texts) else [], items

    def occurrences(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, pattern) of every window in the shard."""
        document = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
        known = np.flatnonzero(numbers > 1)
        if not len(known) or not len(self.patterns):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        broken = np.append(True, (np.diff(known) > 1) | (document[known[1:]] != document[known[:-1]]))
        starts = np.flatnonzero(broken)
        sizes = np.diff(np.append(starts, len(known)))
        long = np.repeat(sizes >= self.shortest, sizes)
        kept, breaks = known[long], broken[long]
        if not len(kept):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # one breaking symbol before each stretch
        place = np.arange(len(kept)) + np.cumsum(breaks)
        symbols, source = np.ones(int(place[-1]) + 1, np.int64), np.zeros(int(place[-1]) + 1, np.int64)
        symbols[place], source[place] = numbers[kept], kept
        index = FmIndex(symbols, len(self.numbers) + 1)
        low, high = index.search(self.patterns, self.lengths)
        found = high - low
        rows = np.repeat(low - np.append(0, np.cumsum(found)[:-1]), found) + np.arange(int(found.sum()))
        return source[index.locate(rows)], np.repeat(np.arange(len(found)), found)


def spans_of(flags: np.ndarray) -> list[int]:
    """Start, end, start, end, ... of the stretches that are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.tolist()


# ---- on Spark ---------------------------------------------------------------------------


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with `n_words`, `hit_spans` (start, end, ... in words, merged), `n_hit`, `items`, `n_items`, `items_sha256`, `contaminated`.

    keep: the columns to carry, all by default.
    """
    results = ["n_words", "hit_spans", "n_hit", "items", "n_items", "items_sha256", "contaminated"]
    kept = without(docs, results) if keep is None else keep
    found = find(docs, benchmark, window, text, kept)
    at = F.col("hit_spans")
    return found.select(
        *[F.col(f"`{c}`") for c in kept], "n_words", "hit_spans", n_hit().alias("n_hit"),
        "items", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size(at) > 0).alias("contaminated"),
    )


def n_hit() -> Column:
    ends = F.transform("hit_spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long"))
    return F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x)


def find(docs: DataFrame, benchmark: DataFrame, window: int, text: str, keep: list[str], rewrite: bool = False) -> DataFrame:
    """The columns to keep with `n_words`, `hit_spans`, `items` and, to rewrite, `__cut`: the text without its hits, null if it has none."""
    size = benchmark.agg(F.sum(F.octet_length(whole()))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = docs.select(*[F.col(f"`{c}`") for c in keep], whole(text).alias("__text"), F.lit(None).cast("array<int>").alias("hit_spans"), F.lit(None).cast("array<string>").alias("items"))
    for number in range(blocks):
        items = benchmark.where(block == number).select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), whole()).collect()
        found = search(found if number == 0 else save(found.drop("n_words")), keep, Phrases([tuple(i) for i in items], window), number == blocks - 1, rewrite)
    return found


def search(docs: DataFrame, keep: list[str], phrases: Phrases, last: bool, rewrite: bool) -> DataFrame:
    """One block of the benchmark over all documents; the text is carried up to the last one."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    carried = keep if last else [*keep, "__text"]
    names = [*carried, "n_words", "hit_spans", "items"] + ["__cut"] * (last and rewrite)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, SHARD_BYTES):
                texts = piece.column("__text").to_pylist()
                sizes, flags, items = shared.value.find(texts)
                before = zip(piece.column("hit_spans").to_pylist(), piece.column("items").to_pylist())
                for at, (spans, named) in enumerate(before):
                    for start, end in zip((spans or [])[::2], (spans or [])[1::2]):
                        flags[at][start:end] = True
                    items[at].update(named or [])
                spans = [spans_of(f) for f in flags]
                made = [pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
                if last and rewrite:
                    made.append(pa.array([remove(t, s) if s else None for t, s in zip(texts, spans)], pa.string()))
                yield pa.RecordBatch.from_arrays([piece.column(c) for c in carried] + made, names=names)

    types = [f"`{c.replace('`', '``')}` {docs.schema[c].dataType.simpleString()}" for c in carried]
    types += ["n_words long", "hit_spans array<int>", "items array<string>"] + ["`__cut` string"] * (last and rewrite)
    return map_batches(docs, task, ", ".join(types))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """docs without the words that benchmark windows cover; a document of which no word is left goes.

    Documents that are not hit keep their text as it is.
    """
    found = find(docs.select(*[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(docs.columns)], F.col(f"`{text}`").alias("__source")), benchmark, window, "__source", [f"__in_{i}" for i in range(len(docs.columns))], rewrite=True)
    left = found.where((F.size("hit_spans") == 0) | (n_hit() < F.col("n_words")))
    return left.select(*[(F.coalesce("__cut", f"__in_{i}") if c == text else F.col(f"__in_{i}")).alias(c) for i, c in enumerate(docs.columns)])


def remove(text: str, spans: list[int]) -> str:
    """A text without the hit stretches: from the first letter of the first word to the last of the last."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])
