"""Operator 6, substring dedup by difference-cover anchors.

Modulo 13 the places {0, 1, 3, 9} form a difference cover: for any two starts there is a shift
below 13 that brings both to a covered place. Two equal windows of 20 words therefore share an
aligned anchor of 20 - 13 + 1 = 8 words at covered places, and only those anchors are hashed
for the whole corpus. Around anchors that occur again the match is extended: every window of 20
words that contains one is hashed with 128 bits, and a window is removed if the same window
starts earlier, in a smaller document or further in front.

Equal hashes inside one batch are settled there and sent on as one row, so that a passage in a
third of all documents is a few rows per batch in the shuffle. Documents with equal texts are
one class: the first of them is worked on, and of the others every word in a window goes.

Defined cases: a null or empty text has no words; a text shorter than a window loses nothing;
rows with the same id count as one document, so windows at the same start do not remove each
other; a null id comes after all others; equal rows give equal results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import map_batches, pieces, sha256, whole

WINDOW, PERIOD = 20, 13
COVER = (0, 1, 3, 9)  # a perfect difference set modulo 13
ANCHOR = WINDOW - PERIOD + 1
PIECE = 8 << 20  # bytes of a batch, compressed or not, that are worked on together
DOCUMENT = ["row", "k1", "k2", "id", "text"]
LAST = np.iinfo(np.int64).max
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd multipliers of the window hashes


def deflated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, k1, k2, id, text) with compressed texts: they are shuffled once and read three times."""
    for batch in batches:
        for piece in pieces(batch, PIECE):
            packed = [zlib.compress(t.encode(), 1) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(packed, pa.binary())], names=DOCUMENT)


def words_of(piece: pa.RecordBatch) -> Iterator[list[bytes]]:
    for packed in piece.column("text"):
        yield zlib.decompress(packed.as_buffer()).split()


def hashed(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The 128-bit hashes of all words, one row each, and the number of words of each text."""
    each = [b"".join(map(xxhash.xxh3_128_digest, words)) for words in words_of(piece)]
    sizes, digests = np.array([len(d) // 16 for d in each], np.int64), b"".join(each)
    return np.frombuffer(digests, "<u8").reshape(-1, 2), sizes


def combined(words: np.ndarray, at: np.ndarray, length: int, factor: int) -> np.ndarray:
    """A hash of the `length` words from each place."""
    total = np.zeros(len(at), np.uint64)
    for k in range(length):
        total = total * np.uint64(factor) + words[at + k]
    return (total ^ (total >> np.uint64(29))).view(np.int64)


def places(sizes: np.ndarray) -> np.ndarray:
    """Each word's place in its own text."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> (key, code, row): an anchor's hash, its place * 2 and 1 more where it is known to occur again, its document.

    What differs from row to row stands in front, what repeats behind: the shuffle compresses that best.
    """
    for batch in batches:
        for piece in pieces(batch, PIECE):
            words, sizes = hashed(piece)
            rows = np.repeat(piece.column("row").to_numpy(), sizes)
            at, room = places(sizes), np.repeat(sizes, sizes)
            here = np.flatnonzero(np.isin(at % PERIOD, COVER) & (at + ANCHOR <= room) & (room >= WINDOW))
            keys, rows, at = combined(words[:, 0], here, ANCHOR, FACTORS[0]), rows[here], at[here]
            _, first, group, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            known = (count > 1)[group]
            again = np.ones(len(keys), bool)
            again[first] = False
            keys[again] = combined(np.stack([rows, at], 1).view(np.uint64).reshape(-1), 2 * np.flatnonzero(again), 2, FACTORS[1])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys, at * 2 + known, rows)], names=["key", "code", "row"])


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with `codes` of anchors -> (h1, h2, code, id, row): windows around anchors that occur again.

    code: place + length * 2**32. Length 0 is a window that is the first of its hash in this
    batch; otherwise so many windows in a row start earlier here.
    """
    for batch in batches:
        for piece in pieces(batch, PIECE):
            words, sizes = hashed(piece)
            starts = np.cumsum(sizes) - sizes
            marked = np.zeros(len(words) + 1, np.int64)
            for base, size, codes in zip(starts.tolist(), sizes.tolist(), piece.column("codes")):
                ats = codes.values.to_numpy() >> 1
                np.add.at(marked, base + np.clip(ats - PERIOD + 1, 0, size - WINDOW + 1), 1)
                np.add.at(marked, base + np.clip(ats + 1, 0, size - WINDOW + 1), -1)
            here = np.flatnonzero(np.cumsum(marked)[:-1] > 0)
            h1, h2 = (combined(words[:, i], here, WINDOW, FACTORS[i]) for i in (0, 1))
            text = np.searchsorted(starts + sizes, here, side="right")
            rows, ids = piece.column("row").to_numpy()[text], piece.column("id").to_numpy()[text]
            at = here - starts[text]
            order = np.lexsort((at, ids, h2, h1))
            new = np.append(True, (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0))[: len(order)]
            first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            known = np.empty(len(order), bool)
            known[order] = (ids[order] != ids[first]) | (at[order] != at[first])
            # known windows that follow each other are one row
            head = ~known | np.append(True, ~known[:-1] | (np.diff(here) != 1) | (np.diff(text) != 0))[: len(known)]
            lead = np.flatnonzero(head)
            n = np.where(known[lead], np.diff(np.append(lead, len(known))), 0)
            h1, h2, ids, rows, at, known = (c[lead] for c in (h1, h2, ids, rows, at, known))
            h1[known] = rows[known] ^ (at[known] * 0x9E3779B97F4A7C1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (h1, h2, at + (n << 32), ids, rows)],
                names=["h1", "h2", "code", "id", "row"],
            )


def cutter(texts: bool):
    """Documents with `gone` windows -> (k1, k2, n_words, n_removed, kept_sha256) and, if asked for, kept: texts without the removed windows' words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, PIECE):
                totals, removed, kept = [], [], []
                for own, words, gone in zip(piece.column("id").to_pylist(), words_of(piece), piece.column("gone").to_pylist()):
                    flags = np.zeros(len(words) + 1, np.int64)
                    for g in gone or ():
                        if g["id"] == own:
                            at, n = g["code"] & 0xFFFFFFFF, max(1, g["code"] >> 32)
                            flags[at] += 1
                            flags[at + n + WINDOW - 1] -= 1
                    stay = (np.cumsum(flags)[:-1] == 0).tolist()
                    left = [w for w, s in zip(words, stay) if s]
                    totals.append(len(words))
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(left))
                made = [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array([sha256(k) for k in kept], pa.string())]
                if texts:
                    made.append(pa.array([k.decode() for k in kept], pa.string()))
                yield pa.RecordBatch.from_arrays([piece.column("k1"), piece.column("k2"), *made], names=["k1", "k2", "n_words", "n_removed", "kept_sha256"] + ["kept"] * texts)

    return task


def repeated_substrings(docs: DataFrame, text: str = "text", texts: bool = True) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text."""
    keyed = docs.select("doc_id", whole(text).alias("text")).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(WINDOW), "text")})
    ident = F.coalesce("doc_id", F.lit(LAST))
    members = keyed.select("doc_id", "k1", "k2", ident.alias("id"))
    classes = members.groupBy("k1", "k2").agg(F.min("id").alias("first_id"))
    row = lambda id_: F.xxhash64(id_, "k1", "k2").alias("row")
    # One row of each class. All three uses ask for the same columns, so that Spark shuffles the texts once.
    packed = map_batches(keyed.select(row(ident), "k1", "k2", ident.alias("id"), "text"), deflated, "row long, k1 long, k2 long, id long, text binary")
    single = packed.dropDuplicates(["row"])
    first = single.join(classes.select(row("first_id")), "row", "left_semi").select(DOCUMENT)

    again = Window.partitionBy("key")
    repeated = (
        map_batches(first, anchors, "key long, code long, row long")
        .withColumn("known", F.max(F.col("code") % 2).over(again) + F.count("*").over(again)).where("known > 1")
        .groupBy("row").agg(F.collect_list("code").alias("codes"))
    )
    found = map_batches(first.join(repeated, "row").select(*DOCUMENT, "codes"), windows, "h1 long, h2 long, code long, id long, row long")
    start = F.struct("id", F.expr("code & 4294967295").alias("at"))
    removed = (
        found.withColumn("least", F.min(start).over(Window.partitionBy("h1", "h2"))).where(F.expr("code > 4294967295") | (start > F.col("least")))
        .groupBy("row").agg(F.collect_list(F.struct("id", "code")).alias("gone"))
    )
    done = map_batches(first.join(removed, "row", "left").select(*DOCUMENT, "gone"), cutter(texts), "k1 long, k2 long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)
    done = classes.join(done, ["k1", "k2"])
    copy = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)
    out = members.join(done, ["k1", "k2"]).select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(sha256(b""))).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept_text")] if texts else []),
    )
    return out
