"""Operator 5, SimHash near-dedup by anchor-point covering.

Each half of a fingerprint has 31 bits whose anchors are the words of the perfect Hamming code
of that length: every pattern lies within 1 bit (the covering radius) of exactly one anchor.
Two fingerprints that differ in 3 bits or fewer differ in at most 1 bit of one half, so the
anchor nearest to the one lies within 1 + 1 bits of the other. Every fingerprint is therefore
replicated to the at most 16 anchors of each half within 2 bits, and compared there with those
that have the anchor as their nearest.

An anchor with very many members is split into blocks; each pair of blocks is compared in its
own group and yields a spanning forest, never all pairs. Components are found from these links
alone. Documents of one fingerprint are one class throughout.

Defined cases: a null or empty text has fingerprint zero, linked like any other; a document of
one or two words is one shingle; repeated rows share a class; null ids are ignored where the
smallest id is taken (null if a component has no other); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import add_columns, map_batches, save, whole, without
from tillsight.llm.components import components

BITS = 31  # length of the code on each half
BLOCK = 4096  # members of an anchor that are compared in one group


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text as an unsigned number."""
    words = text.encode().lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digests = b"".join([xxhash.xxh64_digest(p, seed) for p in parts])
    total = 0
    counts = np.zeros(64, np.int64)
    for start in range(0, len(digests), 8 << 16):
        bits = np.unpackbits(np.frombuffer(digests, np.uint8, min(8 << 16, len(digests) - start), start)).reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
        total += len(bits)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with `fp`, the fingerprint as a signed long."""
    return add_columns(docs, whole(text), {"fp": "long"}, lambda texts: {"fp": [signed(fingerprint(t)) for t in texts]}, keep)


def anchors(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(places, anchors, whether it is the nearest) for some 31-bit numbers: all anchors within 2 bits."""
    syndrome = np.zeros(len(values), np.int64)
    for k in range(5):
        mask = sum(1 << (i - 1) for i in range(1, BITS + 1) if i >> k & 1)
        syndrome |= (np.bitwise_count(values & mask).astype(np.int64) & 1) << k
    flip = lambda i: np.where(i > 0, np.int64(1) << np.maximum(i - 1, 0), 0)
    yield np.arange(len(values)), values ^ flip(syndrome), True
    for i in range(1, BITS + 1):
        j = i ^ syndrome
        at = np.flatnonzero((syndrome > 0) & (j > i))
        yield at, values[at] ^ flip(np.int64(i)) ^ flip(j[at]), False


def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fp -> (anchor, fp, home) for the anchors of both halves; the half is part of the anchor's number."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for half in (0, 1):
            values = (fps >> (32 * half)) & ((1 << BITS) - 1)
            found = list(anchors(values))
            at = np.concatenate([a for a, _, _ in found])
            keys = np.concatenate([k for _, k, _ in found]) | (half << BITS)
            home = np.repeat([h for _, _, h in found], [len(a) for a, _, _ in found])
            for start in range(0, len(at), 1 << 16):
                part = slice(start, start + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(fps[at[part]]), pa.array(home[part])], names=["anchor", "fp", "home"])


def links(classes: DataFrame, threshold: int = 3) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints within the threshold.

    classes: the different fingerprints, column fp. Thresholds up to 3 are covered.
    """
    if not 0 <= threshold <= 3:
        raise ValueError("the anchors cover thresholds from 0 to 3")
    members = map_batches(classes.select("fp"), replicate, "anchor long, fp long, home boolean")
    large = save(members.groupBy("anchor").count().where(F.col("count") > BLOCK).select("anchor", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)
    as_member = F.transform(every, lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("home")))
    as_home = F.transform(every, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(True).alias("home")))
    dealt = (
        members.join(large, "anchor", "left")
        .select("anchor", "fp", F.explode(F.when(F.col("home"), F.concat(as_home, as_member)).otherwise(as_member)).alias("to"))
        .select("anchor", "to.i", "to.j", "fp", "to.home")
        .repartition("anchor", "i", "j")
        .sortWithinPartitions("anchor", "i", "j")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in groups(batches, 3):
            fps, home = rows[3], rows[4].astype(bool)
            found = [forest(fps[a:b][home[a:b]], fps[a:b][~home[a:b]], threshold) for a, b in zip(starts, starts[1:]) if b - a > 2]
            pairs = np.array([p for group in found for p in group], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return map_batches(dealt, compare, "a long, b long")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[np.ndarray], list[int]]]:
    """Sorted batches as columns that hold whole groups of equal keys, and the bounds of the groups."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        rows = new if rest is None else [np.concatenate(p) for p in zip(rest, new)]
        if not len(rows[0]):
            continue
        starts = group_starts(rows, keys)
        rest = [c[starts[-1]:] for c in rows]
        if len(starts) > 1:
            yield [c[: starts[-1]] for c in rows], starts
    if rest is not None and len(rest[0]):
        yield rest, [0, len(rest[0])]


def group_starts(rows: list[np.ndarray], keys: int) -> list[int]:
    new = np.zeros(len(rows[0]), bool)
    new[0] = True
    for c in rows[:keys]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new).tolist()


def forest(homes: np.ndarray, members: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between homes and members within the threshold that join the same components as all of them."""
    fps = np.unique(np.concatenate([homes, members]))
    if len(fps) < 2:
        return []
    label, out = np.arange(len(fps)), []
    for home in np.unique(homes):
        near = np.flatnonzero(np.bitwise_count(fps ^ home) <= threshold)
        roots, first = np.unique(label[near], return_index=True)
        if len(roots) > 1:
            own = label[np.searchsorted(fps, home)]
            out += [(int(home), int(fps[near[f]])) for r, f in zip(roots, first) if r != own]
            label[np.isin(label, roots)] = own
    return out


def classified(prints: DataFrame, threshold: int = 3) -> DataFrame:
    """(fp, component_id) for every fingerprint in prints (doc_id, fp, ...).

    Written, so that joining a hot fingerprint's documents to it can be split or broadcast.
    """
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    return joined(classes, links(classes, threshold))


def joined(classes: DataFrame, linked: DataFrame) -> DataFrame:
    """(fp, component_id) for every class (fp, least_id), joined by links (a, b)."""
    roots = save(components(linked))
    linked = roots.join(classes, roots.node == classes.fp).select("node", "root", "least_id")
    named = linked.join(linked.groupBy("root").agg(F.min("least_id").alias("component")), "root").select(F.col("node").alias("fp"), "component")
    return save(classes.join(named, "fp", "left").select("fp", F.coalesce("component", "least_id").alias("component_id")))


def near_duplicates(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    prints = save(fingerprints(docs, keep=["doc_id"]))
    named = prints.join(classified(prints, threshold), "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_digest(docs: DataFrame) -> Column:
    """128 bits of a row's columns and of which of them are null, which Spark's hash passes over."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    nulls = F.array(*[c.isNull() for c in columns])
    return F.struct(F.xxhash64(nulls, *columns).alias("a"), F.xxhash64(F.lit(1), nulls, *columns).alias("b"))


def drop_near_duplicates(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """docs with one row of each component: that of its smallest doc_id, ties by the row's digest, then any of equal rows.

    Rows without doc_id stay only if their component has no row with one.
    """
    named = docs.withColumn("__row", row_digest(docs))
    prints = save(fingerprints(named, keep=["doc_id", "__row"]))
    choice = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    winners = (
        prints.join(classified(prints, threshold), "fp")
        .withColumn("__class", F.when(F.col("component_id").isNull(), F.col("fp")))
        .groupBy("component_id", "__class").agg(F.min(choice).alias("w"))
        .select(F.col("w.__row").alias("__row"), F.col("w.doc_id").alias("__id"))
    )
    kept = named.join(winners, (named["__row"] == winners["__row"]) & named["doc_id"].eqNullSafe(winners["__id"]), "left_semi")
    return kept.dropDuplicates(["__row", "doc_id"]).select(*[F.col(f"`{c}`") for c in without(docs, [])])
