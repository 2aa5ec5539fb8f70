"""Operator 11, vector code compression by slice-and-intersect bitmasks.

Vectors are cut into equal parts, and each part is replaced by the number of the nearest entry
of its part's codebook. The codebooks are learned from all rows in exact integers: every round
assigns all parts and replaces each entry by the mean of its parts, rounded down.

The nearest entry is found without comparing with all. In each dimension the entries are sorted
by their coordinate, and each place carries a mask of the entries before it (a bit an entry, in
64-bit words). The entries within a radius of a value in one dimension are a range there, so
two masks give them by an exclusive or; the masks of all dimensions ANDed give the entries in a
cube. Every entry within the radius lies in the cube, so that the best one found there is the
nearest of all as soon as its distance is within the radius. The initial radius is a typical
distance between entries; where the cube is empty it is doubled, and where the best entry is
farther than the radius the search is repeated with that distance.

A round is one pass over the vectors: each task adds up its own parts and yields one row a cell
of the codebooks, so only these sums are shuffled and nothing but codebooks reaches the driver.

Defined cases: which vectors count is said in `embeddings`; a length that the number of parts
does not divide is filled up with zeros; fewer rows than entries give smaller codebooks; equal
ids seed in the order of their vectors, null ids last; repeated rows count and are coded each;
errors beyond a long become the largest long; an empty table gives an empty result; columns
other than id, vector and label are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import map_batches, save
from tillsight.llm.embeddings import LIMIT, exact, scaled, usable

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
ROWS = 4096  # vectors that are worked on together
LONGEST_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Codebook:
    """The entries of one part; by dimension their sorted coordinates and the masks of all entries before a place."""

    entries: np.ndarray
    ordered: list[np.ndarray]
    before: list[np.ndarray]
    radius: int

    @staticmethod
    def of(entries: list[list[int]]) -> Codebook:
        table = np.array(entries, np.int64).reshape(len(entries), -1)
        words = (len(entries) + 63) // 64
        ordered, before = [], []
        for axis in table.T:
            order = np.argsort(axis, kind="stable")
            masks = np.zeros((len(entries) + 1, words), np.uint64)
            for place, entry in enumerate(order):
                masks[place + 1] = masks[place]
                masks[place + 1, entry >> 6] |= np.uint64(1 << (int(entry) & 63))
            ordered.append(axis[order])
            before.append(masks)
        return Codebook(table, ordered, before, spacing(table))

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask of the entries within the radius of each part in every dimension."""
        inside = np.full((len(parts), self.before[0].shape[1]), np.uint64((1 << 64) - 1))
        for axis, (ordered, before) in enumerate(zip(self.ordered, self.before)):
            low = np.searchsorted(ordered, parts[:, axis] - radius, "left")
            high = np.searchsorted(ordered, parts[:, axis] + radius, "right")
            inside &= before[high] ^ before[low]
        return inside

    def closest(self, parts: np.ndarray, inside: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest candidate of each part, -1 without any, and its squared distance; ties to the lower number."""
        best = np.full(len(parts), -1)
        distance = exact(np.zeros(len(parts), np.int64), largest)
        for entry, place in enumerate(self.entries):
            at = np.flatnonzero(inside[:, entry >> 6] >> np.uint64(entry & 63) & np.uint64(1))
            if not len(at):
                continue
            away = exact(parts[at] - place, largest)
            away = (away * away).sum(1)
            nearer = (best[at] < 0) | (away < distance[at])
            best[at[nearer]], distance[at[nearer]] = entry, away[nearer]
        return best, distance

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest entry of each part, and its squared distance."""
        reach = max(int(np.abs(parts).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        largest = 4 * reach * reach * max(1, parts.shape[1])
        best, distance = np.zeros(len(parts), np.int64), exact(np.zeros(len(parts), np.int64), largest)
        open_, radius = np.arange(len(parts)), np.full(len(parts), self.radius)
        while len(open_):
            found, away = self.closest(parts[open_], self.candidates(parts[open_], radius), largest)
            sure = (found >= 0) & (away <= exact(radius, largest) ** 2)
            best[open_[sure]], distance[open_[sure]] = found[sure], away[sure]
            further = np.where(found >= 0, root(away), 2 * radius + 1)
            open_, radius = open_[~sure], further[~sure].astype(np.int64)
        return best, distance


def root(squares: np.ndarray) -> np.ndarray:
    """Whole numbers not below the square roots."""
    return np.array([math.isqrt(s) + 1 for s in squares], np.int64) if squares.dtype == object else np.sqrt(squares).astype(np.int64) + 2


def spacing(table: np.ndarray) -> int:
    """The median distance of an entry from its nearest other one."""
    away = np.array([np.sqrt(((table.astype(np.float64) - e) ** 2).sum(1)) for e in table])
    np.fill_diagonal(away, np.inf)
    nearest = away.min(1)[np.isfinite(away.min(1))]
    return int(min(LIMIT, np.median(nearest))) + 1 if len(nearest) else 1


def blocks(batches: Iterator[pa.RecordBatch], column: int, length: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches in pieces, each with its parts as (row, part, place)."""
    width = -(-length // parts)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            values = scaled(piece.column(column), length, SCALE)
            yield piece, np.pad(values, ((0, 0), (0, width * parts - length))).reshape(-1, parts, width)


def summed(vectors: DataFrame, length: int, books: list[Codebook]) -> DataFrame:
    """(cell, n, total): for each part, entry and place, the number and the sum of the parts nearest to the entry."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, width = books[0].entries.shape
        n = np.zeros((len(books), entries), np.int64)
        total = np.zeros((len(books), entries, width), object)
        for _, values in blocks(batches, 0, length, len(books)):
            for part, book in enumerate(books):
                best, _ = book.nearest(values[:, part])
                n[part] += np.bincount(best, minlength=entries)
                order = np.argsort(best, kind="stable")
                used, starts = np.unique(best[order], return_index=True)
                total[part, used] += np.add.reduceat(values[order, part], starts).astype(object)
        cells = [(part * entries + entry) * width + place for part, entry in zip(*np.nonzero(n)) for place in range(width)]
        sums = [Decimal(int(total.reshape(-1)[c])) for c in cells]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(n.reshape(-1)[np.array(cells, np.int64) // width], pa.int64()), pa.array(sums, pa.decimal128(38, 0))],
            names=["cell", "n", "total"],
        )

    partial = map_batches(vectors, task, "cell long, n long, total decimal(38,0)")
    return partial.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def learn(rows: DataFrame, length: int, identity: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebook]:
    """The codebooks of usable rows; every one has as many entries, at most `entries`."""
    seeds = rows.select(identity, vector).orderBy(F.col(identity).asc_nulls_last(), vector).limit(entries).select(vector).toArrow()
    width = -(-length // parts)
    batches = [b for b in seeds.to_batches() if b.num_rows]
    if not batches:
        return []
    first = np.concatenate([values for _, values in blocks(iter(batches), 0, length, parts)])
    tables = [first[:, part].tolist() for part in range(parts)]
    vectors = rows.select(vector)
    for _ in range(rounds):
        books = [Codebook.of(t) for t in tables]
        for cell, n, total in summed(vectors, length, books).collect():
            at, place = divmod(cell, width)
            part, entry = divmod(at, len(tables[0]))
            tables[part][entry][place] = int(total) // n
    return [Codebook.of(t) for t in tables]


def encode(rows: DataFrame, length: int, books: list[Codebook], vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The columns to keep of usable rows (all but the vector by default) with `code` and `error`."""
    kept = [c for c in rows.columns if c not in (vector, "code", "error")] if keep is None else keep
    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, values in blocks(batches, len(kept), length, len(books)):
            found = [book.nearest(values[:, part]) for part, book in enumerate(books)]
            digits = np.stack([best for best, _ in found], 1).astype(np.uint8)
            errors = [min(LONGEST_LONG, sum(map(int, each))) for each in zip(*(away for _, away in found))]
            made = [pa.array([row.tobytes().hex() for row in digits], pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], *made], names=[*kept, "code", "error"])

    return map_batches(rows.select(*kept, vector), task, ", ".join([*[types] * bool(types), "code string, error long"]))


def decode(code: str, books: list[Codebook]) -> list[float]:
    """The vector that a code stands for."""
    return [x / SCALE for book, entry in zip(books, bytes.fromhex(code)) for x in book.entries[entry].tolist()]


def digest(books: list[Codebook]) -> str:
    numbers = (x for book in books for x in book.entries.reshape(-1).tolist())
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def vector_codes(rows: DataFrame) -> DataFrame:
    """One row per usable row: vec_id, code, error, label_error (errors of all rows of its label), codebooks_sha256."""
    kept, length = usable(rows.select("vec_id", "embedding", "label"))
    books = learn(kept, length)
    if not books:
        return rows.sparkSession.createDataFrame([], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string")
    coded = save(encode(kept, length, books))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy("label").agg(F.least(total, F.lit(LONGEST_LONG)).cast("long").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def codes_sql() -> str:
    """`vector_codes` of tables whose vectors all have 64 components, for DuckDB."""
    steps = [f"""
    kept as (
        select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
        from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    cut as (select r, part, list_slice(v, part * 8 + 1, part * 8 + 8) as p from kept, range({PARTS}) t(part)),
    seeds as (select row_number() over (order by vec_id, v) - 1 as entry, r from kept order by vec_id, v limit {ENTRIES}),
    book0 as (select part, entry, p as e from seeds join cut using (r))"""]
    for turn in range(ROUNDS + 1):
        steps.append(f"""
    near{turn} as materialized (
        select r, cut.part, any_value(p) as p, min((away * {ENTRIES} + entry)::hugeint) as best
        from (select r, cut.part as part, p, entry, list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint as away
              from cut join book{turn} on cut.part = book{turn}.part) cut
        group by r, cut.part
    )""")
        if turn < ROUNDS:
            steps.append(f"""
    mean{turn} as (
        select part, entry, list(m order by i) as e
        from (select part, (best % {ENTRIES})::bigint as entry, i, (sum(p[i]) - ((sum(p[i]) % count(*)) + count(*)) % count(*)) // count(*) as m
              from near{turn}, range(1, 9) t(i) group by all)
        group by part, entry
    ),
    book{turn + 1} as materialized (select b.part, b.entry, coalesce(m.e, b.e) as e from book{turn} b left join mean{turn} m on m.part = b.part and m.entry = b.entry)""")
    return "with " + ",".join(steps) + f""",
    coded as (
        select vec_id, label, string_agg(printf('%02x', (best % {ENTRIES})::int), '' order by part) as code, sum(best // {ENTRIES})::bigint as error
        from near{ROUNDS} join kept using (r) group by r, vec_id, label
    )
    select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
        (select sha256(string_agg(x, ',' order by part, entry)) from (select part, entry, array_to_string(e, ',') as x from book{ROUNDS})) as codebooks_sha256
    from coded"""
