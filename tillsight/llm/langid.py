"""Operator 9, language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes with the counts of what followed
them. A byte seen in a context costs its share; otherwise the escape is paid and the next
shorter context asked, down to a flat distribution over all bytes (escape estimate: symbols
seen / (symbols seen + count)). The counts are frozen after learning, so the cost of a byte
depends on its context alone and all costs are worked out once: a text's exact code length under
every language is a sum of table rows. The language with the shortest code wins.

Learning takes a bounded sample: about SAMPLE documents of each language, chosen by the hash of
their id among those of at most LONGEST characters, whole texts. Everything in the sample counts:
every language that has a document there stays, with all of its contexts. Languages are put into
groups whose tables have at most CELLS costs each (a language that needs more is a group of its
own), so that the tables grow with the languages and not with their square. Prediction reads
every whole text.

Defined cases: a null text, a text without a letter, or any text where nothing was learned is
`und` with score 0; ties go to the language first in alphabetical order; rows without language
or text teach nothing; a null id counts as the empty text; repeated rows are predicted alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import add_columns, map_batches

ORDER = 3
SAMPLE = 400  # documents of a language that are learned from, about
LONGEST = 1 << 20  # characters of the longest text that is learned from
CELLS = 1 << 24  # costs in the table of several languages, about
CHUNK = 1 << 20  # bytes that are scored together


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def symbols_of(text: str) -> np.ndarray:
    """The bytes of a text in small letters, after a start of zeros."""
    return np.frombuffer(bytes(ORDER) + text.lower().encode(), np.uint8)


def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, gram, n): sequences of four bytes as numbers, counted in each batch."""
    for batch in batches:
        found: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            codes = symbols_of(text).astype(np.int64)
            found.setdefault(lang, []).append(codes[:-3] << 24 | codes[1:-2] << 16 | codes[2:-1] << 8 | codes[3:])
        for lang, keys in found.items():
            gram, n = np.unique(np.concatenate(keys), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])


@dataclass(frozen=True)
class Table:
    """languages; alphabet: byte -> symbol; node: three symbols -> row; cost: (row, symbol, language) in bits."""

    languages: list[str]
    alphabet: np.ndarray
    node: np.ndarray
    cost: np.ndarray

    def lengths(self, texts: list[str]) -> np.ndarray:
        """The code length of each text under each language, in bits."""
        size, total = int(self.alphabet.max()) + 1, np.zeros((len(texts), len(self.languages)))
        step = max(1024, CHUNK * 4 // max(4, len(self.languages)))
        for row, text in enumerate(texts):
            codes = self.alphabet[symbols_of(text)]
            for start in range(0, len(codes) - ORDER, step):
                part = codes[start : start + step + ORDER]
                context = (part[:-3] * size + part[1:-2]) * size + part[2:-1]
                total[row] += self.cost[self.node[context], part[3:]].sum(0, dtype=np.float64)
        return total


@dataclass(frozen=True)
class Model:
    """The tables of all groups of languages."""

    tables: list[Table]

    @property
    def languages(self) -> list[str]:
        return [lang for t in self.tables for lang in t.languages]

    def lengths(self, texts: list[str]) -> np.ndarray:
        return np.concatenate([t.lengths(texts) for t in self.tables], 1)

    def predict(self, texts: list[str]) -> dict[str, list]:
        lettered = [any(map(str.isalpha, t)) for t in texts]
        languages = self.languages
        if not languages:
            return {"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts)}
        bits = self.lengths([t if some else "" for t, some in zip(texts, lettered)])
        best = bits.argmin(1)
        behind = np.minimum(bits - bits.min(1, keepdims=True), 1000)
        score = 1 / np.exp2(-behind).sum(1)
        return {
            "lang_pred": [languages[b] if some else "und" for b, some in zip(best, lettered)],
            "score": [float(s) if some else 0.0 for s, some in zip(score, lettered)],
        }


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Table:
    """The table of some counted sequences; lang numbers the languages."""
    each = np.stack([gram >> 24 & 255, gram >> 16 & 255, gram >> 8 & 255, gram & 255], 1)
    present = np.unique(each[each > 0])
    alphabet = np.zeros(256, np.int64)
    alphabet[present] = np.arange(1, len(present) + 1)  # 0: the start and bytes never seen
    size, many = len(present) + 1, max(1, len(languages))
    codes = alphabet[each]
    node, rows, parent_cost = np.zeros(1, np.int64), 0, np.full((1, size, many), math.log2(256))
    tables = []
    for order in range(ORDER + 1):
        context = np.zeros(len(codes), np.int64)
        for k in range(ORDER - order, ORDER):
            context = context * size + codes[:, k]
        kinds, at = np.unique(context, return_inverse=True)
        counts = np.zeros((len(kinds), size, many))
        np.add.at(counts, (at, codes[:, ORDER], lang), n)
        # the longest suffix of a context that was seen answers for what the context has not seen
        shorter = kinds % size ** max(0, order - 1)
        below = parent_cost[0][None].repeat(len(kinds), 0) if order == 0 else np.concatenate(tables)[node[shorter]]
        total, different = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            known, escape = -np.log2(counts / (total + different)), -np.log2(different / (total + different))
        cost = np.where(counts > 0, known, np.where(total > 0, escape + below, below))
        tables.append(cost.astype(np.float32))
        wider = np.tile(node, size) if order else np.zeros(1, np.int64)
        wider[kinds] = rows + np.arange(len(kinds))
        node, rows = wider, rows + len(kinds)
    return Table(languages, alphabet, node.astype(np.int32), np.concatenate(tables))


def grouped(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The model of some counted sequences, sorted by lang: languages in order, as many to a table as fit."""
    tables, bounds, start = [], np.searchsorted(lang, np.arange(len(languages) + 1)), 0
    contexts, symbols = (np.zeros(0, np.int64),) * 2
    for at in range(len(languages)):
        own = gram[bounds[at] : bounds[at + 1]]
        wider, more = np.union1d(contexts, own >> 8), np.union1d(symbols, own & 255)
        if at > start and len(wider) * (len(more) + 1) * (at + 1 - start) > CELLS:
            part = slice(bounds[start], bounds[at])
            tables.append(build(languages[start:at], lang[part] - start, gram[part], n[part]))
            start, wider, more = at, np.unique(own >> 8), np.unique(own & 255)
        contexts, symbols = wider, more
    if languages:
        part = slice(bounds[start], None)
        tables.append(build(languages[start:], lang[part] - start, gram[part], n[part]))
    return Model(tables)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from about `sample` documents of each language in docs (doc_id, lang, text)."""
    labelled = docs.where("lang is not null and text is not null").where(F.length("text") <= LONGEST)
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))]) if counts else F.create_map().cast("map<string,double>")
    luck = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    chosen = labelled.where(luck < F.coalesce(share[F.col("lang")], F.lit(0.0))).select("lang", "text")
    counted = map_batches(chosen, grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counted.toPandas().sort_values(["lang", "gram"])
    languages = sorted(found["lang"].unique().tolist())
    number = {lang: i for i, lang in enumerate(languages)}
    return grouped(languages, found["lang"].map(number).to_numpy(np.int64), found["gram"].to_numpy(np.int64), found["n"].to_numpy(np.int64))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with `lang_pred` and `score`, the winner's share of probability among all languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, F.coalesce(F.col(text).cast("string"), F.lit("")), {"lang_pred": "string", "score": "double"}, lambda texts: shared.value.predict(texts), keep)


def language_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learned from the documents that are not held out."""
    own = docs.select("doc_id", "lang", "text", held_out().alias("held_out"))
    model = learn(own.where("not held_out"))
    return identify(own.select("doc_id", "held_out", "text"), model, keep=["doc_id", "held_out"])
