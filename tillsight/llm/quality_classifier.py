"""Operator 12, quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of WORDS words. Each passage is encoded: shares of hashed byte
pairs and of kinds of characters, word lengths and different words, standardised and taken
through a learned layer. Gated attention, w . (tanh(V h) * sigmoid(U h)), weighs the passages of
a document against each other, and the document is scored by its weighted mean passage. All
weights are learned together from the labels of whole documents; no passage has a label.

Learning takes a bounded sample: about SAMPLE labelled documents, chosen by the hash of their
id, of those with at most LONGEST passages. They are encoded where they are, and only their
passages reach the driver (at most SAMPLE * LONGEST rows of FEATURES numbers). Scoring reads
every whole text in one narrow pass; passages of a long text are weighed in pieces that are
added up, so memory does not grow with a text.

Defined cases: a null or empty text, or one without words, is one empty passage and gets its
score; a word of more than LETTERS characters counts as several; several labels of an id teach
their mean, null labels and ids teach nothing, and of several texts of an id one is learned
from; without any label, or with none of one kind, scores are the mean label (0.5 without any);
repeated rows are scored alike; a null id counts as the empty text for being held out; an empty
table gives an empty result; a column named like a result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import add_columns, whole

WORDS = 50  # words of a passage
LETTERS = 256
PIECE = 1024  # passages of a text that are encoded together
SAMPLE, LONGEST = 3000, 64  # documents that teach, about, and passages of each
BUCKETS = 128
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4
LEAST_SCORE = 0.3

WORD = re.compile(r"[^\x20\x09-\x0D]{1,%d}" % LETTERS)
KINDS = ("lower", "upper", "digit", "mark", "point", "other")
FEATURES = BUCKETS + len(KINDS) + 4


def kind_table() -> np.ndarray:
    """The kind of each byte; a space is the last kind plus one."""
    kinds = np.full(256, KINDS.index("other"))
    for code in range(33, 127):
        c = chr(code)
        kinds[code] = KINDS.index("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "mark" if c in "#*$%&|<>" else "point")
    kinds[32] = len(KINDS)
    return kinds


def bucket_table() -> np.ndarray:
    """The bucket of each pair of bytes, capital letters taken as small ones."""
    small = np.arange(256)
    small[65:91] += 32
    pairs = (small[:, None] * 256 + small[None]).reshape(-1).astype(np.uint64)
    return (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BUCKETS


KIND, BUCKET = kind_table(), bucket_table()


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def pieces_of(text: str) -> Iterator[list[str]]:
    """The words of a text, PIECE passages at a time; at least one list, which may be empty."""
    if len(text) < PIECE * WORDS:
        yield WORD.findall(text)
        return
    found = (m[0] for m in WORD.finditer(text))
    yield list(islice(found, PIECE * WORDS))
    while more := list(islice(found, PIECE * WORDS)):
        yield more


def encode(bags: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage of some lists of words, and each list's first row."""
    sizes = np.array([len(b) for b in bags])
    passages = np.maximum(1, -(-sizes // WORDS))
    starts = np.concatenate([[0], np.cumsum(passages)[:-1]])
    many = int(passages.sum())
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(starts, sizes) + place // WORDS
    words = [w for bag in bags for w in bag]
    codes = np.frombuffer("".join([" " + w for w in words]).encode(), np.uint8).astype(np.int64)
    at = passage[np.cumsum(codes == 32) - 1] if len(codes) else np.zeros(0, np.int64)
    inside = np.flatnonzero(codes[1:] != 32)  # no pair reaches from one word to the next, let alone to another text
    pairs = np.bincount(at[inside] * BUCKETS + BUCKET[codes[inside] * 256 + codes[inside + 1]], minlength=many * BUCKETS).reshape(many, BUCKETS)
    kinds = np.bincount(at * (len(KINDS) + 1) + KIND[codes], minlength=many * (len(KINDS) + 1)).reshape(many, -1)[:, :-1]
    n = np.bincount(passage, minlength=many)
    bounds = np.concatenate([[0], np.cumsum(n)]).tolist()
    different = np.array([len(set(words[a:b])) for a, b in zip(bounds, bounds[1:])])
    longest = np.zeros(many)
    np.maximum.at(longest, passage, np.fromiter(map(len, words), np.float64, len(words)))
    bytes_ = kinds.sum(1)
    share = lambda part, all_: part / np.maximum(1, all_)
    rows = [np.sqrt(share(pairs, pairs.sum(1)[:, None])), np.sqrt(share(kinds, bytes_[:, None]))]
    rows += [c[:, None] for c in (share(bytes_, n) / 10, np.log1p(longest), share(different, n), np.log1p(n))]
    return np.concatenate(rows, 1).astype(np.float32), starts


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Model:
    """centre, width: of the features; weights: by name; constant: the score where nothing could be learned."""

    centre: np.ndarray
    width: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def represent(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The representation of each passage, and the attention it gets before normalisation."""
        w = self.weights
        h = np.tanh((features - self.centre) / self.width @ w["E"] + w["e"])
        return h, (np.tanh(h @ w["V"]) * sigmoid(h @ w["U"])) @ w["w"]

    def scores(self, texts: list[str]) -> list[float]:
        if self.constant is not None:
            return [self.constant] * len(texts)
        top, total, mean = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros((len(texts), HIDDEN))

        def add(owners: list[int], bags: list[list[str]]) -> None:
            features, starts = encode(bags)
            h, a = self.represent(features)
            sizes = np.diff(np.append(starts, len(a)))
            highest = np.maximum.reduceat(a, starts)
            weight = np.exp(a - np.repeat(highest, sizes))
            for owner, high, amount, part in zip(owners, highest, np.add.reduceat(weight, starts), np.add.reduceat(weight[:, None] * h, starts)):
                new = max(top[owner], high)
                old, own = np.exp(top[owner] - new), np.exp(high - new)
                top[owner], total[owner], mean[owner] = new, total[owner] * old + amount * own, mean[owner] * old + part * own

        owners, bags, room = [], [], PIECE * WORDS
        for owner, text in enumerate(texts):
            for bag in pieces_of(text):
                owners.append(owner)
                bags.append(bag)
                room -= max(len(bag), WORDS)
                if room <= 0:
                    add(owners, bags)
                    owners, bags, room = [], [], PIECE * WORDS
        if bags:
            add(owners, bags)
        return sigmoid(mean / total[:, None] @ self.weights["c"] + self.weights["d"]).tolist()


def gradients(weights: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The mean log loss of some bags of standardised passages, and its gradients."""
    w = weights
    sizes = np.diff(np.append(starts, len(x)))
    bag = np.repeat(np.arange(len(starts)), sizes)
    h = np.tanh(x @ w["E"] + w["e"])
    t, g = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
    a = (t * g) @ w["w"]
    weight = np.exp(a - np.maximum.reduceat(a, starts)[bag])
    alpha = weight / np.add.reduceat(weight, starts)[bag]
    z = np.add.reduceat(alpha[:, None] * h, starts)
    s = sigmoid(z @ w["c"] + w["d"])
    loss = -np.mean(labels * np.log(s + 1e-9) + (1 - labels) * np.log(1 - s + 1e-9))
    ds = (s - labels) / len(labels)
    dz = ds[:, None] * w["c"]
    by_passage = (h * dz[bag]).sum(1)
    da = alpha * (by_passage - np.add.reduceat(alpha * by_passage, starts)[bag])
    dt, dg = da[:, None] * w["w"] * g * (1 - t * t), da[:, None] * w["w"] * t * g * (1 - g)
    dh = (alpha[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
    return loss, {"E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ da, "c": z.T @ ds, "d": ds.sum()}


def start(dice: np.random.Generator) -> dict[str, np.ndarray]:
    spread = lambda *shape: dice.normal(0, 1 / np.sqrt(shape[0]), shape)
    return {"E": spread(FEATURES, HIDDEN), "e": np.zeros(HIDDEN), "V": spread(HIDDEN, GATE), "U": spread(HIDDEN, GATE), "w": spread(GATE), "c": spread(HIDDEN), "d": np.zeros(())}


def train(bags: list[np.ndarray], labels: list[float], seed: int = 12) -> Model:
    """A model of some bags, each a matrix with a row of features a passage, by Adam on small batches."""
    nothing = np.zeros(FEATURES)
    if not bags or min(labels) == max(labels):
        return Model(nothing, nothing + 1, {}, float(np.mean(labels)) if bags else 0.5)
    everything = np.concatenate(bags).astype(np.float64)
    centre, width = everything.mean(0), everything.std(0) + 1e-3
    inputs, target = [(b - centre) / width for b in bags], np.array(labels, np.float64)
    dice = np.random.default_rng(seed)
    weights = start(dice)
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    turn = 0
    for epoch in range(EPOCHS):
        order = dice.permutation(len(inputs))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = np.array([len(inputs[i]) for i in chosen])
            _, change = gradients(weights, np.concatenate([inputs[i] for i in chosen]), np.cumsum(sizes) - sizes, target[chosen])
            turn += 1
            for k, g in change.items():
                g = g + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
    return Model(centre, width, weights)


def teaching(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> tuple[list[np.ndarray], list[float]]:
    """The encoded passages and labels of the sample, in the order of their ids.

    The labels are sampled first; about `sample` rows of them, no more, are sent to the documents.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("label"))
    luck = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    chosen = known.where(luck < sample / max(1, known.count()))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(whole()).alias("text"), F.first("label").alias("label"))

    def work(found: list[str]) -> dict[str, list]:
        first = [next(pieces_of(t)) for t in found]
        return {"passages": [encode([words])[0].tobytes() if len(words) <= longest * WORDS else None for words in first]}

    rows = add_columns(texts, F.col("text"), {"passages": "binary"}, work, keep=["doc_id", "label"]).where("passages is not null").toPandas().sort_values("doc_id")
    return [np.frombuffer(p, np.float32).reshape(-1, FEATURES) for p in rows["passages"]], rows["label"].astype(float).tolist()


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with `score`, the chance that a text's label is 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, whole(text), {"score": "double"}, lambda texts: {"score": shared.value.scores(texts)}, keep)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs, learned from the labels that are not held out."""
    model = train(*teaching(docs, labels.select("doc_id", "quality")))
    scored = score(docs.select("doc_id", "text", held_out().alias("held_out")), model, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
