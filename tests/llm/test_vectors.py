"""Vector codes, whitening and the quality classifier against plain versions and held-out labels."""

from __future__ import annotations

import math
import random
import zlib

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import embeddings, quality_classifier, queries, vector_codes, whitening
from tillsight.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, code string, N string, whitened string"


def odd_vectors(spark, width=64, n=120, seed=3, far=5.0e3):
    """Rows with everything that must go, with ties, equal rows and ids, and columns named like results."""
    dice = np.random.default_rng(seed)
    good = [(int(i), [float(np.float32(x)) for x in dice.normal(0, 0.2, width)], int(i) % 3 if i % 7 else None) for i in dice.permutation(n)]
    good += [good[0], good[0], (good[1][0], good[2][1], 1), (None, good[3][1], None), (None, [0.0] * width, 2), (-5, [-0.0] * width, 2), (-4, [far] * width, 2)]
    bad = [(-9, None, 1), (-8, [float("nan")] * width, 1), (-7, [math.inf] + [0.0] * (width - 1), 1), (-6, [None] + [0.0] * (width - 1), 1), (-3, [], 1), (-2, [1.0, 2.0], None)]
    rows = good + bad
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return frame, good


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) of rows (vec_id, vector, label), and the codebooks."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[math.floor(4096 * x) for x in r[1]] for r in rows]
    width = -(-len(cut[0]) // parts)
    cut = [[(x + [0] * (width * parts - len(x)))[p * width : (p + 1) * width] for p in range(parts)] for x in cut]
    books = [[list(x[p]) for x in cut[:entries]] for p in range(parts)]
    near = lambda p, v: min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            chosen = [near(p, x[p])[1] for x in cut]
            for k in range(len(books[p])):
                mine = [x[p] for x, c in zip(cut, chosen) if c == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[near(p, x[p]) for p in range(parts)] for x in cut]
    total = {}
    for (_, _, label), f in zip(rows, found):
        total[label] = total.get(label, 0) + sum(d for d, _ in f)
    coded = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), total[label]) for (i, _, label), f in zip(rows, found)]
    return coded, brute.sha(",".join(str(x) for b in books for e in b for x in e))


def rows(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


CODES = ("vec_id", "code", "error", "label_error")


@pytest.mark.parametrize("width, n", [(64, 120), (13, 40), (64, 4)])
def test_codes_of_odd_vectors(spark, monkeypatch, width, n):
    monkeypatch.setattr(vector_codes, "ROWS", 17)
    frame, good = odd_vectors(spark, width, n)
    want, books = plain_codes(good)
    found = vector_codes.vector_codes(frame)
    assert rows(found, *CODES) == sorted(want, key=repr)
    assert {r.codebooks_sha256 for r in found.collect()} == {books}
    assert found.columns == [*CODES, "codebooks_sha256"]


def test_no_vectors(spark):
    frame, _ = odd_vectors(spark)
    for empty in (frame.limit(0), frame.where("vec_id in (-9, -8, -7, -6, -3)")):
        assert vector_codes.vector_codes(empty).collect() == [] == whitening.whitened_vectors(empty).collect()
        assert vector_codes.vector_codes(empty).columns == [*CODES, "codebooks_sha256"]
        assert whitening.whitened_vectors(empty).columns == WHITE


def test_codes_match_sql(spark, folder):
    database = duckdb.connect()
    database.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    expected = database.execute(f"select {', '.join((*CODES, 'codebooks_sha256'))} from ({vector_codes.codes_sql()})").fetchall()
    assert rows(queries.compressed_vectors(spark, folder), *CODES, "codebooks_sha256") == sorted(expected, key=repr)


@pytest.mark.parametrize("entries, spread", [(1, 10), (16, 3), (64, 200), (65, 1000), (200, 5), (16, 1 << 40)])
def test_the_nearest_entry_is_found_from_masks(entries, spread):
    """More than one word of masks, many ties, and numbers beyond 64 bits when squared."""
    dice = np.random.default_rng(entries)
    table_ = dice.integers(-spread, spread + 1, (entries, 5))
    parts = np.concatenate([dice.integers(-2 * spread, 2 * spread + 1, (300, 5)), table_])
    best, away = vector_codes.Codebook.of(table_.tolist()).nearest(parts)
    for part, b, d in zip(parts.astype(object), best, away):
        each = [(int(((part - e) ** 2).sum()), k) for k, e in enumerate(table_.astype(object))]
        assert (int(d), int(b)) == min(each)


def test_masks_hold_exactly_the_cube():
    dice = np.random.default_rng(1)
    table_ = dice.integers(-50, 50, (70, 4))
    book = vector_codes.Codebook.of(table_.tolist())
    parts, radius = dice.integers(-60, 60, (200, 4)), dice.integers(0, 60, 200)
    for part, r, words in zip(parts, radius, book.candidates(parts, radius)):
        inside = {k for k in range(128) if int(words[k >> 6]) >> (k & 63) & 1}
        assert inside & set(range(70)) == {k for k, e in enumerate(table_) if (abs(e - part) <= r).all()}


def test_decoded_vectors_lie_within_their_error(spark):
    frame, good = odd_vectors(spark)
    kept, length = embeddings.usable(frame)
    books = vector_codes.learn(kept, length)
    for r in vector_codes.encode(kept, length, books, keep=["embedding"]).limit(20).collect():
        away = sum((math.floor(4096 * a) - 4096 * b) ** 2 for a, b in zip(r.embedding, vector_codes.decode(r.code, books)))
        assert away == r.error


# ---- whitening ----------------------------------------------------------------------------

WHITE = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain_whitening(good):
    x = np.array([[math.floor(256 * c) + 0 for c in r[1]] for r in good], object)
    each = np.array(sorted({tuple(r) for r in x}), object)
    n, sums = len(each), each.sum(0)
    around = n * each - sums
    covariance = (around.T @ around / n**3).astype(float)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:4], directions[:, ::-1][:, :4]
    return n, ((n * x - sums) ** 2).sum(1), ((n * x - sums).astype(float) / n) @ directions / np.sqrt(values), values / np.trace(covariance)


@pytest.mark.parametrize("width, n, block", [(64, 120, 8192), (64, 120, 7), (5, 40, 64)])
def test_whitening_of_odd_vectors(spark, monkeypatch, width, n, block):
    monkeypatch.setattr(whitening, "ROWS", block)
    frame, good = odd_vectors(spark, width, n, far=1.5)
    found = whitening.whitened_vectors(frame)
    assert found.columns == WHITE
    count, deviation, white, explained = plain_whitening(good)
    got = found.toPandas().sort_values(["component"], kind="stable")
    assert len(got) == 4 * len(good) and set(got["n"]) == {count} and got["identity_error"].max() < 1e-9
    for c in range(4):
        part = got[got["component"] == c + 1]
        key = lambda i, d, w: (i is None or i != i, i if i == i and i is not None else 0, d, w)
        mine = sorted(key(i, d, w) for i, d, w in zip(part["vec_id"], part["deviation"], part["whitened"]))
        best = min((max(abs(a[3] - b[3]) for a, b in zip(mine, theirs)), theirs) for theirs in (sorted(key(r[0], d, s * w) for r, d, w in zip(good, deviation, white[:, c])) for s in (1, -1)))
        assert best[0] < 1e-9 and [m[:3] for m in mine] == [b[:3] for b in best[1]]
        assert part["explained"].iloc[0] == pytest.approx(explained[c], rel=1e-9)


@pytest.mark.parametrize("low, high, n, width", [(-200, 200, 1000, 6), (0, 1, 5, 3), (7, 8, 10, 2), (-(2**40), 2**40, 300, 4), (-3, 3, 64, 70)])
def test_scatter_from_bits(low, high, n, width):
    x = np.random.default_rng(n).integers(low, high, (n, width))
    sums, products = whitening.scatter(x)
    exact = x.astype(object)
    assert (sums == exact.sum(0)).all() and (products == exact.T @ exact).all()


def test_directions_without_variance_are_left_out(spark):
    flat = spark.createDataFrame([(i, [float(i % 3), 1.0, 2.0 * (i % 3)]) for i in range(10)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whitened_vectors(flat).collect()} == {1}
    assert whitening.whitened_vectors(flat.limit(1)).collect() == []


def test_whitening_of_the_given_vectors(spark, folder):
    given = [(r.vec_id, r.embedding, r.label) for r in table(spark, folder, "embeddings").collect()]
    count, deviation, white, explained = plain_whitening(given)
    found = {(r.vec_id, r.component): r for r in queries.whitened_embeddings(spark, folder).collect()}
    assert len(found) == 4 * len(given)
    sign = [np.sign(sum(found[i, c + 1].whitened * w for (i, _, _), w in zip(given, white[:, c]))) for c in range(4)]
    for (i, _, _), d, w in zip(given, deviation, white):
        for c in range(4):
            assert found[i, c + 1].deviation == d and found[i, c + 1].whitened == pytest.approx(sign[c] * w[c], abs=1e-9)


# ---- quality classifier --------------------------------------------------------------------


def test_held_out_labels_are_predicted(spark, folder):
    """On the given tables: learned from four fifths of the labels, held against the rest."""
    scored = queries.passage_quality(spark, folder)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == table(spark, folder, "documents").count()
    assert not scored.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.collect())
    large = folder.replace("sf0.001", "sf0.01")
    found = queries.passage_quality(spark, large).join(table(spark, large, "labels"), "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in found])
    good, bad = [r.score for r in found if r.quality == 1], [r.score for r in found if r.quality == 0]
    assert right > 0.93 and np.mean([g > b for g in good for b in bad]) > 0.95 and len(bad) > 5


def test_labels_of_held_out_rows_do_not_teach(spark, docs):
    ids = [r.doc_id for r in docs.where("doc_id is not null").select("doc_id").distinct().collect()]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    other = labels.withColumn("quality", F.when(quality_classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows(quality_classifier.quality_scores(docs, labels), "doc_id", "score") == rows(quality_classifier.quality_scores(docs, other), "doc_id", "score")


def test_odd_documents_and_labels(spark, docs, no_docs, odd):
    odd_labels = [(4, 1), (4, 0), (4, 1), (9, 0), (9, None), (None, 1), (14, 0), (10, 1), (11, 1), (12, 1), (13, 0), (20, 1), (21, 0), (999, 1)]
    labels = spark.createDataFrame(odd_labels, "doc_id long, quality int").withColumn("score", F.lit("x"))
    found = quality_classifier.quality_scores(docs, labels).collect()
    assert len(found) == len(odd) and all(0 <= r.score <= 1 for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[1] == by_id[2] == by_id[3] and len(by_id[7]) == 1
    assert quality_classifier.quality_scores(no_docs, labels).collect() == []
    for none, constant in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0 and doc_id <> 4"), 0.0)):
        assert {r.score for r in quality_classifier.quality_scores(docs, none).collect()} == {constant}


def test_gradients_match_differences():
    dice = np.random.default_rng(0)
    weights = quality_classifier.start(dice)
    x, starts, labels = dice.normal(size=(9, quality_classifier.FEATURES)), np.array([0, 2, 3]), np.array([1, 0, 0.5])
    loss, found = quality_classifier.gradients(weights, x, starts, labels)
    for name, value in weights.items():
        at = tuple(0 for _ in value.shape)
        moved = {k: np.array(v) for k, v in weights.items()}
        moved[name][at] += 1e-6
        assert np.asarray(found[name])[at] == pytest.approx((quality_classifier.gradients(moved, x, starts, labels)[0] - loss) / 1e-6, rel=1e-3, abs=1e-7)


def test_a_text_in_pieces_scores_as_a_whole(monkeypatch):
    """Attention over all passages at once against pieces, and against one bag worked out plainly."""
    dice = random.Random(2)
    texts = [" ".join("".join(dice.choices("abcdeXYZ!#", k=dice.randrange(1, 9))) for _ in range(n)) for n in (0, 1, 49, 50, 51, 700, 3000)] + ["w" * 5000]
    model = quality_classifier.train([quality_classifier.encode([next(quality_classifier.pieces_of(t))])[0] for t in texts], [0.0, 1.0] * 4)
    whole = model.scores(texts)
    monkeypatch.setattr(quality_classifier, "PIECE", 3)
    assert np.allclose(model.scores(texts), whole)
    for text, score in zip(texts, whole):
        found = quality_classifier.WORD.findall(text)
        bags = [found[i : i + 50] for i in range(0, len(found), 50)] or [[]]
        h, a = model.represent(np.concatenate([quality_classifier.encode([b])[0] for b in bags]))
        alpha = np.exp(a - a.max()) / np.exp(a - a.max()).sum()
        assert score == pytest.approx(1 / (1 + math.exp(-(alpha @ h @ model.weights["c"] + model.weights["d"]))), abs=1e-6)
