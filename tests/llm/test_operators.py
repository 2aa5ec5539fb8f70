"""Each operator against its plain version, on odd rows, empty tables and the given ones."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import bpe, bpe_codec, chat, components, decontamination, langid, quality_rules, queries, secrets, simhash, substring_dedup, token_counts, url_filter
from tillsight.llm.common import table


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def given(spark, folder, name="documents"):
    return [(r[0], r[1]) for r in table(spark, folder, name).select("doc_id" if name == "documents" else "item_id", "text").collect()]


# ---- 1 ----------------------------------------------------------------------------------

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark, docs, no_docs, odd, folder):
    found = quality_rules.quality_verdicts(docs)
    assert rows(found, *BASE) == sorted(((r[0], *brute.base_quality(r[1])) for r in odd), key=repr)
    assert not found.where("base_failed and kept").count()
    assert quality_rules.quality_verdicts(no_docs).count() == 0
    assert rows(queries.adaptive_quality(spark, folder), *BASE) == sorted(((d, *brute.base_quality(t)) for d, t in given(spark, folder)), key=repr)


def test_thresholds_follow_their_group_and_sketches_merge(spark):
    values = [("en", "a", v) for v in range(1, 1001)] + [("en", "b", 7)] * 3 + [(None, None, 500)] * 250
    measured = spark.createDataFrame(values, "lang string, source string, v long").select("lang", "source", *[F.col("v").alias(m) for m in quality_rules.MEASURES], F.lit(30).alias("n_words"))
    limits = {(r.lang, r.source): r for r in quality_rules.thresholds(quality_rules.sketch(measured)).collect()}
    spread, prior, margin = quality_rules.SPREAD, quality_rules.PRIOR, quality_rules.MEASURES["symbol_rate"][0]
    assert abs(limits["en", "a"].symbol_rate_most - margin - (500 + spread * 250)) <= (500 + spread * 500) / 8
    few = (3 * 7 + prior * 500) / (3 + prior) + spread * (prior * 250) / (3 + prior)  # three rows hardly move the language's quartiles
    assert abs(limits["en", "b"].symbol_rate_most - margin - few) <= (500 + spread * 500) / 8
    assert limits[None, None].symbol_rate_most < limits["en", "a"].symbol_rate_most
    halves = quality_rules.sketch(measured.where("symbol_rate % 2 = 0")).union(quality_rules.sketch(measured.where("symbol_rate % 2 = 1")))
    assert {(r.lang, r.source): r for r in quality_rules.thresholds(halves).collect()} == limits


def plain_kept(rows_):
    """kept of (text, lang, source) rows: bins, quartiles, shrinkage and thresholds worked out plainly."""
    def measures(text):
        ws, lines = brute.words(text), [x for x in (text or "").split("\n") if brute.words(x)]
        chars = max(1, sum(map(len, ws)))
        near = sum(w in ws[max(0, i - 2) : i] for i, w in enumerate(ws))
        marks, capitals = sum(c in "#*$%&|<>" for c in text or ""), len(regex.findall(r"\p{Lu}", text or ""))
        n = max(1, len(ws))
        return {"word_length": sum(map(len, ws)) * 100 // n, "symbol_rate": marks * 1000 // n, "dup_line_rate": (len(lines) - len(set(lines))) * 1000 // max(1, len(lines)), "capital_rate": capitals * 1000 // chars, "repeat_rate": near * 1000 // n}

    def floor_of_bin(v):
        return v if v < 32 else v >> (v.bit_length() - 5) << (v.bit_length() - 5)

    found = [measures(t) for t, _, _ in rows_]
    def quartiles(chosen, name):
        values = sorted(floor_of_bin(found[i][name]) for i in chosen)
        return len(values), [values[-(-len(values) * q // 100) - 1] for q in (25, 50, 75)]

    counted = [i for i, (t, _, _) in enumerate(rows_) if brute.words(t)]
    kept = []
    for i, (text, lang, source) in enumerate(rows_):
        good = not brute.base_quality(text)[5]
        for name, (above, below) in quality_rules.MEASURES.items() if good else ():
            _, q = quartiles(counted, name)
            for keep in (lambda r: r[1] == lang, lambda r: r[1:] == (lang, source)):
                n, own = quartiles([j for j in counted if keep(rows_[j])], name)
                q = [(n * a + quality_rules.PRIOR * b) // (n + quality_rules.PRIOR) for a, b in zip(own, q)]
            good &= found[i][name] <= q[1] + above + quality_rules.SPREAD * (q[2] - q[1])
            good &= below is None or found[i][name] >= q[1] - below - quality_rules.SPREAD * (q[1] - q[0])
        kept.append(good)
    return kept


def test_verdicts_equal_plain_thresholds(spark, docs, odd, folder):
    given_rows = [(r.doc_id, r.text, r.lang, r.source) for r in table(spark, folder, "documents").collect()]
    for frame, rows_ in ((docs, odd), (table(spark, folder, "documents"), given_rows)):
        want = sorted(((r[0], k) for r, k in zip(rows_, plain_kept([r[1:4] for r in rows_]))), key=repr)
        assert rows(quality_rules.quality_verdicts(frame), "doc_id", "kept") == want


def test_rejected_documents_are_the_bad_ones(spark, folder):
    """Against the labels of the larger tables, which no threshold has seen."""
    large = folder.replace("sf0.001", "sf0.01")
    found = queries.adaptive_quality(spark, large).join(table(spark, large, "labels"), "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1 and len(bad) > 10


def test_quality_filter_keeps_clean_rows(spark, docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    verdicts = quality_rules.quality_verdicts(docs)
    assert rows(kept, "doc_id") == rows(verdicts.where("kept"), "doc_id")
    assert 14 not in {r.doc_id for r in kept.collect()}


# ---- 2 and 4 ----------------------------------------------------------------------------


def test_token_ids_and_counts(spark, docs, no_docs, odd, folder):
    library = Tokenizer.from_file(queries.VOCABULARY)
    expected, counts = [], []
    for doc_id, text in [(r[0], r[1]) for r in odd] + given(spark, folder):
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(library.decode(ids, skip_special_tokens=False))))
        counts.append((doc_id, len((text or "").encode()), len(ids), len(ids) > 512))
    both = docs.select("doc_id", "text").union(table(spark, folder, "documents").select("doc_id", "text"))
    assert rows(bpe_codec.encode_digests(both, queries.VOCABULARY), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert rows(token_counts.count_tokens(both, queries.VOCABULARY), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(counts, key=repr)
    encoded = bpe_codec.encode_documents(docs, queries.VOCABULARY)
    assert encoded.schema["ids"].dataType.simpleString() == "array<int>" and encoded.count() == len(odd)
    assert bpe_codec.encode_documents(no_docs, queries.VOCABULARY).count() == token_counts.count_tokens(no_docs, queries.VOCABULARY).count() == 0


def test_forced_cuts_and_order_of_merges():
    library, dice = Tokenizer.from_file(queries.VOCABULARY), random.Random(3)
    codec, merger = bpe_codec.encoder(queries.VOCABULARY), token_counts.merger(queries.VOCABULARY)
    texts = ["".join(chr(dice.choice([dice.randrange(32, 127), dice.randrange(0x3000), dice.randrange(0x10000, 0x1FFFF)])) for _ in range(200)) for _ in range(100)]
    texts += ["".join(dice.choice("abx ") for _ in range(300)) for _ in range(100)] + ["<|endoftext|>" * 3, "aaaaaaa" * 40, "’s I'll  \n\n x"]
    for text, packed, n in zip(texts, codec.encode(texts), merger.count(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids and n == len(ids)
        assert codec.decode(packed) == library.decode(ids, skip_special_tokens=False)
    inside = codec.inside
    assert not inside[ord("a"), ord(" ")] and inside[ord(" "), ord("t")]
    assert bpe_codec.cut(b"ab cd", np.array([5]), inside)[0] == [b"ab", b" cd"]


def test_unsafe_pairs_merge_one_by_one():
    """A pair whose product takes part in a lower rank must not be merged everywhere at once."""
    merger = object.__new__(token_counts.Merger)
    a, b, c, ab, bc, abc, abca = range(7)
    table_ = sorted([(a, b, 3, ab), (b, c, 0, bc), (a, bc, 2, abc), (abc, a, 1, abca)])
    merger.base, merger.byte_ids = 7, np.array([a, b, c] + [a] * 253)
    merger.keys = np.array([x * 7 + y for x, y, _, _ in table_] + [token_counts.NONE])
    merger.ranks = np.array([r for _, _, r, _ in table_] + [token_counts.NONE])
    merger.made = np.array([bc, abca, abc, ab])
    merger.together = np.array([True, True, False, True])
    symbols, counts = merger.merge([bytes([0, 1, 2, 0, 1, 2])])
    assert symbols.tolist() == [abca, bc] and counts.tolist() == [2]


# ---- 3 ----------------------------------------------------------------------------------


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_secrets(spark, docs, no_docs, odd, folder):
    for found, expected in ((secrets.scan(docs), [(r[0], r[1]) for r in odd]), (queries.secret_scan(spark, folder), given(spark, folder))):
        want = sorted(((d, *[sum(s[1] == k for s in brute.secrets(t)) for k in range(3)], brute.sha(listed(brute.secrets(t)))) for d, t in expected), key=repr)
        assert rows(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
        assert not found.where("n_assign + n_access + n_hex > 0 and spans = ''").count()
    assert secrets.scan(no_docs).count() == 0
    redacted = {r.doc_id: r.text for r in secrets.redact_secrets(docs).where("doc_id in (12, 7)").collect()}
    assert redacted == {7: "a b", 12: "[SECRET]' [SECRET] [SECRET] é\U0001f642<|endoftext|> end"}


def test_entropy_windows_match_counting_anew():
    dice = random.Random(5)
    for _ in range(200):
        text = "".join(dice.choice("abcdefgh0123456789XYZ" if dice.random() < 0.7 else "aa1") for _ in range(dice.randrange(20, 90)))
        hit = set()
        for i in range(len(text) - 19):
            part = text[i : i + 20]
            entropy = -sum(part.count(c) / 20 * np.log2(part.count(c) / 20) for c in set(part))
            if entropy >= 3.5 - 1e-9:
                hit.update(range(i, i + 20))
        assert {p for a, b in secrets.dense(text, 20, 3.5) for p in range(a, b)} == hit


@pytest.mark.parametrize("alphabet, least", [
    ("0123456789", 0.85), ("0123456789abcdef", 0.9), ("abcdefghijklmnopqrstuvwxyz", 0.4), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0.4), ("abcdefghijklmABCDEFGHIJKLMnopqrstuvwxyzNOPQRSTUVWXYZ", 0.9),
    ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_/", 0.85), ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", 0.9)])
def test_random_keys_of_every_class_are_found(alphabet, least):
    """Share of random keys of 20 characters, which is as short as a candidate can be; longer ones are found more often."""
    dice = random.Random(6)
    share = lambda n: np.mean([bool(secrets.entropy_spans("".join(dice.choices(alphabet, k=n)), secrets.Rules())) for _ in range(400)])
    assert share(20) > least and share(40) > least


def test_words_are_not_keys():
    for text in ("Rechtsschutzversicherungsgesellschaften", "getElementsByClassNameOrIdentifier", "the-quick-brown-fox-jumps-over", "SOME_LONG_CONSTANT_NAME_2", "docs/guide/Getting-Started/index", "keitstlichschenverpf", "z" * 60, "-" * 40):
        assert secrets.all_spans(text, secrets.Rules()) == [], text


def test_allow_list():
    key = "q9ZxT3vLk8Wm2RbY7cHd"
    kinds = lambda text, **r: [s[2] for s in secrets.all_spans(text, secrets.Rules(**r))]
    assert kinds(f"see {key} now") == ["entropy"]
    assert kinds(f"https://example.org/{key}") == [] == kinds("8f14e45f-ceea-467f-a0e6-1c3b5d7f9a2b")
    assert kinds(f"see {key} now", allowed=(key,)) == [] == kinds("Donaudampfschifffahrtsgesellschaft")


# ---- 5 ----------------------------------------------------------------------------------


def test_near_duplicates(spark, docs, no_docs, odd, folder):
    names = ("doc_id", "fingerprint", "component_id")
    assert rows(simhash.near_duplicates(docs), *names) == sorted(brute.near_duplicates([(r[0], r[1]) for r in odd]), key=repr)
    assert rows(queries.simhash_near_duplicates(spark, folder), *names) == sorted(brute.near_duplicates(given(spark, folder)), key=repr)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_component_stays(docs, odd, no_docs):
    kept = simhash.drop_near_duplicates(docs)
    found = brute.near_duplicates([(r[0], r[1]) for r in odd])
    assert kept.columns == docs.columns and simhash.drop_near_duplicates(no_docs).count() == 0
    assert rows(kept, "doc_id") == sorted(((c,) for c in {c for _, _, c in found if c is not None}), key=repr) + [(None,)] * len({f for _, f, c in found if c is None})


def test_anchors_cover_three_bits():
    dice = random.Random(1)
    for _ in range(300):
        a = dice.getrandbits(64)
        b = a
        for bit in dice.sample(range(64), 3):
            b ^= 1 << bit
        met = False
        for half in (0, 1):
            reach = [{int(k[0]): home for at, k, home in simhash.anchors(np.array([x >> 32 * half & (1 << 31) - 1])) if len(at)} for x in (a, b)]
            assert all(len(r) <= 16 and sum(r.values()) == 1 for r in reach)
            met |= any(home and anchor in reach[1] for anchor, home in reach[0].items())
        assert met


def test_hot_anchors_are_compared_in_blocks(spark, monkeypatch):
    """Many fingerprints at one anchor: the same components whatever the size of a block."""
    monkeypatch.setattr(simhash, "BLOCK", 7)
    dice = random.Random(2)
    prints = {dice.getrandbits(14) << 40 for _ in range(300)}
    classes = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(4)
    found = {r.node: r.root for r in components.components(simhash.links(classes)).collect()}
    parent = {p: p for p in prints}

    def root(p):
        return p if parent[p] == p else root(parent[p])

    for a in prints:
        for b in prints:
            if 0 < (a ^ b).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {p: root(p) for p in prints} == {p: found.get(p, p) for p in prints}


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {5000: 5000, 5001: 5000}


# ---- 6 ----------------------------------------------------------------------------------


def test_substrings(spark, docs, no_docs, odd, folder):
    names = ("doc_id", "n_words", "n_removed", "kept_text")
    assert rows(substring_dedup.repeated_substrings(docs), *names) == sorted(brute.substrings([(r[0], r[1]) for r in odd]), key=repr)
    want = [(d, n, gone, brute.sha(kept)) for d, n, gone, kept in brute.substrings(given(spark, folder))]
    assert rows(queries.substring_dedup_words(spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)
    assert substring_dedup.repeated_substrings(no_docs).count() == 0


@pytest.mark.parametrize("piece", [1, 300, 1 << 24])
def test_substrings_of_few_words_in_batches_of_any_size(spark, monkeypatch, piece):
    """Texts of two words, where nearly every window repeats, also within the text and across batches."""
    monkeypatch.setattr(substring_dedup, "PIECE", piece)
    dice = random.Random(4)
    texts = [(i % 17, " ".join(dice.choices("ab", k=dice.choice([5, 25, 60]), weights=[9, 1]))) for i in range(60)]
    found = substring_dedup.repeated_substrings(spark.createDataFrame(texts, "doc_id long, text string").repartition(3))
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_text") == sorted(brute.substrings(texts), key=repr)


def test_the_cover_meets_at_every_difference():
    cover = substring_dedup.COVER
    assert {(a - b) % substring_dedup.PERIOD for a in cover for b in cover} == set(range(substring_dedup.PERIOD))


# ---- 7 ----------------------------------------------------------------------------------

HITS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256")


def digests(found):
    return sorted(((d, n, hit, k, brute.sha(items)) for d, n, hit, k, items in found), key=repr)


def test_benchmark_hits(spark, docs, no_docs, odd, folder, monkeypatch):
    texts = [(r[0], r[1]) for r in odd]
    items = [(1, odd[7][1]), (2, odd[7][1].upper()), (3, "The  of"), (None, "x"), (4, None), (5, "..."), (6, " ".join(odd[4][1].split()[100:130])), (10, "a-b")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = digests(brute.benchmark_hits(texts, items))
    assert rows(decontamination.mark(docs, benchmark), *HITS) == want
    assert rows(queries.benchmark_hits(spark, folder), *HITS) == digests(brute.benchmark_hits(given(spark, folder), given(spark, folder, "benchmark")))
    assert decontamination.mark(no_docs, benchmark).count() == 0
    assert decontamination.mark(docs, benchmark.limit(0)).where("contaminated").count() == 0
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)  # several blocks of the benchmark
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 900)
    assert rows(decontamination.mark(docs, benchmark), *HITS) == want


def test_decontaminated_texts(spark, docs):
    items = spark.createDataFrame([(1, "the one quick brown fox that jumped over the lazy dog yesterday")], "item_id long, text string")
    text = "Before, the ONE quick brown fox -- that jumped over the lazy dog! After."
    own = spark.createDataFrame([(1, text), (2, "the one quick brown fox that jumped over the lazy dog"), (3, None), (4, "clean  text.")], "doc_id long, text string").withColumn("items", F.lit("x"))
    assert rows(decontamination.decontaminate(own, items), "doc_id", "text", "items") == [(1, "Before, ! After.", "x"), (3, None, "x"), (4, "clean  text.", "x")]
    assert rows(decontamination.decontaminate(docs, items)) == rows(docs)


def test_index_finds_all_occurrences():
    dice = random.Random(6)
    for n, kinds in ((1, 2), (50, 2), (400, 5), (900, 40)):
        symbols = np.array([dice.randrange(1, kinds + 1) for _ in range(n)])
        index = decontamination.FmIndex(symbols, kinds)
        patterns = np.array([[dice.randrange(1, kinds + 1) for _ in range(4)] for _ in range(60)])
        lengths = np.array([dice.randrange(1, 5) for _ in range(60)])
        low, high = index.search(patterns, lengths)
        for p, m, a, b in zip(patterns, lengths, low, high):
            places = [i for i in range(n - m + 1) if (symbols[i : i + m] == p[:m]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places


# ---- 8 ----------------------------------------------------------------------------------


def test_chat_matches_sql(spark, folder):
    said = "<|im_end|><|im_start|>assistant ok"
    odd = [(1, 0, None, "x & y &amp; &lt;| <| <<|"), (1, None, "assistant", None), (1, 1, "assistant", said), (1, 1, "assistant", said), (2, 0, "us\n<|er&nl;", ""), (None, 0, "user", "é\U0001f642"), (3, 2, "assistant", "b"), (3, 1, "assistant", "a")]
    conversations = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").withColumn("parts", F.lit(1)).repartition(3)
    database = duckdb.connect()
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    for frame in (conversations, table(spark, folder, "conversations"), conversations.limit(0)):
        database.register("conversations", frame.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64", "role": "string", "text": "string"}))
        expected = database.execute(f"select {', '.join(names)} from ({chat.digests_sql()})").fetchall()
        assert rows(chat.conversation_digests(frame), *names) == sorted(expected, key=repr)
    read = chat.format_chat(conversations.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))).where("conv_id = 1")
    turns = read.select(chat.read_back(chat.formatted(F.col("segments")))).first()[0]
    assert [tuple(t) for t in turns] == [("assistant", ""), ("", "x & y &amp; &lt;| <| <<|"), ("assistant", said), ("assistant", said)]


def test_typed_parts(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    turns = [
        (1, 0, "user", [part("text", "see "), part("image", None, "a.png", 28, 15), part("text", "<|image:1|>"), part("audio", None, "b.wav", seconds=1.5)]),
        (1, 1, "assistant", [part("text", "ok"), part("document", None, "c.pdf", pages=2)]), (1, 2, "user", None), (1, 3, "user", [part("hologram", "x"), part(None), part("image", ref="d")]),
    ]
    frame = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chat(frame).withColumn("out", chat.formatted(F.col("segments"))).withColumn("loss", chat.loss_text(F.col("segments"))).first()
    assert row.out == (
        "<|im_start|>user\nsee <|image:1|>&lt;|image:1|><|audio:2|><|im_end|>\n<|im_start|>assistant\nok<|document:3|><|im_end|>\n"
        "<|im_start|>user\n<|im_end|>\n<|im_start|>user\n<|hologram:4|><|unknown:5|><|image:6|><|im_end|>\n"
    )
    assert row.loss == "ok<|document:3|>" and row.n_turns == 4
    assert [tuple(a) for a in row.attachments] == [
        (1, "<|image:1|>", "image", "a.png", 4), (2, "<|audio:2|>", "audio", "b.wav", 38), (3, "<|document:3|>", "document", "c.pdf", 1200),
        (4, "<|hologram:4|>", "hologram", None, 0), (5, "<|unknown:5|>", "unknown", None, 0), (6, "<|image:6|>", "image", "d", 0),
    ]
    assert row.n_expanded_tokens == 1242


# ---- 9 ----------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark, folder):
    found = queries.language_id(spark, folder).join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert held[0] > 0.95 and held[1] > 20
    assert found.count() == table(spark, folder, "documents").count() and not found.where("score < 0 or score > 1").count()


def test_language_of_odd_rows(docs, no_docs, odd):
    found = {r.doc_id: r.lang_pred for r in langid.language_verdicts(docs).collect()}
    assert len(found) == len({r[0] for r in odd})
    assert found[1] == found[2] == found[3] == found[14] == "und" and found[13] in ("ja", "en", "de", "fr")
    assert langid.language_verdicts(no_docs).count() == 0
    assert {r.lang_pred for r in langid.language_verdicts(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.parametrize("cells", [1 << 24, 3000, 1])
def test_every_language_is_learned(spark, monkeypatch, cells):
    """257 languages of like frequency, whatever the number of tables they share."""
    monkeypatch.setattr(langid, "CELLS", cells)
    dice, letters = random.Random(9), [chr(c) for c in range(0x3B1, 0x3C9)]
    names = [f"l{i:03d}" for i in range(257)]
    own = {name: ["".join(dice.choices(letters, k=4)) for _ in range(3)] for name in names}
    texts = [(i * len(names) + k, " ".join(dice.choices(own[name], k=12)), name) for i in range(3) for k, name in enumerate(names)]
    model = langid.learn(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    assert model.languages == names and (len(model.tables) == 1) == (cells == 1 << 24) and (len(model.tables) == 257) == (cells == 1)
    found = model.predict([t for _, t, _ in texts])["lang_pred"]
    assert np.mean([f == lang for f, (_, _, lang) in zip(found, texts)]) > 0.99


def test_code_length_by_escapes():
    """Costs from the table against a direct walk down the contexts."""
    texts = {"x": "abcabcabd", "y": "bbbbacab"}
    counted = {}
    for lang, text in enumerate(texts.values()):
        codes = langid.symbols_of(text).astype(int).tolist()
        for i in range(3, len(codes)):
            key = (lang, codes[i - 3] << 24 | codes[i - 2] << 16 | codes[i - 1] << 8 | codes[i])
            counted[key] = counted.get(key, 0) + 1
    model = langid.build(list(texts), *(np.array(c) for c in zip(*[(lang, g, n) for (lang, g), n in counted.items()])))

    def cost(lang, context, byte):
        seen = {}
        for (own, gram), n in counted.items():
            bytes_ = [gram >> s & 255 for s in (24, 16, 8, 0)]
            if own == lang and bytes_[3 - len(context) : 3] == context:
                seen[bytes_[3]] = seen.get(bytes_[3], 0) + n
        shorter = (lambda: cost(lang, context[1:], byte)) if context else (lambda: 8.0)
        total = sum(seen.values())
        if not total:
            return shorter()
        return -np.log2(seen[byte] / (total + len(seen))) if byte in seen else -np.log2(len(seen) / (total + len(seen))) + shorter()

    for text in ("abcd", "bbab", "cab abd"):
        codes = langid.symbols_of(text).astype(int).tolist()
        codes = [c if c in b"abcd" else 0 for c in codes]
        want = [sum(cost(lang, codes[i - 3 : i], codes[i]) for i in range(3, len(codes))) for lang in (0, 1)]
        assert np.allclose(model.lengths([text])[0], want, rtol=1e-5)


# ---- 10 ---------------------------------------------------------------------------------


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    tail = rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_url_rules(spark, folder):
    urls = [None, "", "no scheme", "http://", "http://ORG/", "https://a.Example.org/en/12?x#y", "x://example.org/es/a", "a://notexample.org/es/", "http://b.com/de/", "http://b.com/fr/#", "http://com?x=/de/", "ftp://é.COM:8/de/\nz", "http://a://b/c", "http://cheap-pills.example.net/x", "http://cheappills.example.net/x"]
    odd = spark.createDataFrame([(i // 2, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({"html": F.lit(None).cast("string"), "tokens": F.lit(1), "rule": F.lit("r")})
    for frame in (odd, table(spark, folder, "pages")):
        found = url_filter.url_verdicts(frame)
        want = [(r.page_id, *plain_rule(r.url)[:3]) for r in frame.collect()]
        assert rows(found, "page_id", "host", "path", "rule") == sorted(want, key=repr)
        verdicts = {r[1] + r[2]: plain_rule(f"http://{r[1]}{r[2]}")[3] for r in want}
        assert all(r.verdict == (verdicts[r.host + r.path] or r.verdict) and r.verdict in ("allow", "block") for r in found.collect())
    assert {r.verdict for r in url_filter.url_verdicts(odd).where("host like 'cheap%pills%'").collect()} == {"block"}
    assert url_filter.url_verdicts(odd.limit(0)).count() == 0


def test_url_rules_have_the_verdicts_of_the_contract(spark):
    """The contract's list as it stands there: each rule's word, on its host and a subdomain, and the longer rule before the shorter."""
    ruled = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    urls = {
        "http://a.org/": "org/", "http://example.org/es": "org/", "http://example.org/en/2": "org/", "http://notexample.org/en/1": "org/", "http://org/en/1": "org/",
        "http://example.org/es/": "example.org/es/", "http://m.Example.org/es/1?x": "example.org/es/",
        "http://example.org/en/1": "example.org/en/1", "https://M.example.ORG/en/12#x": "example.org/en/1", "http://example.org/en/1/es/": "example.org/en/1",
        "http://com/fr/": "com/fr/", "http://b.com/fr/de/": "com/fr/", "http://com/de/x": "com/de/", "http://b.com/de/": "com/de/",
    }
    frame = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = rows(url_filter.url_verdicts(frame), "page_id", "rule", "verdict")
    assert found == sorted(((i, r, ruled[r]) for i, r in enumerate(urls.values())), key=repr)
    assert {h + p: v for h, p, v in url_filter.RULES} == ruled


def plain_split(name, counts):
    """All words of least total cost, tried one by one."""
    total = sum(counts.values())
    best = [(0.0, [])]
    for end in range(1, len(name) + 1):
        tries = [(best[end - 1][0] + math.log(total) + 5, best[end - 1][1] + [(end - 1, end, False)])]
        tries += [(best[a][0] + math.log(total / counts[name[a:end]]), best[a][1] + [(a, end, True)]) for a in range(max(0, end - url_filter.LONGEST), end) if name[a:end] in counts]
        best.append(min(tries, key=lambda x: x[0]))
    words = []
    for a, b, known in best[-1][1]:
        if words and not known and not words[-1][1]:
            words[-1] = (words[-1][0] + name[a:b], False)
        else:
            words.append((name[a:b], known))
    return [w for w, _ in words]


def plain_verdicts(rows):
    """url -> (blocked, score) of (url, html) rows: dictionary, splits and Bayes over positive and unlabelled addresses."""
    counts = Counter()
    for _, html in rows:
        counts.update(w for w in re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>|&\w+;", " ", html or "").lower()) if 2 <= len(w) <= url_filter.LONGEST)
    seed = max(1, sum(counts.values()) // 10_000)
    for w in url_filter.BLOCK_FORMS:
        counts[w] = max(seed, counts[w])
    tokens = {}
    for url, _ in rows:
        host, path, _, _ = plain_rule(url)
        parts = re.findall(r"[^\W\d_]+|\d+", f"{host} {path}".lower())
        tokens[url] = [t for part in parts for t in (["#"] if part[0].isdigit() else plain_split(part, counts))]
    listed = {u: bool({*t} & {*url_filter.BLOCK_FORMS}) for u, t in tokens.items()}
    block, every = Counter(), Counter()
    for url, _ in rows:
        every.update(tokens[url])
        block.update(tokens[url] * listed[url])
    n, m = sum(block.values()), sum(every.values())
    blocked = sum(listed[u] for u, _ in rows)
    prior = math.log((blocked + 1) / (len(rows) - blocked + 1)) if blocked else -1
    s = url_filter.SMOOTH
    odds = {t: math.log((block[t] + s * c / m) / (n + s)) - math.log((c - block[t] + s * c / m) / (m - n + s)) for t, c in every.items()} if blocked else {}
    return {u: prior + sum(odds.get(x, 0) for x in t) for u, t in tokens.items()}


def test_url_verdicts_equal_a_plain_classifier(spark, folder):
    """Every page's score and verdict; equal addresses with other texts; words only in listed hosts, and hosts of rare names."""
    given_pages = [(r.page_id, r.url, r.html) for r in table(spark, folder, "pages").collect()]
    odd = [(-1, "http://cheappills.example.net/x", None), (-2, "http://cheappills.example.net/x", "<p>cheap words here</p>"), (-3, None, "x"), (-3, "http://", None), (-4, "http://zzqqzz.example.net/en/1", ""), (-5, "https://free-loans.example.net/99", "&amp;")]
    for rows_ in (given_pages, given_pages + odd):
        frame = spark.createDataFrame(rows_, "page_id long, url string, html string").repartition(3)
        plain = plain_verdicts([(u, h) for _, u, h in rows_])
        scores = {plain_rule(u)[:2]: s for u, s in plain.items()}
        for r in url_filter.url_verdicts(frame).collect():
            _, _, rule, ruled = plain_rule(f"http://{r.host}{r.path}")
            score = scores[r.host, r.path]
            assert r.verdict == (ruled or ("block" if score > 0 else "allow")) and (r.block_score is None) == (rule is not None)
            assert rule is not None or abs(r.block_score - score) < 1e-4
            bad = any(w in r.host for w in ("casino", "pills", "bets", "adult", "spam", "loans"))
            assert rule is not None or (r.verdict == "block") == bad


def test_url_tables_have_no_bound(spark):
    """More different words than any table of the operator could be expected to hold at once: all of them count."""
    letters = "abcdefghij"
    name = lambda i: "".join(letters[int(d)] for d in f"{i:05d}")
    rows_ = [(i, f"http://{name(i)}{name(i + 1)}.example.net/", f"<p>{name(i)} {name(i + 1)} {'q' * 60}</p>") for i in range(0, 60000, 2)]
    frame = spark.createDataFrame(rows_, "page_id long, url string, html string").repartition(8)
    words, _ = url_filter.dictionary(frame)
    assert words.count() == 60000 + len(url_filter.BLOCK_FORMS)
    runs = frame.select(F.regexp_extract("url", "//([a-z]+)", 1).alias("run"))
    assert url_filter.splits(runs, words, 10**6).where("size(tokens) = 2").count() == 30000


def test_segments(spark):
    words = spark.createDataFrame([("the", 900), ("cat", 50), ("sat", 60), ("thecat", 1), ("cheap", 1), ("spam", 1)], "word string, n long")
    runs = ["thecatsat", "zzcatq", "cheapspam", "x", "thé"]
    found = {r.run: r.tokens for r in url_filter.splits(spark.createDataFrame([(r,) for r in runs], "run string"), words, 1013).collect()}
    assert found == {"thecatsat": ["the", "cat", "sat"], "zzcatq": ["zz", "cat", "q"], "cheapspam": ["cheap", "spam"], "x": ["x"], "thé": ["thé"]}
    counts = {r.word: r.n for r in words.collect()}
    assert all(plain_split(r, counts) == t for r, t in found.items())


def test_every_code_point_is_classified_as_the_library_does():
    from tokenizers import pre_tokenizers

    split, find = pre_tokenizers.ByteLevel(add_prefix_space=False), bpe.pre_token_pattern().findall
    for start in range(0, 0x110000, 0x400):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}\n" for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000)
        assert [b - a for _, (a, b) in split.pre_tokenize_str(text)] == [len(t) for t in find(text)]
