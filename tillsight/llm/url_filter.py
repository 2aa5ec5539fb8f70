"""Operator 10, URL filters: host word segmentation and multinomial naive Bayes.

Rules decide first: a rule fits its host and all subdomains if the path starts with its path,
and the longest that fits wins. Other addresses are judged by a classifier. Their hosts and
paths are cut at marks, and each run of letters is split into words by Viterbi search over
word frequencies, learned from the pages' own text.

The classifier learns from positive and unlabelled addresses: those with a word of the block
list, in any of its forms, are blocked, and all others, wherever rules put them, stand for what
is allowed. What a rule says about a place is no label, so the classifier does not learn where
rules apply, and words that all addresses have count for neither class. A class's share of a
word is smoothed with SMOOTH words of the shares of all addresses, so that rare names, seen in
no blocked address, do not speak for the smaller class.

No table is bounded or collected: dictionary, splits and word weights stay in Spark. A run meets
only the words that occur in it, by a join of its pieces with the dictionary, and is split where
these are. Addresses are distinct before any of this, with their number of pages.

Defined cases: a null address, or one without "://", has empty host and path; an address with
no token is judged by the classes' shares; without any listed address everything is allowed;
words of more than LONGEST letters are in no dictionary, and a run of them stays whole; repeated
rows are judged alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import map_batches, save

# The rules (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BLOCK_WORDS = ("adult", "bet", "casino", "cheap", "crack", "escort", "farm", "hack", "loan", "malware", "phish", "pill", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx")
ENDINGS = ("", "s", "es", "er", "ers", "ing")
BLOCK_FORMS = tuple(dict.fromkeys(w + e for w in BLOCK_WORDS for e in ENDINGS))
LONGEST = 20  # letters of the longest word of the dictionary
SMOOTH = 100.0
UNIT = 1e-6  # weights are whole numbers of this, so that sums do not depend on their order
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


# ---- segmentation ---------------------------------------------------------------------------


def best_split(run: str, found: dict[int, list[tuple[int, float]]], unknown: float) -> list[str]:
    """The words of least total cost; letters between words stay together.

    found: by end, the begins and costs of the words in the run. unknown: the cost of a letter in none.
    """
    best, back = [0.0], [(0, False)]
    for end in range(1, len(run) + 1):
        price, step = best[end - 1] + unknown, (end - 1, False)
        for begin, cost in found.get(end, ()):
            if best[begin] + cost < price:
                price, step = best[begin] + cost, (begin, True)
        best.append(price)
        back.append(step)
    words, end, loose = [], len(run), ""
    while end:
        begin, known = back[end]
        if known:
            words += [loose] * bool(loose) + [run[begin:end]]
            loose = ""
        else:
            loose = run[begin:end] + loose
        end = begin
    words += [loose] * bool(loose)
    return words[::-1]


def dictionary(pages: DataFrame) -> tuple[DataFrame, int]:
    """(word, n): the words of the pages' text and the forms of listed words, and the sum of n.

    A listed word counts as at least one of ten thousand words.
    """
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^>]*>|&\w+;", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    counted = save(words.where(F.length("word").between(2, LONGEST)).groupBy("word").agg(F.count("*").alias("n")))
    seed = max(1, (counted.agg(F.sum("n")).first()[0] or 0) // 10_000)
    forms = pages.sparkSession.createDataFrame([(w, seed) for w in BLOCK_FORMS], "word string, n long")
    whole = counted.union(forms).groupBy("word").agg(F.max("n").alias("n"))
    return whole, whole.agg(F.sum("n")).first()[0]


def splits(runs: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(run, tokens) for distinct runs of letters."""
    begins = F.explode(F.sequence(F.lit(1), F.length("run"))).alias("begin")
    lengths = F.explode(F.sequence(F.lit(2), F.least(F.lit(LONGEST), F.length("run") - F.col("begin") + 1))).alias("length")
    pieces = runs.where("length(run) > 1").select("run", begins).where("begin < length(run)").select("run", "begin", lengths)
    met = pieces.withColumn("word", F.expr("substring(run, begin, length)")).join(words, "word")
    options = met.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("begin", "length", "n"))).alias("found"))
    unknown = math.log(total) + 5

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for run, options_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: dict[int, list[tuple[int, float]]] = {}
                for o in options_ or ():
                    found.setdefault(o["begin"] - 1 + o["length"], []).append((o["begin"] - 1, math.log(total / o["n"])))
                made.append(best_split(run, found, unknown))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.string()))], names=["run", "tokens"])

    return map_batches(runs.join(options, "run", "left").select("run", "found"), task, "run string, tokens array<string>")


# ---- classification -------------------------------------------------------------------------


def tokenized(pages: DataFrame, addresses: DataFrame) -> DataFrame:
    """addresses (host, path, n) with `tokens`: the words of host and path; numbers are all one token."""
    text = F.lower(F.concat("host", F.lit(" "), "path"))
    parts = addresses.select("*", F.explode_outer(F.regexp_extract_all(text, F.lit(r"(\p{L}+|\p{Nd}+)"), F.lit(1))).alias("run"))
    letters = parts.where(F.col("run").rlike(r"^\p{L}")).select("run").distinct()
    split = save(splits(letters, *dictionary(pages)))
    own = F.when(F.col("run").rlike(r"^\p{Nd}"), F.array(F.lit("#")))
    joined = parts.join(split, "run", "left").withColumn("tokens", F.coalesce("tokens", own))
    return save(joined.groupBy("host", "path", "n").agg(F.flatten(F.collect_list("tokens")).alias("tokens")))


def weights(named: DataFrame) -> tuple[int, DataFrame]:
    """log P(block) / P(allow) of an address, and (t, weight) of each token, in UNIT, from addresses with tokens."""
    listed = F.arrays_overlap("tokens", F.array(*map(F.lit, BLOCK_FORMS)))
    marked = named.select("n", "tokens", F.coalesce(listed, F.lit(False)).alias("listed"))
    blocked, pages = marked.agg(F.sum(F.when(F.col("listed"), F.col("n"))), F.sum("n")).first()
    if not blocked:
        return -round(1 / UNIT), named.select(F.lit("").alias("t"), F.lit(0).cast("long").alias("weight")).limit(0)
    counted = save(marked.select("n", "listed", F.explode("tokens").alias("t")).groupBy("t").agg(F.sum(F.when(F.col("listed"), F.col("n")).otherwise(0)).alias("block"), F.sum("n").alias("n")))
    block, every = counted.agg(F.sum("block"), F.sum("n")).first()
    share = F.col("n") / every
    odds = F.log((F.col("block") + SMOOTH * share) / (block + SMOOTH)) - F.log((F.col("n") - F.col("block") + SMOOTH * share) / (every - block + SMOOTH))
    return round(math.log((blocked + 1) / (pages - blocked + 1)) / UNIT), counted.select("t", F.round(odds / UNIT).cast("long").alias("weight"))


def url_verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, block_score (log odds; null where a rule decides)."""
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    named = tokenized(pages, save(parsed.groupBy("host", "path").agg(F.count("*").alias("n"))))
    prior, odds = weights(named)
    each = named.select("host", "path", F.explode("tokens").alias("t")).join(odds, "t")
    summed = each.groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    scored = save(named.select("host", "path").join(summed, ["host", "path"], "left").select("host", "path", (F.coalesce("weight", F.lit(0)) + prior).alias("weight")))
    judged = F.coalesce("ruled", F.when(F.col("weight") > 0, "block").otherwise("allow"))
    return parsed.join(scored, ["host", "path"]).select("page_id", "host", "path", "rule", judged.alias("verdict"), F.when(F.col("rule").isNull(), F.col("weight") * UNIT).alias("block_score"))
