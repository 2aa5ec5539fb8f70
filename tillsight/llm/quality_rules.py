"""Operator 1, quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets its measures in one narrow pass of built-in functions. Their distribution
in each language and source is a sketch: counts of values in bins whose width is a sixteenth of
the value, so that sketches merge by adding counts, give quantiles within 1/16, and come out
the same after any recomputation. A threshold lies beyond the median by SPREAD times the distance
to the quartile on its side and a small margin of the measure. Quartiles of a source are shrunk to
those of its language as if PRIOR documents of the language were in it, those of a language to
those of all rows, so that small sources have thresholds of their own without being ruled by a
few documents. The documents are then joined with the thresholds.

Defined cases: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; repeated rows are judged alike; an empty table gives an empty
result; a column named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import save, whole, without

SPACES = r"\x20\x09-\x0D"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30  # base rules: words, percent of words in repeated windows
PRIOR = 200
SPREAD = 6
# measure -> (margin above, margin below or None)
MEASURES: dict[str, tuple[int, int | None]] = {
    "word_length": (100, 100),  # hundredths of a character
    "symbol_rate": (60, None),  # per 1000 words
    "dup_line_rate": (400, None),  # per 1000 lines; one of three may be a licence line
    "capital_rate": (40, None),  # per 1000 characters of words
    "repeat_rate": (50, None),  # words equal to one of the two before them, per 1000 words
}
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *MEASURES, "base_failed", "kept")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once a row, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"([^{SPACES}]+)"), F.lit(1))


def repeated_words(ws: Column) -> Column:
    """Words in windows that occur twice or more in the text.

    Hashes tell most texts, which repeat no window; only for the others the windows
    themselves are sorted and neighbours compared.
    """
    last = F.size(ws) - WINDOW
    hashes = let(
        F.transform(ws, lambda w: F.xxhash64(w)),
        lambda h: F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])),
    )
    exact = F.sort_array(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.array_join(F.slice(ws, i + 1, WINDOW), " ").alias("w"), i.alias("i"))))
    same = lambda s, a, b: F.get(s, a)["w"].eqNullSafe(F.get(s, b)["w"])
    starts = let(exact, lambda s: F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: ((j > 0) & same(s, j, j - 1)) | same(s, j, j + 1)),
        lambda j: F.get(s, j)["i"],
    )))
    state = lambda at, n: F.struct(at.cast("int").alias("at"), n.cast("long").alias("n"))
    covered = F.aggregate(starts, state(F.lit(-WINDOW), F.lit(0)), lambda a, x: state(x, a["n"] + F.least(F.lit(WINDOW), x - a["at"])), lambda a: a["n"])
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(last < 1, F.lit(0).cast("long")).when(repeats, covered).otherwise(F.lit(0).cast("long"))


def repeats_nearby(ws: Column) -> Column:
    """Words that equal one of the two words before them."""
    pairs = F.zip_with(ws, F.slice(ws, 2, F.greatest(F.size(ws), F.lit(1))), lambda a, b: a.eqNullSafe(b))
    apart = F.zip_with(ws, F.slice(ws, 3, F.greatest(F.size(ws), F.lit(1))), lambda a, b: a.eqNullSafe(b))
    # Position i of the first says whether word i + 1 equals word i, of the second whether word i + 2 does.
    later = F.zip_with(F.slice(pairs, 2, F.greatest(F.size(ws), F.lit(1))), apart, lambda p, a: F.coalesce(p, F.lit(False)) | F.coalesce(a, F.lit(False)))
    return (F.size(F.filter(later, lambda x: x)) + F.coalesce(F.get(pairs, F.lit(0)), F.lit(False)).cast("int")).cast("long")


def count_of(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with the base counts, the measures and `base_failed`."""
    kept = [F.col(f"`{c}`") for c in (without(docs, RESULTS) if keep is None else keep)]
    value = whole(text)
    counted = let(words(value), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        repeated_words(ws).alias("n_repeat_words"),
        repeats_nearby(ws).alias("repeats"),
    ))
    lines = let(F.filter(F.split(value, "\n"), lambda line: line.rlike(f"[^{SPACES}]")), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("different")))
    raw = docs.select(*kept, counted.alias("__words"), lines.alias("__lines"), count_of(value, r"[#*$%&|<>]").alias("n_symbols"), count_of(value, r"\p{Lu}").alias("__capitals"))
    rate = lambda part, whole_, times: F.coalesce(F.expr(f"({part}) * {times} div nullif({whole_}, 0)"), F.lit(0)).cast("long")
    return raw.select(
        *kept,
        *[F.col(f"__words.{c}").alias(c) for c in ("n_words", "word_chars")], "n_symbols",
        (F.col("__lines.n") - F.col("__lines.different")).cast("long").alias("n_dup_lines"), F.col("__words.n_repeat_words").alias("n_repeat_words"),
        rate("__words.word_chars", "__words.n_words", 100).alias("word_length"), rate("n_symbols", "__words.n_words", 1000).alias("symbol_rate"),
        rate("__lines.n - __lines.different", "__lines.n", 1000).alias("dup_line_rate"), rate("__capitals", "__words.word_chars", 1000).alias("capital_rate"),
        rate("__words.repeats", "__words.n_words", 1000).alias("repeat_rate"),
        F.expr(f"__words.n_words < {LEAST_WORDS} or 100 * __words.n_repeat_words > {MOST_REPEATED} * __words.n_words").alias("base_failed"),
    )


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the sketches of all groups, from documents with a word.

    Documents without one give an empty list. A filter would be pushed down to the scan
    with all of the measures in it, and they would be worked out twice.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])
    each = F.explode(F.when(F.col("n_words") > 0, pairs))
    values = measured.select("lang", "source", each.alias("m")).select("lang", "source", "m.measure", "m.value")
    shift = "(length(bin(value)) - 5)"
    binned = values.withColumn("bin", F.expr(f"case when value < 32 then value else 16 + {shift} * 16 + shiftright(value, cast({shift} as int)) - 16 end").cast("int"))
    return binned.groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Quartiles of the sketches merged to `by` and measure, with their number of rows."""
    merged = sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    value = F.expr("case when bin < 32 then bin else shiftleft(16 + (bin - 32) % 16, 1 + cast((bin - 32) div 16 as int)) end").cast("long")
    ranked = merged.select(*by, "measure", value.alias("value"), F.sum("n").over(group.orderBy("bin")).alias("upto"), F.sum("n").over(group).alias("rows"))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("rows") * q, F.col("value")))
    return ranked.groupBy(*by, "measure").agg(F.max("rows").alias("rows"), at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per language and source: `<measure>_most` and, where it has one, `<measure>_least`."""
    own = quantiles(sketches, ["lang", "source"]).alias("o")
    lang, everything = quantiles(sketches, ["lang"]).alias("l"), quantiles(sketches, []).alias("e")
    joined = (
        own.join(lang, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.measure") == F.col("l.measure")))
        .join(everything, F.col("o.measure") == F.col("e.measure"))
    )
    shrunk = lambda of, c, to: F.expr(f"({of}.rows * {of}.{c} + {PRIOR} * {to}) div ({of}.rows + {PRIOR})")
    quartiles = ("q25", "q50", "q75")
    near = joined.select("o.*", *[shrunk("l", c, f"e.{c}").alias(f"l{c}") for c in quartiles]).alias("o")
    chosen = near.select("lang", "source", "measure", *[shrunk("o", c, f"o.l{c}").alias(c) for c in quartiles])
    columns = []
    for name, (above, below) in MEASURES.items():
        here = F.col("measure") == name
        columns.append(F.max(F.when(here, F.col("q50") + above + SPREAD * (F.col("q75") - F.col("q50")))).alias(f"{name}_most"))
        if below is not None:
            columns.append(F.max(F.when(here, F.col("q50") - below - SPREAD * (F.col("q50") - F.col("q25")))).alias(f"{name}_least"))
    return chosen.groupBy("lang", "source").agg(*columns)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """measured with `kept`: false if a base rule fails or a measure is beyond its group's threshold."""
    limits = limits.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["__lang"]) & measured["source"].eqNullSafe(limits["__source"]), "left")
    tests = []
    for name, (_, below) in MEASURES.items():
        tests.append(F.coalesce(F.col(name) <= F.col(f"{name}_most"), F.lit(True)))
        if below is not None:
            tests.append(F.coalesce(F.col(name) >= F.col(f"{name}_least"), F.lit(True)))
    # One expression over both sides of the join: parts of it would be pushed below and worked out twice.
    within = reduce(lambda a, b: a & b, tests)
    kept = F.when(F.col("base_failed"), False).otherwise(within)
    return joined.select(*[F.col(f"`{c}`") for c in measured.columns], kept.alias("kept"))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, all counts and measures, base_failed, kept."""
    measured = save(measure(docs, keep=["doc_id", "lang", "source"]))
    return judge(measured, save(thresholds(sketch(measured)))).drop("lang", "source")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with their own columns.

    Texts are measured twice, for the sketches and for the verdicts, and never shuffled
    unless the table of thresholds is too large for a broadcast.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), "text", "lang", "source")
    limits = save(thresholds(sketch(measure(docs, keep=["lang", "source"]))))
    judged = judge(measure(named, keep=["__doc", "lang", "source"]), limits)
    return judged.where("kept").select("__doc.*")
