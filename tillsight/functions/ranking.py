"""Exact order statistics without pulling a whole table into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.sources.session import shared_folder

BUCKETS = 5
ROW_BITS = 33  # monotonically_increasing_id keeps the row number within a partition in its low 33 bits


def quintile_last_rank(bucket: int, n: str) -> str:
    """Last rank in a bucket when ranks 1..n are cut at equal quantiles; one row alone is bucket 1. In SQL, as n is."""
    return f"(1 + ({bucket} * ({n} - 1)) div {BUCKETS})"


def ntile_last_rank(bucket: int, n: str) -> str:
    """Last rank in a bucket of NTILE, which gives the larger buckets to the lowest ranks. In SQL, as n is."""
    return f"({bucket} * ({n} div {BUCKETS}) + least({bucket}, {n} % {BUCKETS}))"


ACCURACY = 10_000  # of the sketches: a quantile is off by at most one row in so many
MARGIN = 5 / ACCURACY  # share of the rows that is looked at on either side of an edge


def _placed(rows: DataFrame, id_column: str) -> DataFrame:
    """rows with ``place``, a number from 0 to 1 that never falls as the id rises."""
    if rows.schema[id_column].dataType.typeName() != "string":
        number = F.col(id_column).cast("double")
        return rows.withColumn("place", 0.5 + F.signum(number) * F.log2(F.abs(number) + 1) / 128)
    # The first six bytes after what all ids begin with.
    ends = rows.agg(F.struct(F.min(id_column).alias("least"), F.max(id_column).alias("most"))).scalar()
    first = lambda end, i: F.col(f"ends.{end}").substr(F.lit(1), i)
    alike = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("ends.least"))), lambda i: first("least", i) == first("most", i)))
    rest = F.hex(F.encode(F.col(id_column).substr(F.col("alike") + 1, F.lit(6)), "UTF-8"))
    return rows.withColumn("ends", ends).withColumn("alike", alike).withColumn("place", F.conv(F.rpad(rest, 12, "0"), 16, 10).cast("double") / 2.0**48)


def bucket_edges(rows: DataFrame, id_column: str, metrics: list[str], last_rank: Callable[[int, str], str]) -> Column:
    """A one-row subquery: for each bigint metric, the (value, id) of the last row in buckets 1 to 4.

    Rows are ranked by (value, id), a null value first, without being sorted. Value and place of the id together
    give a number; a mergeable quantile sketch of it brackets every edge by two numbers with a sure margin. Rows
    below a bracket are only counted, where they are. Rows in a bracket, one in a thousand beside those of equal
    numbers, are ranked exactly by their value and id. Fewer than ACCURACY rows are all in every bracket.
    Fields of the result: ``m0e1`` is edge 1 of metric 0; null without rows.
    """
    # Every reader takes all metrics and the id from the rows, so that they can share one shuffle of them.
    # Expressions are SQL text: hundreds of small column objects would cost more than the query.
    positions, edges = range(len(metrics)), range(1, BUCKETS)
    placed = _placed(rows.selectExpr(f"{id_column} AS id", *[f"{_ranked(m)} AS v{i}" for i, m in enumerate(metrics)]), "id")
    own = placed.selectExpr("id", *[f"v{i}" for i in positions], *[f"CAST(v{i} AS DOUBLE) + place AS x{i}" for i in positions])
    shares = ", ".join(f"{b / BUCKETS + side * MARGIN:.6f}D" for b in edges for side in (-1, 1))
    quantiles = ", ".join(f"'q{i}', percentile_approx(x{i}, array({shares}), {ACCURACY})" for i in positions)
    sketches = own.selectExpr(f"named_struct('n', count(1), {quantiles})").scalar()
    sides = ", ".join(
        f"named_struct('metric', {i}, 'edge', {b}, 'v', v{i}, 'below', sketches.n >= {ACCURACY} AND x{i} < get(sketches.q{i}, {2 * b - 2}), "
        f"'above', sketches.n >= {ACCURACY} AND x{i} > get(sketches.q{i}, {2 * b - 1}))" for i in positions for b in edges)
    near = own.withColumn("sketches", sketches).selectExpr("id", "sketches.n AS rows", f"inline(array({sides}))").filter("NOT above")
    counted = near.selectExpr("metric", "edge", "rows", "below", "CASE WHEN NOT below THEN v END AS v", "CASE WHEN NOT below THEN id END AS id") \
        .groupBy("metric", "edge", "rows", "below", "v", "id").agg(F.count(F.lit(1)).alias("n"))
    upto = "sum(n) OVER (PARTITION BY metric, edge ORDER BY below DESC, v, id ROWS UNBOUNDED PRECEDING) AS upto"
    rank = "CASE edge " + " ".join(f"WHEN {b} THEN {last_rank(b, 'rows')}" for b in edges) + " END"
    met = counted.selectExpr("*", upto).filter(f"upto >= {rank} AND upto - n < {rank}")
    fields = ", ".join(f"'m{i}e{b}', max(CASE WHEN metric = {i} AND edge = {b} THEN named_struct('v', v, 'id', id) END)" for i in positions for b in edges)
    found = met.selectExpr(f"named_struct({fields}) AS edges", f"max(below) OR count(1) < {len(metrics) * (BUCKETS - 1)} AND count(1) > 0 AS missed")
    return found.selectExpr("CASE WHEN missed THEN raise_error('a rank lies outside its bracket') ELSE edges END AS edges").scalar()


def _ranked(metric: str) -> str:
    return f"coalesce(CAST({metric} AS BIGINT), -9223372036854775808)"


def bucket_of(metric: int, value: str, id_column: str, edges: str) -> Column:
    """Bucket 1..5 of a row: one more than the number of edges its (value, id) lies beyond.

    ``metric`` is the position of the column ``value`` in what :func:`bucket_edges` was given, ``edges`` the
    column that holds its result.
    """
    own = _ranked(value)
    beyond = [f"CASE WHEN {own} > {edge}.v OR ({own} = {edge}.v AND {id_column} > {edge}.id) THEN 1 ELSE 0 END" for edge in (f"{edges}.m{metric}e{e}" for e in range(1, BUCKETS))]
    return F.expr(" + ".join(["1", *beyond]))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows 1..n in the order of ``order``, whose values must be unique, without a single-task sort.

    A range sort places the rows, a checkpoint fixes them where they are, and
    only the partition sizes are summed.
    """
    shared_folder(rows.sparkSession)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("position", F.monotonically_increasing_id()).checkpoint() \
        .withColumn("part", F.shiftright("position", ROW_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size")) \
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.col("position").bitwiseAND(2**ROW_BITS - 1) + 1
    return placed.join(F.broadcast(starts), "part").select(*rows.columns, number.alias(name))


DIGIT_BITS = 21  # three digits cover a bigint


def exact_median(values: DataFrame, column: str) -> Column:
    """Median of a bigint column as a scalar, half a unit rounded up; nulls are ignored.

    Values are counted first, with map-side combine, so a value held by a third
    of all rows is one row afterwards. The running count is then put together
    from three levels of 21-bit digits: no window sorts more than 2**21 rows,
    however many values there are.
    """
    # Nulls join the group of 0 with a count of nothing. A null filter would be pushed into the caller's
    # plan and keep Spark from reusing its shuffle here.
    counts = values.groupBy(F.coalesce(F.col(column).cast("bigint"), F.lit(0)).alias("v")) \
        .agg(F.count(column).alias("n")) \
        .select("v", "n", F.shiftright("v", 2 * DIGIT_BITS).alias("high"), F.shiftright("v", DIGIT_BITS).alias("middle"))

    def running(rows: DataFrame, within: list[str], digit: str, before: str) -> DataFrame:
        window = Window.partitionBy(*within).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(before, F.coalesce(F.sum("n").over(window), F.lit(0)))

    middles = counts.groupBy("high", "middle").agg(F.sum("n").alias("n"))
    highs = middles.groupBy("high").agg(F.sum("n").alias("n")) \
        .withColumn("total", F.sum("n").over(Window.partitionBy()))
    placed = running(counts, ["middle"], "v", "in_middle") \
        .join(running(middles, ["high"], "middle", "in_high").select("middle", "in_high"), "middle") \
        .join(running(highs, [], "high", "in_all").select("high", "in_all", "total"), "high")
    upto = F.col("in_all") + F.col("in_high") + F.col("in_middle") + F.col("n")
    lower_rank, upper_rank = F.shiftright(F.col("total") + 1, 1), F.shiftright("total", 1) + 1
    ends = placed.agg(
        F.min(F.when(upto >= lower_rank, F.col("v"))).alias("lower"),
        F.min(F.when(upto >= upper_rank, F.col("v"))).alias("upper"))
    return ends.select(F.shiftright(F.col("lower") + F.col("upper") + 1, 1)).scalar()
