"""Recency, frequency and monetary scoring of customers and their segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.money import money, pct, pct2, ratio, rounded, wide_sum
from tillsight.functions.ranking import bucket_edges, bucket_of, ntile_last_rank, quintile_last_rank
from tillsight.sources.star import Star

# Segment labels in their report order.
VIP = "VIP"
FREQUENT = "Clientes frecuentes"
NEW = "Nuevos clientes"
AT_RISK = "Clientes en riesgo"
INACTIVE = "Clientes inactivos"
SEGMENTS = (VIP, FREQUENT, NEW, AT_RISK, INACTIVE)

ATTRIBUTES = ("customer_segment", "city", "region", "acquisition_date", "acquisition_channel")
# The columns of the segment export.
EXPORT_COLUMNS = (
    "customer_id", "segment", "has_purchase", "recency_days", "frequency", "monetary", "r_score", "f_score",
    "m_score", "rfm_score", "rfm_cell", "last_order_date", *ATTRIBUTES,
)


def segment() -> Column:
    """Segment of a scored customer; the first rule that holds decides."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((m >= 4) & (f >= 4) & (r >= 3), VIP)
        .when(at_risk(), AT_RISK)
        .when(r <= 2, INACTIVE)
        .when(f <= 2, NEW)
        .otherwise(FREQUENT)
    )


def at_risk() -> Column:
    """Valuable customers who stopped buying. Nobody in it can be VIP, which needs r >= 3."""
    return (F.col("r_score") <= 2) & ((F.col("f_score") >= 3) | (F.col("m_score") >= 4))


def _customers(star: Star) -> DataFrame:
    """Last order date, distinct orders and net revenue in cents per customer, null customer included.

    ``lines`` is zero for the null customer alone.
    """
    orders = star.table("order_grain") if star.has("order_grain") else star.sales("customer_id", "order_id", "order_date", "monetary")
    per_order = orders.groupBy("customer_id", "order_id").agg(
        F.count("customer_id").alias("lines"), F.max("order_date").alias("order_date"), F.sum("monetary").alias("monetary"))
    return per_order.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("monetary").alias("monetary"),
        F.sum("lines").alias("lines"),
    )


def _latest(customers: DataFrame) -> Column:
    return customers.agg(F.max(F.struct("last_order_date", "frequency", "monetary", "lines"))["last_order_date"]).scalar()


def _with_recency(customers: DataFrame) -> DataFrame:
    """Customers but the null one, with the last date of all.

    The date is the maximum of whole rows, and the null customer goes by its number of lines: every reader then
    needs the same columns and filters of the customers, and Spark shuffles them once for all.
    """
    return customers.filter("lines > 0").withColumn("analysis_date", _latest(customers)) \
        .withColumn("recency_days", F.datediff("analysis_date", "last_order_date"))


def rfm_base(star: Star) -> DataFrame:
    """Recency, frequency and monetary value of every buyer."""
    return _with_recency(_customers(star)).select(
        "customer_id", "last_order_date", "frequency", money("monetary").alias("monetary"), "recency_days")


def _scored(star: Star, last_rank: Callable[[int, str], str], recency_key: str) -> DataFrame:
    metrics = ["recency_key", "frequency", "monetary"]
    keyed = _customers(star).withColumn("recency_key", F.expr(recency_key).cast("bigint"))
    edges = bucket_edges(keyed.filter("lines > 0"), "customer_id", metrics, last_rank)
    return _with_recency(keyed).withColumn("edges", edges).withColumns({
        name: bucket_of(i, metric, "customer_id", "edges") for i, (name, metric) in enumerate(zip(("r_bucket", "f_score", "m_score"), metrics))})


def _known(star: Star, scored: DataFrame, *columns: str) -> DataFrame:
    """Scored customers that are in the dimension, with columns of it.

    Keys are compared null-safe: a plain comparison would push a filter on the key below the customers' shuffle
    in this reader alone.
    """
    known = star.dim_customer.select(F.col("customer_id").alias("known"), *columns)
    return scored.join(known, F.col("customer_id").eqNullSafe(F.col("known"))).drop("known")


def quintile_scores(star: Star) -> DataFrame:
    """Buyers with rank-quintile scores, in cents. Few days score high; ties go by customer id,
    so among equal recencies a smaller id scores higher."""
    scored = _scored(star, quintile_last_rank, "-unix_date(last_order_date)")
    return _buyer_columns(scored.withColumn("r_score", 6 - F.col("r_bucket")))


def ntile_scores(star: Star) -> DataFrame:
    """Buyers with NTILE(5) scores, in cents, oldest last order first; ties go by customer id."""
    scored = _scored(star, ntile_last_rank, "unix_date(last_order_date)")
    return _buyer_columns(scored.withColumnRenamed("r_bucket", "r_score"))


def _buyer_columns(scored: DataFrame) -> DataFrame:
    return scored.select("customer_id", "last_order_date", "recency_days", "frequency", "monetary",
                         "r_score", "f_score", "m_score", "analysis_date")


def _cell() -> Column:
    return F.concat(*[F.col(f"{d}_score").cast("string") for d in "rfm"])


def _score_only(scored: DataFrame) -> DataFrame:
    return scored.select("customer_id", "r_score", "f_score", "m_score")


def rfm_quintile(star: Star) -> DataFrame:
    """Rank-quintile scores only."""
    return _score_only(quintile_scores(star))


def rfm_ntile(star: Star) -> DataFrame:
    """NTILE scores only."""
    return _score_only(ntile_scores(star))


def rfm_scores_quintile(star: Star) -> DataFrame:
    """Buyers with rank-quintile scores, the three-digit score and its text form."""
    return quintile_scores(star).select(
        "customer_id", "last_order_date", "frequency", money("monetary").alias("monetary"), "recency_days",
        "r_score", "f_score", "m_score",
        (F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score")).alias("rfm_score"),
        _cell().alias("rfm_cell"),
    )


def all_customers(star: Star) -> DataFrame:
    """Every customer with scores and segment, in cents; non-buyers get the lowest scores.

    One full join does both halves: buyers keep their row even when they are in
    no dimension, and customers that match no buyer are the non-buyers.
    """
    buyers = quintile_scores(star).withColumn("has_purchase", F.lit(1))
    analysis_date = _latest(_customers(star))
    joined = buyers.drop("analysis_date").join(star.dim_customer.select("customer_id", *ATTRIBUTES),
                                               "customer_id", "full")
    joined = joined.withColumns({
        "segment": F.when(F.col("has_purchase") == 1, segment()).otherwise(INACTIVE),
        "has_purchase": F.coalesce("has_purchase", F.lit(0)),
        "recency_days": F.coalesce("recency_days", F.datediff(analysis_date, "acquisition_date")),
        "frequency": F.coalesce("frequency", F.lit(0)),
        "monetary": F.coalesce("monetary", F.lit(0)),
        **{f"{d}_score": F.coalesce(f"{d}_score", F.lit(1)) for d in "rfm"},
    })
    return joined.withColumns({
        "rfm_score": F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score"), "rfm_cell": _cell()})


def with_segments(star: Star) -> Star:
    """The star with each customer's segment as a dimension of its sales."""
    segments = all_customers(star).select("customer_id", "segment")
    return star.with_tables(customer_rfm=lambda: segments)


def rfm_all_customers(star: Star) -> DataFrame:
    """One row per customer: scores, segment and attributes."""
    return all_customers(star).withColumn("monetary", money("monetary")).select(*EXPORT_COLUMNS)


def rfm_scores_ntile(star: Star) -> DataFrame:
    """Buyers known to the customer dimension with NTILE scores, attributes and segment."""
    scored = _known(star, ntile_scores(star), "customer_segment", "region")
    return scored.select(
        "customer_id", "customer_segment", "region", "recency_days", "frequency",
        money("monetary").alias("monetary"), "r_score", "f_score", "m_score",
        _cell().alias("rfm_cell"), segment().alias("rfm_segment"),
    ).orderBy(F.desc("m_score"), F.desc("f_score"), F.desc("r_score"), "customer_id")


def customers_at_risk(star: Star) -> DataFrame:
    """Valuable customers with low recency scores, by value."""
    scored = _known(star, ntile_scores(star).filter(at_risk()), "customer_segment", "region")
    return scored.select(
        "customer_id", "customer_segment", "region", "recency_days", "frequency",
        money("monetary").alias("monetary"), "r_score", "f_score", "m_score",
    ).orderBy(F.desc("monetary"), "customer_id")


def segment_totals(customers: DataFrame, label: str) -> DataFrame:
    """Customers and sums per segment, with totals over all segments."""
    everything = Window.partitionBy()  # at most five rows
    per_segment = customers.groupBy(label).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("recency_days").alias("recency"),
        F.sum("frequency").alias("orders"),
        wide_sum("monetary").alias("monetary"),
    )
    return per_segment.withColumns({
        "all_customers": F.sum("customers").over(everything), "all_monetary": F.sum("monetary").over(everything)})


def rfm_segment_summary(star: Star) -> DataFrame:
    """Buyers per segment (NTILE scores) with rounded averages and share of customers."""
    return segment_totals(ntile_scores(star).withColumn("rfm_segment", segment()), "rfm_segment").select(
        "rfm_segment", "customers",
        rounded("recency", "customers", 10, 1).alias("avg_recency_days"),
        rounded("orders", "customers", 100, 2).alias("avg_frequency"),
        money("monetary").alias("total_monetary"),
        rounded("monetary", "customers", 1, 2).alias("avg_monetary"),
        pct2("customers", "all_customers").alias("pct_of_customers"),
    ).orderBy(F.desc("total_monetary"))


def segment_share(star: Star) -> DataFrame:
    """Share of buyers per segment (NTILE scores)."""
    return segment_totals(ntile_scores(star).withColumn("rfm_segment", segment()), "rfm_segment").select(
        "rfm_segment", "customers", pct2("customers", "all_customers").alias("pct_of_customers"))


def rfm_segment_summary_all(star: Star) -> DataFrame:
    """All customers per segment (quintile scores), unrounded."""
    return segment_totals(all_customers(star), "segment").select(
        "segment", "customers", money("monetary").alias("total_monetary"),
        ratio("recency", "customers").alias("avg_recency"),
    ).orderBy(F.desc("total_monetary"))


def rfm_distribution(star: Star) -> DataFrame:
    """All customers per segment with averages and shares, in report order."""
    position = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("segment"))
    return segment_totals(all_customers(star), "segment").orderBy(position).select(
        "segment", "customers",
        ratio("recency", "customers").alias("avg_recency"),
        ratio("orders", "customers").alias("avg_frequency"),
        money("monetary").alias("total_monetary"),
        ratio("monetary", "customers * 100").alias("avg_monetary"),
        pct("customers", "all_customers").alias("pct_customers"),
        pct("monetary", "all_monetary").alias("pct_value"),
    )


def rfm_score_bounds(star: Star) -> DataFrame:
    """Smallest and largest value of each metric within each score (buyers, quintile scores)."""
    metrics = (("recency_days", "r_score", F.col("recency_days").cast("double")),
               ("frequency", "f_score", F.col("frequency").cast("double")),
               ("monetary", "m_score", money("monetary")))
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(score).alias("score"), value.alias("value"))
        for name, score, value in metrics
    ])
    return quintile_scores(star).select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.score").agg(
        F.min("p.value").alias("min_value"), F.max("p.value").alias("max_value")).orderBy("metric", "score")
