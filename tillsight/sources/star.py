"""The star schema: declared types, CSV and Parquet readers and writers.

Money is integer cents inside the star and currency units in CSV files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tillsight.functions.economics import DERIVED
from tillsight.sources.versions import current

# Types of the six tables; `cents` columns are bigint here and decimals in CSV.
TABLES: dict[str, str] = {
    "dim_date": "date_key int, date date, year int, quarter int, month int, month_name string, "
                "week int, day_of_week string",
    "dim_product": "product_id string, product_name string, category string, subcategory string, "
                   "brand string, unit_cost bigint, list_price bigint, supplier string, active_flag int",
    "dim_customer": "customer_id string, customer_segment string, city string, region string, "
                    "acquisition_date date, acquisition_channel string",
    "dim_channel": "channel_id int, channel_name string, channel_type string",
    "fact_sales": "order_id string, order_date date, customer_id string, product_id string, channel_id int, "
                  "quantity int, unit_price bigint, discount_amount bigint, shipping_revenue bigint, "
                  "product_cost bigint, shipping_cost bigint, payment_fee bigint, returned_flag int, "
                  "refund_amount bigint",
    "fact_marketing": "date date, channel_id int, campaign_name string, impressions bigint, clicks bigint, "
                      "leads bigint, conversions bigint, marketing_spend bigint",
}
COLUMNS: dict[str, dict[str, str]] = {
    name: dict(column.split() for column in ddl.split(", ")) for name, ddl in TABLES.items()
}

CENTS = frozenset({
    "unit_cost", "list_price", "unit_price", "discount_amount", "shipping_revenue", "product_cost",
    "shipping_cost", "payment_fee", "refund_amount", "marketing_spend",
})

# The texts a pandas CSV reader takes for missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Where a sales column outside the fact comes from: dimension -> (its key in the fact, columns).
SALES_DIMENSIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "dim_product": ("product_id", ("product_name", "category", "subcategory", "brand", "active_flag")),
    "dim_customer": ("customer_id", ("customer_segment", "city", "region", "acquisition_channel")),
    "dim_channel": ("channel_id", ("channel_name", "channel_type")),
    "customer_rfm": ("customer_id", ("segment",)),  # not one of the six: see rfm.with_segments
}

ROLLED = ("order_grain", "product_grain")  # tables that a star has beside the six while one report shares them


@dataclass(frozen=True)
class Between:
    """Slicer for a range of values, both ends included; None leaves an end open."""

    low: object = None
    high: object = None


# Column -> the values that stay, or a range of them.
Slicers = Mapping[str, Iterable | Between]


def slicer_test(slicers: Slicers) -> Column | None:
    """Condition that every slicer holds; a null value is in none."""
    def test(column: str, values: Iterable | Between) -> Column:
        if not isinstance(values, Between):
            return F.col(column).isin(*values)
        low = F.lit(True) if values.low is None else F.col(column) >= F.lit(values.low)
        high = F.lit(True) if values.high is None else F.col(column) <= F.lit(values.high)
        return F.col(column).isNotNull() & low & high

    return reduce(Column.__and__, [test(c, v) for c, v in slicers.items()]) if slicers else None


class Star:
    """Six tables, each built when first asked for.

    ``narrow`` lets a source that assembles ``fact_sales`` from several tables
    skip the joins a query does not need; it takes the wanted column names and
    how to join the dimensions they come from.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]],
                 narrow: Callable[[frozenset[str], str], DataFrame] | None = None,
                 slicers: Slicers | None = None) -> None:
        self.spark = spark
        self.slicers = dict(slicers or {})
        self.narrow = narrow
        self._tables = dict(tables)
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name == "customer_rfm" and name not in self._tables:
            raise ValueError("segments need scored customers: use rfm.with_segments(star)")
        if name not in self._built:
            self._built[name] = self._tables[name]()
        return self._built[name]

    dim_date = property(lambda self: self.table("dim_date"))
    dim_product = property(lambda self: self.table("dim_product"))
    dim_customer = property(lambda self: self.table("dim_customer"))
    dim_channel = property(lambda self: self.table("dim_channel"))
    fact_sales = property(lambda self: self.table("fact_sales"))
    fact_marketing = property(lambda self: self.table("fact_marketing"))

    def has(self, name: str) -> bool:
        return name in self._tables

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def with_tables(self, **tables: Callable[[], DataFrame]) -> Star:
        """Copy with some tables replaced; a replaced fact drops the narrow reader."""
        narrow = None if "fact_sales" in tables else self.narrow
        return Star(self.spark, {**self._tables, **tables}, narrow, self.slicers)

    def sliced(self, slicers: Slicers | None) -> Star:
        """Copy whose :meth:`sales` hold only what the slicers let through; its tables are the same.

        Reductions of all sales, see ``sales.rolled_up``, do not come along.
        """
        tables = {name: table for name, table in self._tables.items() if name not in ROLLED}
        return Star(self.spark, tables, self.narrow, {**self.slicers, **(slicers or {})}) if slicers else self

    def sales(self, *columns: str, how: str = "inner", where: Column | None = None,
              where_columns: Iterable[str] = ()) -> DataFrame:
        """Order lines with exactly ``columns``, joining only the dimensions they come from.

        ``where`` filters the lines and may read ``where_columns`` beside ``columns``.
        The star's slicers filter them too.
        """
        wanted = list(dict.fromkeys([*columns, *where_columns, *self.slicers]))
        inputs = dict.fromkeys(c for w in wanted for c in (DERIVED[w][0] if w in DERIVED else (w,)))
        outside = {c: (dim, key) for dim, (key, cols) in SALES_DIMENSIONS.items() for c in cols}
        keys = {key: None for c, (_, key) in outside.items() if c in inputs}
        lines = self.narrow(frozenset([*inputs, *keys]), how) if self.narrow else self.fact_sales
        for dim, (key, cols) in SALES_DIMENSIONS.items():
            missing = [c for c in cols if c in inputs and c not in lines.columns]
            if missing:
                lines = lines.join(self.table(dim).select(key, *missing), key, how)
        lines = lines.select(*[
            F.expr(DERIVED[w][1]).alias(w) if w in DERIVED else F.col(w) for w in wanted
        ])
        for test in (where, slicer_test(self.slicers)):
            if test is not None:
                lines = lines.filter(test)
        return lines.select(*columns)


def read_star(spark: SparkSession, folder: str, raw: bool = False, **options) -> Star:
    """Read six CSV files with a header. ``raw`` keeps every column as text, for validation.

    Columns are found by their names, in any order; others are ignored, a missing
    one is an error. ``options`` go to the reader: ``multiLine=True`` reads line
    breaks inside quotes, at the price of not splitting a file. Without it a
    record with one is broken, and reading fails. Of tables published by version the current ones are read.
    """
    folder = current(spark, folder)
    return Star(spark, {name: partial(_read_csv, spark, f"{folder}/{name}.csv", name, raw, options) for name in TABLES})


def _read_csv(spark: SparkSession, path: str, table: str, raw: bool, options: Mapping) -> DataFrame:
    reader = spark.read.options(**{"header": True, "escape": '"', "mode": "FAILFAST", "inferSchema": False, **options})
    names = {name.strip() for name in reader.csv(path).columns}
    missing = [c for c in COLUMNS[table] if c not in names]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    text = ", ".join(f"`{name.replace('`', '``')}` string" for name in reader.csv(path).columns)
    # Column pruning would keep the parser from seeing that a record is broken.
    rows = reader.option("columnPruning", False).schema(text).csv(path)
    rows = rows.select(*[F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c.strip()) for c in rows.columns if c.strip() in COLUMNS[table]])
    rows = rows.select(*COLUMNS[table])
    return rows if raw else typed(rows, table)


def typed(rows: DataFrame, table: str) -> DataFrame:
    """Text columns to the declared types; text that does not parse becomes null."""
    def convert(name: str, kind: str) -> Column:
        column = F.col(name)
        if name in CENTS:
            return F.round(column.try_cast("decimal(30,6)") * 100).cast("bigint")
        if kind == "int":
            return column.try_cast("double").try_cast("int")  # a nullable int may be written as 1.0
        return column.try_cast(kind)

    return rows.select(*[convert(n, k).alias(n) for n, k in COLUMNS[table].items() if n in rows.columns])


def _csv_text(rows: DataFrame) -> DataFrame:
    """Cents back to currency units for CSV files."""
    return rows.select(*[
        (F.col(c).cast("decimal(20,0)") / 100).cast("decimal(22,2)").alias(c) if c in CENTS else F.col(c)
        for c in rows.columns
    ])


def write_star(star: Star, folder: str, fmt: str = "parquet") -> dict[str, int]:
    """Overwrite the six tables under ``folder``, dimensions first; rows written per table.

    Parquet sales are partitioned by month. The rebalance hint lets AQE cut a hot
    month into several files and merge small ones.
    """
    written = {}
    for name, rows in star.tables().items():
        seen = Observation(f"rows_{name}")
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        if fmt == "csv":
            # Spark would strip text on writing; stripping is the cleaning job's to do and count.
            _csv_text(rows).write.mode("overwrite").csv(
                f"{folder}/{name}.csv", header=True, escape='"',
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        elif name == "fact_sales":
            months = rows.withColumn("year_month", F.date_format("order_date", "yyyy-MM"))
            (months.hint("rebalance", "year_month").write.mode("overwrite")
             .partitionBy("year_month").parquet(f"{folder}/{name}"))
        else:
            rows.write.mode("overwrite").parquet(f"{folder}/{name}")
        written[name] = seen.get["rows"]
    return written


def open_parquet_star(spark: SparkSession, folder: str) -> Star:
    """Tables written by :func:`write_star`; of published ones the current version, also if another follows later."""
    folder = current(spark, folder)

    def read(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{folder}/{name}")
        return rows.drop("year_month") if name == "fact_sales" else rows

    return Star(spark, {name: partial(read, name) for name in TABLES})
