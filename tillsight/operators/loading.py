"""Loading the star into tables, seeding reference rows and numbering lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.ranking import numbered
from tillsight.sources.session import scratch_folder
from tillsight.sources.star import TABLES, Star, open_parquet_star, write_star
from tillsight.sources.tables import channel_rows
from tillsight.sources.versions import publish


def load_star(star: Star, folder: str | None = None) -> Star:
    """Build the six tables anew under ``folder``, publish them as its current version and open that version.

    A load that fails leaves the last version current; loads at the same time do not touch each other, and what
    this one returns stays itself whatever is loaded later. Without a folder the tables go with the application.
    """
    folder = folder or f"{scratch_folder(star.spark)}/star-loaded"
    path, _ = publish(star.spark, folder, lambda path: write_star(star, path))
    return open_parquet_star(star.spark, path)


def table_counts(star: Star) -> DataFrame:
    """Rows per table."""
    counts = [
        star.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def load_star_counts(star: Star) -> DataFrame:
    """Load the star, then count what the tables hold."""
    return table_counts(load_star(star))


def seed_rows(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the seed rows whose key it lacks; rows already there win."""
    return existing.unionByName(seed.join(existing.select(key), key, "left_anti"))


def seed_channels(star: Star) -> DataFrame:
    """Channels that marketing already names, completed with the missing reference channels."""
    named = star.fact_marketing.groupBy("channel_id").agg(F.max("campaign_name").alias("campaign"))
    existing = named.select(
        "channel_id",
        F.regexp_replace("campaign", r" \d{4}Q\d$", "").alias("channel_name"),
        F.lit("In use").alias("channel_type"),
    )
    return seed_rows(existing, channel_rows(star.spark), "channel_id")


def with_surrogate_key(rows: DataFrame, name: str, order: list[str] | None = None) -> DataFrame:
    """Number rows. Without ``order`` the ids are unique but have gaps and cost nothing.

    With ``order`` they run 1..n in that order, whose values must be unique.
    """
    if order is None:
        return rows.select(F.monotonically_increasing_id().alias(name), "*")
    return numbered(rows, order, name).select(name, *rows.columns)
