"""Retail profitability on Spark: star schema in, margin answers out."""
