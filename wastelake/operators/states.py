"""Latest states, as aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .paging import ordered


def first_per(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """One whole row per key, the one lowest in `order`."""
    row = F.struct(*df.columns)
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min_by(row, order).alias("r")).select("r.*")


def latest_per(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    row = F.struct(*df.columns)
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(row, order).alias("r")).select("r.*")


def latest(df: DataFrame, order: Column | str) -> DataFrame:
    """The latest row of all; none for an empty table."""
    row = F.struct(*df.columns)
    order = F.col(order) if isinstance(order, str) else order
    return df.agg(F.max_by(row, order).alias("r")).filter("r is not null").select("r.*")


def _last_hour(states: DataFrame, as_of: Column) -> DataFrame:
    return states.filter(F.col("communication_date_time") > as_of - F.expr("interval 1 hour"))


def latest_states(states: DataFrame, as_of: Column) -> DataFrame:
    """States of the last hour, one per scrape and container, newest first."""
    return ordered(first_per(_last_hour(states, as_of), ["scraped_at", "description"], "id"), "-scraped_at,description")


def latest_invalid(states: DataFrame, as_of: Column) -> DataFrame:
    """The same for containers with an unknown id; the filter comes before the pick."""
    return latest_states(states.filter(F.col("valid") == F.lit(False)), as_of)
