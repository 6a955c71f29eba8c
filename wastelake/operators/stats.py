"""Weigh statistics per site and neighbourhood.

Facts are added up per site before any join: the join then moves one row per site,
fraction and period, and a site with a large share of the weighings is combined on the
map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import capacity, col, period_parts
from ..session import cut
from .links import inhabitants


def _partials() -> list:
    w = F.col("net_weight").cast("bigint")
    return [
        F.count("*").alias("measurements"), F.count(w).alias("_n"), F.sum(w).alias("sum"),
        F.sum((w * w).cast("decimal(38,0)")).alias("_squares"), F.min(w).alias("min"), F.max(w).alias("max"),
    ]


def _merged() -> list:
    return [
        F.sum("measurements").alias("measurements"), F.sum("_n").alias("_n"), F.sum("sum").alias("sum"),
        F.sum("_squares").alias("_squares"), F.min("min").alias("min"), F.max("max").alias("max"),
    ]


def _finished(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and sample deviation from exact sums, both rounded up."""
    n, total = F.col("_n").cast("decimal(38,0)"), F.col("sum").cast("decimal(38,0)")
    spread = (n * F.col("_squares") - total * total).cast("double") / (F.col("_n") * (F.col("_n") - 1)).cast("double")
    return df.select(
        *keys, "measurements", "sum", "min", "max",
        F.ceil(F.col("sum") / F.col("_n")).cast("bigint").alias("avg"),
        F.when(F.col("_n") > 1, F.ceil(F.sqrt(spread))).cast("bigint").alias("stddev"),
    )


def period_sums(measurements: DataFrame, periods: tuple[str, ...] = ("week", "month"), iso_year: bool = False) -> DataFrame:
    """Sums of the valid weighings per site, fraction, year and periods, from which those of
    fewer keys are added up."""
    parts = period_parts("weigh_at", iso_year)
    facts = measurements.filter("valid").select(
        "site_id", "fractie", parts["year"].alias("year"), *[parts[p].alias(p) for p in periods], "net_weight")
    return facts.groupBy("site_id", "fractie", "year", *periods).agg(*_partials())


def _with_sites(sums: DataFrame, sites: DataFrame, fields: list[str]) -> DataFrame:
    known = sites.filter("short_id is not null").select(F.col("short_id").alias("site_id"), *fields)
    return sums.join(known, "site_id", "inner")


def site_stats(measurements: DataFrame, sites: DataFrame, period: str, iso_year: bool = False) -> DataFrame:
    """Valid weighings per site, fraction, year and `week` or `month`."""
    return _site_table(period_sums(measurements, (period,), iso_year), sites, period)


def _site_table(sums: DataFrame, sites: DataFrame, period: str) -> DataFrame:
    return _finished(_with_sites(sums, sites, []), ["site_id", "fractie", "year", period])


def area_stats(measurements: DataFrame, sites: DataFrame, period: str, iso_year: bool = False) -> DataFrame:
    """The same per neighbourhood: the district and area code of the site."""
    return _area_table(period_sums(measurements, (period,), iso_year), sites, period)


def _area_table(sums: DataFrame, sites: DataFrame, period: str) -> DataFrame:
    per_site = _with_sites(sums, sites, ["stadsdeel", "buurt_code"])
    keys = ["stadsdeel", "area", "fractie", "year", period]
    merged = per_site.withColumnRenamed("buurt_code", "area").groupBy(*keys).agg(*_merged())
    code = F.concat_ws("", "stadsdeel", "area")
    return _finished(merged.withColumn("buurt_code", code), ["buurt_code", "fractie", "year", period])


def site_fractions(sites: DataFrame, containers: DataFrame, wells: DataFrame, types: DataFrame) -> DataFrame:
    """Containers and volume per site and waste name.

    Containers are first counted per well, waste name and type, so the joins with
    wells and types work on counts.
    """
    counts = containers.groupBy("well_id", "waste_name", "container_type_id").agg(F.count("*").alias("n"))
    volumes = types.select(F.col("id").alias("container_type_id"), "volume")
    located = wells.filter("site_id is not null").select(F.col("id").alias("well_id"), "site_id")
    known = sites.select(F.col("id").alias("site_id"))
    per_type = (
        counts.join(volumes, "container_type_id", "inner").join(located, "well_id", "inner")
        .groupBy("site_id", "waste_name")
        .agg(F.sum("n").alias("containers"), F.sum(F.col("volume") * F.col("n")).alias("volume_m3"))
    )
    return per_type.join(known, "site_id", "left_semi").withColumnRenamed("waste_name", "fractie")


def _one_name(fraction: str):
    """Kunststof and Plastic are one fraction to the lookups."""
    name = col(fraction)
    return F.when(name == "Kunststof", F.lit("Plastic")).otherwise(name)


def add_site_volumes(stats: DataFrame, fractions: DataFrame, sites: DataFrame) -> DataFrame:
    """Volume and container count of the site's fraction; a Kunststof statistic takes
    Kunststof before Plastic."""
    short = sites.filter("short_id is not null").select(F.col("id").alias("site_id"), "short_id")
    available = fractions.join(short, "site_id", "inner").select(
        F.col("short_id").alias("site_id"), F.col("fractie").alias("own"),
        F.round("volume_m3").cast("bigint").alias("volume"), F.col("containers").cast("bigint").alias("containers"))
    names = F.when(F.col("own") == "Plastic", F.array(F.lit("Plastic"), F.lit("Kunststof"))).otherwise(F.array("own"))
    per_name = (
        available.withColumn("fractie", F.explode(names))
        .groupBy("site_id", "fractie")
        .agg(F.min_by(F.struct("volume", "containers"),
                      F.struct(F.col("own") != F.col("fractie"), "own")).alias("v"))
        .select("site_id", "fractie", "v.volume", "v.containers")
    )
    return stats.drop("volume", "containers").join(per_name, ["site_id", "fractie"], "left")


def add_capacity(stats: DataFrame) -> DataFrame:
    return stats.withColumn("capacity", capacity("sum", "volume", "fractie"))


def area_container_counts(wells: DataFrame, containers: DataFrame, areas: DataFrame) -> DataFrame:
    """Containers per neighbourhood and waste name."""
    per_well = containers.groupBy("well_id", "waste_name").agg(F.count("*").alias("n"))
    located = wells.filter("buurt_code is not null").select(F.col("id").alias("well_id"), "buurt_code")
    known = areas.select(F.col("vollcode").alias("buurt_code"))
    return (
        per_well.join(located, "well_id", "inner").groupBy("buurt_code", "waste_name")
        .agg(F.sum("n").alias("containers")).join(known, "buurt_code", "left_semi")
        .withColumnRenamed("waste_name", "fractie")
    )


def add_area_counts(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Container counts of the statistic's neighbourhood and fraction."""
    names = F.when(F.col("own") == "Plastic", F.array(F.lit("Plastic"), F.lit("Kunststof"))).otherwise(F.array("own"))
    per_name = (
        counts.select("buurt_code", F.col("fractie").alias("own"), F.col("containers").cast("bigint").alias("containers"))
        .withColumn("fractie", F.explode(names))
        .groupBy("buurt_code", "fractie")
        .agg(F.min_by("containers", F.struct(F.col("own") != F.col("fractie"), "own")).alias("containers"))
    )
    return stats.drop("containers").join(per_name, ["buurt_code", "fractie"], "left")


def all_statistics(
    measurements: DataFrame, sites: DataFrame, fractions: DataFrame, counts: DataFrame,
) -> dict[str, DataFrame]:
    """The four statistics tables with inhabitants, volumes and capacity.

    The weighings are read once: their sums per week and month are written, and the tables
    are added up from these.
    """
    finest = cut(period_sums(measurements))
    out = {}
    for period in ("week", "month"):
        sums = finest.groupBy("site_id", "fractie", "year", period).agg(*_merged())
        out[f"site_{period}"] = add_capacity(add_site_volumes(_site_table(sums, sites, period), fractions, sites))
        out[f"area_{period}"] = inhabitants(_area_table(sums, sites, period), counts)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
