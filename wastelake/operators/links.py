"""Equality links between the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import strip_whitespace


def containers_to_wells(wells: DataFrame, containers: DataFrame) -> DataFrame:
    """`well_id` from the wells' id arrays; the lowest well when two claim a container."""
    claims = (
        wells.select(F.col("id").alias("well_id"), F.explode("containers_bron").alias("id"))
        .groupBy("id").agg(F.min("well_id").alias("well_id"))
    )
    return containers.drop("well_id").join(claims, "id", "left")


def container_locations(containers: DataFrame, wells: DataFrame) -> DataFrame:
    place = wells.select(F.col("id").alias("well_id"), "stadsdeel", "buurt_code", "x", "y", "summary")
    kept = ["id", "id_number", "serial_number", "active", "waste_type", "waste_name", "container_type_id"]
    return containers.select("well_id", *[c for c in kept if c in containers.columns]).join(
        place, "well_id", "inner").drop("well_id")


def sites_with_wells(sites: DataFrame, wells: DataFrame) -> DataFrame:
    used = wells.filter("site_id is not null").select(F.col("site_id").alias("id"))
    return sites.join(used, "id", "left_semi")


def site_streets(sites: DataFrame, streets: DataFrame) -> DataFrame:
    """Sites with each road of their street name."""
    roads = streets.filter("opr_type = 'Weg'").select(F.col("id").alias("street_id"), F.col("display").alias("straatnaam"))
    return sites.join(roads, "straatnaam", "inner")


def representative_wells(wells: DataFrame, fields: list[str]) -> DataFrame:
    """One well per site, the one with the lowest id."""
    return (
        wells.filter("site_id is not null").groupBy("site_id")
        .agg(F.min_by(F.struct("id", *fields), "id").alias("w"))
        .select("site_id", F.col("w.id").alias("well_id"), *[F.col(f"w.{f}").alias(f) for f in fields])
    )


def measurements_at_sites(measurements: DataFrame, sites: DataFrame, fields: list[str]) -> DataFrame:
    """Weighings of known sites; the site key of a weighing is the short id."""
    known = sites.filter("short_id is not null").select(F.col("short_id").alias("site_id"), *fields)
    return measurements.join(known, "site_id", "inner")


def sensor_sites(states: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Whether the described container is known, and its site's short id."""
    known = known_ids.select(F.col("id_number").alias("description"), "short_id", F.lit(True).alias("_known"))
    return (
        states.withColumn("description", strip_whitespace("description"))
        .join(known, "description", "left")
        .withColumn("valid", F.coalesce("_known", F.lit(False)))
        .drop("_known")
    )


def link_if_exists(rows: DataFrame, raw_key: str, targets: DataFrame, name: str) -> DataFrame:
    """`name` = the raw key where a target has it, else NULL."""
    ids = targets.select(F.col("id").alias(raw_key), F.lit(True).alias("_found")).dropDuplicates([raw_key])
    return rows.join(ids, raw_key, "left").withColumn(name, F.when(F.col("_found"), F.col(raw_key))).drop("_found")


def slot_links(slots: DataFrame, sites: DataFrame, site_content_types: DataFrame) -> DataFrame:
    linked = link_if_exists(slots, "site_fk", sites, "site_id")
    return link_if_exists(linked, "site_content_type_fk", site_content_types, "site_content_type_id")


def register_validity(supplier_containers: DataFrame, register: DataFrame) -> DataFrame:
    """TRUE for a key in the register, FALSE for one that is not; a NULL key stays NULL
    and a NULL id in the register leaves no key FALSE, as `NOT IN` has it."""
    ids = register.select(F.col("id_number").alias("customer_key"))
    nulls = ids.agg(F.coalesce(F.max(F.col("customer_key").isNull()), F.lit(False)).alias("_has_null"))
    known = ids.filter("customer_key is not null").distinct().withColumn("_known", F.lit(True))
    empty = ids.agg((F.count("*") == 0).alias("_empty"))
    return (
        supplier_containers.join(known, "customer_key", "left")
        .crossJoin(F.broadcast(nulls)).crossJoin(F.broadcast(empty))  # one row each
        .withColumn("valid",
                    F.when(F.col("_known"), F.lit(True))
                    .when(F.col("_empty"), F.lit(False))
                    .when(F.col("customer_key").isNotNull() & ~F.col("_has_null"), F.lit(False)))
        .drop("_known", "_has_null", "_empty")
    )


def sites_with_type_term(
    term: str, types: DataFrame, containers: DataFrame, wells: DataFrame, sites: DataFrame,
) -> DataFrame:
    """Short ids of sites that have a container whose type name holds a term."""
    matching = types.filter(F.lower("name").contains(term.lower())).select(F.col("id").alias("container_type_id"))
    in_type = containers.join(matching, "container_type_id", "left_semi").select(F.col("well_id").alias("id"))
    used = wells.join(in_type, "id", "left_semi").select(F.col("site_id").alias("id"))
    return sites.join(used, "id", "left_semi").select("short_id")


def lonely_wells(wells: DataFrame, well_matches: DataFrame, containers: DataFrame) -> DataFrame:
    """Wells that match no map object, with their containers."""
    lonely = wells.join(well_matches.select(F.col("well_id").alias("id")), "id", "left_anti")
    inside = containers.select(F.col("id").alias("container_id"), "well_id", "waste_name")
    return lonely.withColumnRenamed("id", "well_id").join(inside, "well_id", "inner")


def usable_wells(wells: DataFrame, containers: DataFrame) -> DataFrame:
    """Active wells that hold at least one container."""
    return wells.filter("active = 1").join(
        containers.select(F.col("well_id").alias("id")), "id", "left_semi")


def inhabitants(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Inhabitants of the neighbourhood in the year of the statistic."""
    per_year = counts.groupBy("buurt_code", "year").agg(F.min("inhabitants").alias("inhabitants"))
    return stats.drop("inhabitants").join(per_year, ["buurt_code", "year"], "left")
