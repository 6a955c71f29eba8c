"""Predicates of the list queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.clean import strip_whitespace

PORTION = 10_000
OPERATORS = {
    "exact": lambda c, v: c == v,
    "lt": lambda c, v: c < v,
    "gt": lambda c, v: c > v,
}

# Filters each list offers, column → allowed operators.
RANGE = ("exact", "lt", "gt")
EXACT = ("exact",)
_STATS = {n: RANGE for n in ("year", "measurements", "sum", "min", "max", "avg", "stddev")}
FILTERS = {
    "containers": {"id": EXACT, "serial_number": EXACT, "active": RANGE, "waste_type": EXACT, "waste_name": EXACT,
                   "placing_date": RANGE, "operational_date": RANGE, "warranty_date": RANGE, "well_id": EXACT,
                   "container_type_id": EXACT, "buurt_code": EXACT, "stadsdeel": EXACT},
    "wells": {n: EXACT for n in ("id", "id_number", "serial_number", "buurt_code", "stadsdeel", "created_at",
                                 "placing_date", "operational_date", "warranty_date", "site_id")},
    "container_types": {"volume": EXACT, "name": EXACT, "weight": EXACT},
    "sites": {n: EXACT for n in ("id", "short_id", "stadsdeel", "buurt_code", "bgt_based", "straatnaam", "huisnummer")},
    "measurements": {**{n: EXACT for n in ("id", "seq_id", "fractie", "stadsdeel", "buurt_code", "site_id",
                                           "first_weight", "second_weight", "net_weight", "valid")}, "weigh_at": RANGE},
    "sensor_states": {"scraped_at": RANGE, "filling": RANGE, "communication_date_time": RANGE, "description": EXACT,
                      "valid": EXACT, "short_id": EXACT},
    "site_week_stats": {**_STATS, "week": RANGE, "volume": RANGE, "capacity": RANGE, "fractie": EXACT, "site_id": EXACT},
    "site_month_stats": {**_STATS, "month": RANGE, "fractie": EXACT, "site_id": EXACT},
    "area_week_stats": {**_STATS, "week": RANGE, "fractie": EXACT, "buurt_code": EXACT},
    "area_month_stats": {**_STATS, "month": RANGE, "fractie": EXACT, "buurt_code": EXACT},
    "supplier_containers": {n: EXACT for n in ("site_id", "site_content_type_id", "container_slot_id",
                                               "container_type_id", "customer_key", "valid")},
    "supplier_container_types": {n: EXACT for n in ("shape", "has_bag", "servicing_method", "volume")},
    "supplier_slots": {n: EXACT for n in ("site_id", "site_content_type_id", "photo")},
    "supplier_sites": {"site_id": EXACT},
    "supplier_site_content_types": {"content_type_id": EXACT, "site_id": EXACT},
    "supplier_alerts": {"content_type_id": EXACT, "site_id": EXACT},
    "fill_levels": {n: EXACT for n in ("content_type", "content_type_name", "e_site", "e_site_name", "site_id",
                                       "frozen", "time")},
}

# Choices of the waste and district filters.
WASTE_CHOICES = ("Rest", "Glas", "Papier", "Textiel", "GFT", "KCA", "Plastic", "Kunstof", "Grof")
DISTRICTS = {
    "A": "Centrum", "B": "Westpoort", "E": "West", "F": "Nieuw-West", "K": "Zuid", "M": "Oost", "N": "Noord",
    "T": "Zuidoost",
}


def apply_filters(df: DataFrame, params: Mapping[str, object], allowed: Mapping[str, tuple]) -> DataFrame:
    """Filters written as `column` or `column__lt` / `column__gt`; an undeclared one is an error."""
    for name, value in params.items():
        column, _, op = name.partition("__")
        op = op or "exact"
        if op not in allowed.get(column, ()):
            raise ValueError(f"no filter {name!r}")
        if column not in df.columns:
            raise ValueError(f"the filter {name!r} needs rows with {column!r}, which a relation gives")
        df = df.filter(OPERATORS[op](F.col(column), F.lit(value)))
    return df


def with_well_area(containers: DataFrame, wells: DataFrame) -> DataFrame:
    """Containers with the district and neighbourhood of their well; NULL without one."""
    areas = wells.select(F.col("id").alias("well_id"), "stadsdeel", "buurt_code")
    return containers.drop("stadsdeel", "buurt_code").join(areas, "well_id", "left")


def choice(df: DataFrame, column: str, value: str, domain: tuple | Mapping) -> DataFrame:
    """Equality with a value of a fixed domain; any other value is an error."""
    if value not in domain:
        raise ValueError(f"{value!r} is no choice for {column}")
    return df.filter(F.col(column) == value)


def choice_in(df: DataFrame, column: str, value: str, domain: DataFrame, domain_column: str) -> DataFrame:
    """Equality with a value that must be present in a table; a value that is not makes
    the query fail when it runs."""
    known = domain.agg(F.count_if(F.col(domain_column) == value).alias("_n"))
    checked = F.when(F.col("_n") > 0, F.lit(value)).otherwise(
        F.raise_error(F.lit(f"{value!r} is no choice for {column}")).cast("string"))
    return df.crossJoin(F.broadcast(known)).filter(F.col(column) == checked).drop("_n")  # one row


def id_contains(df: DataFrame, text: str) -> DataFrame:
    return df.filter(F.col("id_number").contains(text))


def id_equals(df: DataFrame, text: str) -> DataFrame:
    return df.filter(F.col("id_number") == strip_whitespace(F.lit(text)))


def in_bbox(df: DataFrame, bbox: tuple[float, float, float, float], x: str = "x", y: str = "y") -> DataFrame:
    """Points in a box (lat1, lon1, lat2, lon2), edges included."""
    lat1, lon1, lat2, lon2 = bbox
    return df.filter(F.col(x).between(min(lon1, lon2), max(lon1, lon2)) & F.col(y).between(min(lat1, lat2), max(lat1, lat2)))


def polygon_in_bbox(df: DataFrame, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Polygons whose box meets a box (lat1, lon1, lat2, lon2)."""
    lat1, lon1, lat2, lon2 = bbox
    b = geo.bounds("rings")
    return df.filter((b["minx"] <= max(lon1, lon2)) & (b["maxx"] >= min(lon1, lon2))
                     & (b["miny"] <= max(lat1, lat2)) & (b["maxy"] >= min(lat1, lat2)))


def within_radius(df: DataFrame, x: float, y: float, radius: float, cx: str = "x", cy: str = "y") -> DataFrame:
    """Points at most `radius` metres from a place; the box test comes first, so it can
    reach the scan."""
    boxed = df.filter(F.col(cx).between(x - radius, x + radius) & F.col(cy).between(y - radius, y + radius))
    return boxed.filter(geo.distance(cx, cy, F.lit(x), F.lit(y)) <= radius)


def parse_xyr(text: str) -> tuple[float, float, float]:
    x, y, r = (float(part) for part in text.split(","))
    return x, y, r


def via(df: DataFrame, key: str, parents: DataFrame, parent_key: str = "id") -> DataFrame:
    """Rows whose parent is among `parents`."""
    return df.join(parents.select(F.col(parent_key).alias(key)), key, "left_semi")


def containers_without_well(containers: DataFrame) -> DataFrame:
    return containers.filter("well_id is null")


def containers_without_site(containers: DataFrame, wells: DataFrame) -> DataFrame:
    """No well, or a well without a site."""
    linked = wells.filter("site_id is not null").select(F.col("id").alias("well_id"))
    return containers.join(linked, "well_id", "left_anti")


def wells_without_container(wells: DataFrame, containers: DataFrame) -> DataFrame:
    return wells.join(containers.select(F.col("well_id").alias("id")), "id", "left_anti")


def sites_without_short_id(sites: DataFrame) -> DataFrame:
    return sites.filter("short_id is null")


def sites_with_empty_well(sites: DataFrame, wells: DataFrame, containers: DataFrame) -> DataFrame:
    """Sites once per well that holds no container, and once when they have no well."""
    filled = containers.filter("well_id is not null").select("well_id").distinct().withColumn("_full", F.lit(True))
    per_well = wells.filter("site_id is not null").select(F.col("site_id").alias("id"), F.col("id").alias("well_id"))
    per_well = per_well.join(filled, "well_id", "left")
    return sites.join(per_well, "id", "left").filter("_full is null").drop("well_id", "_full")


def malformed_ids(containers: DataFrame) -> DataFrame:
    """Too long, too short, or missing on an active container."""
    n = F.length("id_number")
    return containers.filter((n > 10) | (n < 4) | (F.col("id_number").isNull() & (F.col("active") == 1)))


def with_flag(df: DataFrame, flag: str, value: bool) -> DataFrame:
    """Attribute flag equal to a value; a row without the flag never matches."""
    return df.filter(F.try_element_at("extra_attributes", F.lit(flag)) == F.lit(str(value).lower()))


def sites_with_container(sites: DataFrame, wells: DataFrame, containers: DataFrame, wanted: Column) -> DataFrame:
    """Sites that have a container of some kind, each once."""
    hit = containers.filter(wanted).select(F.col("well_id").alias("id"))
    used = wells.join(hit, "id", "left_semi").select(F.col("site_id").alias("id"))
    return sites.join(used, "id", "left_semi")


def by_type(containers: DataFrame, types: DataFrame, column: str, op: str, value: float) -> DataFrame:
    """Containers whose type meets a filter on `volume` or `weight`."""
    wanted = types.filter(OPERATORS[op](F.col(column), F.lit(value))).select(F.col("id").alias("container_type_id"))
    return containers.join(wanted, "container_type_id", "inner")


def sites_by_type(
    sites: DataFrame, wells: DataFrame, containers: DataFrame, types: DataFrame, column: str, op: str, value: float,
) -> DataFrame:
    """Sites once per container whose type meets the filter.

    Containers are counted per well before the joins. The rows are repeated at the end, in
    portions that go to different tasks.
    """
    hits = by_type(containers, types, column, op, value).groupBy("well_id").agg(F.count("*").alias("n"))
    per_site = (
        wells.select(F.col("id").alias("well_id"), "site_id").join(hits, "well_id").groupBy("site_id")
        .agg(F.sum("n").alias("_n")).withColumnRenamed("site_id", "id")
    )
    portions = (
        per_site.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(PORTION).cast("bigint"))))
        .withColumn("_size", F.least(F.lit(PORTION), F.col("_n") - F.col("_at")).cast("int")).repartition("id", "_at")
    )
    rows = portions.select("id", F.explode(F.sequence(F.lit(1), F.col("_size"))).alias("_i")).drop("_i")
    return sites.join(rows, "id")


def search_names(df: DataFrame, text: str, column: str = "name") -> DataFrame:
    """All terms of a search text occur in the name, in any case."""
    terms = text.replace(",", " ").split()
    hits = [F.lower(column).contains(t.lower()) for t in terms]
    return df.filter(reduce(lambda a, b: a & b, hits)) if hits else df


def last_days(states: DataFrame, days: int, as_of: Column) -> DataFrame:
    return states.filter(F.col("communication_date_time") > as_of - F.make_interval(days=F.lit(days)))


def full_today(states: DataFrame, as_of: Column) -> DataFrame:
    return last_days(states.filter("filling > 90"), 1, as_of)


def weighed_between(measurements: DataFrame, after: str, before: str, valid: bool = True) -> DataFrame:
    return measurements.filter((F.col("weigh_at") > F.lit(after).cast("timestamp"))
                               & (F.col("weigh_at") < F.lit(before).cast("timestamp")) & (F.col("valid") == valid))


def in_register(supplier_containers: DataFrame, value: bool) -> DataFrame:
    return supplier_containers.filter(F.col("valid") == value)


def linked_to_site(supplier: DataFrame, linked: bool) -> DataFrame:
    return supplier.filter(F.col("site_id").isNotNull() if linked else F.col("site_id").isNull())


def no_site(supplier: DataFrame, value: bool) -> DataFrame:
    """The filter `no_site` of the lists, whose meaning is the reverse of its name."""
    return linked_to_site(supplier, value)
