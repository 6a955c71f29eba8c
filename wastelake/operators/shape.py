"""Record shaping: from raw JSON items to typed tables, and from tables to list rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.clean import (
    DATE_KEYS, canonical_fraction, combine_date_time, drop_bad_date, left_text, remove_blanks, safe_float,
    safe_int, snake_name, waste_name, weights,
)
from ..sources.pages import SENSOR_FIELDS, sensor_items, weigh_records
from .links import sensor_sites

OWNER = "owner struct<id: bigint, name: string>"
DATES = "created_at string, placing_date string, warranty_date string, operational_date string"
WELL = (
    f"id bigint, id_number string, serial_number string, active string, {OWNER}, containers array<bigint>, {DATES}, "
    "location struct<address: struct<summary: string, district: string, neighbourhood: string>, "
    "position: struct<latitude: string, longitude: string>>"
)
CONTAINER = (
    f"id bigint, well bigint, id_number string, serial_number string, active string, {OWNER}, {DATES}, "
    "waste_type bigint, container_type bigint"
)


def _parsed(items: DataFrame, schema: str) -> DataFrame:
    """Raw items with their known fields as columns of `d`; `id` is the raw row's own."""
    return items.withColumn("d", F.from_json("data", schema))


def _active(c: str) -> Column:
    """`true`/`false` and numbers as an integer."""
    text = F.lower(F.col(c))
    return F.when(text == "true", 1).when(text == "false", 0).otherwise(safe_int(text))


def _dates() -> list[Column]:
    return [F.try_to_timestamp(drop_bad_date(f"d.{k}")).alias(k) for k in DATE_KEYS]


def wells(items: DataFrame) -> DataFrame:
    lon, lat = "d.location.position.longitude", "d.location.position.latitude"
    rows = _parsed(items, WELL).withColumn("p", geo.point_from_text(lon, lat))
    rd = geo.wgs84_to_rd("p.lon", "p.lat")
    return rows.select(
        "id", left_text("d.serial_number", 45).alias("serial_number"), left_text("d.id_number", 35).alias("id_number"),
        F.col("d.owner").alias("owner"), F.col("d.containers").alias("containers_bron"), *_dates(),
        _active("d.active").alias("active"), F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"),
        rd["x_rd"].alias("x"), rd["y_rd"].alias("y"), F.col("d.location.address").alias("address"),
        F.col("d.location.address.summary").alias("summary"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("extra_attributes"))


def containers(items: DataFrame) -> DataFrame:
    return _parsed(items, CONTAINER).select(
        "id", left_text("d.id_number", 35).alias("id_number"), left_text("d.serial_number", 45).alias("serial_number"),
        F.col("d.owner").alias("owner"), *_dates(), _active("d.active").alias("active"),
        F.col("d.waste_type").cast("int").alias("waste_type"), waste_name("data").alias("waste_name"),
        F.col("d.container_type").alias("container_type_id"))


def container_types(items: DataFrame) -> DataFrame:
    return _parsed(items, "name string, volume string, weight string").select(
        "id", "d.name", F.col("d.volume").try_cast("decimal(6,3)").alias("volume"),
        safe_int("d.weight").alias("weight"))


def _timestamp(field: str, name: str) -> Column:
    return F.try_to_timestamp(F.col(f"d.{field}")).alias(name)


def supplier_content_types(items: DataFrame) -> DataFrame:
    schema = ("category int, categoryName string, name string, state string, weightToVolumeRatio double, "
              "lastModified string")
    return _parsed(items, schema).select(
        "id", "d.category", F.col("d.categoryName").alias("category_name"), "d.name", "d.state",
        F.col("d.weightToVolumeRatio").alias("weight_to_volume_ratio"), _timestamp("lastModified", "last_modified"))


def supplier_sites(items: DataFrame) -> DataFrame:
    schema = ("type int, name string, area int, address string, city string, country string, postalCode string, "
              "latitude double, longitude double, photo boolean, lastModified string")
    rd = geo.wgs84_to_rd("d.longitude", "d.latitude")
    return _parsed(items, schema).select(
        "id", "d.type", "d.name", "d.area", "d.address", "d.city", "d.country",
        F.col("d.postalCode").alias("postal_code"), F.col("d.longitude").alias("lon"), F.col("d.latitude").alias("lat"),
        rd["x_rd"].alias("x"), rd["y_rd"].alias("y"), "d.photo", _timestamp("lastModified", "last_modified"))


def supplier_site_content_types(items: DataFrame) -> DataFrame:
    schema = ("contentType bigint, contentTypeName string, categoryName string, site bigint, fillLevel int, "
              "dateWhenFull string, buildUpRate double, fillUpTime int, lastServiceEvent string, lastModified string")
    return _parsed(items, schema).select(
        "id", F.col("d.contentType").alias("content_type_id"), F.col("d.contentTypeName").alias("content_type_name"),
        F.col("d.categoryName").alias("category_name"), F.col("d.site").alias("site_id"),
        F.col("d.fillLevel").alias("fill_level"), _timestamp("dateWhenFull", "date_when_full"),
        F.col("d.buildUpRate").alias("build_up_rate"), F.col("d.fillUpTime").alias("fill_up_time"),
        _timestamp("lastServiceEvent", "last_service_event"), _timestamp("lastModified", "last_modified"))


def supplier_container_types(items: DataFrame) -> DataFrame:
    schema = ("name string, volume int, sensorHeight double, fullHeight double, shape string, hasBag boolean, "
              "servicingAmount string, servicingMethod string, lastModified string")
    return _parsed(items, schema).select(
        "id", "d.name", "d.volume", F.col("d.sensorHeight").alias("sensor_height"),
        F.col("d.fullHeight").alias("full_height"), "d.shape", F.col("d.hasBag").alias("has_bag"),
        F.col("d.servicingAmount").alias("servicing_amount"), F.col("d.servicingMethod").alias("servicing_method"),
        _timestamp("lastModified", "last_modified"))


def supplier_container_slots(items: DataFrame) -> DataFrame:
    schema = ("name string, contentType bigint, container bigint, siteContentType bigint, site bigint, fillLevel int, "
              "dateWhenFull string, lastServiceEvent string, photo boolean, lastModified string")
    return _parsed(items, schema).select(
        "id", "d.name", F.col("d.contentType").alias("content_type_id"), "d.container",
        F.col("d.siteContentType").alias("site_content_type_fk"), F.col("d.site").alias("site_fk"),
        F.col("d.fillLevel").alias("fill_level"), _timestamp("dateWhenFull", "date_when_full"),
        _timestamp("lastServiceEvent", "last_service_event"), "d.photo", _timestamp("lastModified", "last_modified"))


def supplier_containers(items: DataFrame) -> DataFrame:
    schema = ("type bigint, site bigint, siteContentType bigint, containerSlot bigint, customerKey string, "
              "cellLocation struct<latitude: double, longitude: double, accuracy: int>, lastModified string")
    lon, lat = "d.cellLocation.longitude", "d.cellLocation.latitude"
    rd = geo.wgs84_to_rd(lon, lat)
    return _parsed(items, schema).select(
        "id", F.col("d.type").alias("container_type_id"), F.col("d.site").alias("site_id"),
        F.col("d.siteContentType").alias("site_content_type_id"), F.col("d.containerSlot").alias("container_slot_id"),
        remove_blanks("d.customerKey").alias("customer_key"), F.col(lon).alias("lon"), F.col(lat).alias("lat"),
        rd["x_rd"].alias("x"), rd["y_rd"].alias("y"), F.col("d.cellLocation.accuracy").alias("geo_accuracy"),
        _timestamp("lastModified", "last_modified"))


def supplier_alerts(items: DataFrame) -> DataFrame:
    schema = ("type int, typeName string, reported string, lastObserved string, site bigint, siteName string, area int, "
              "areaName string, contentType bigint, contentTypeName string, start string")
    return _parsed(items, schema).select(
        "id", "d.type", F.col("d.typeName").alias("type_name"), _timestamp("reported", "reported"),
        _timestamp("lastObserved", "last_observed"), F.col("d.site").alias("site_id"),
        F.col("d.siteName").alias("site_name"), "d.area", F.col("d.areaName").alias("area_name"),
        F.col("d.contentType").alias("content_type_id"), F.col("d.contentTypeName").alias("content_type_name"),
        _timestamp("start", "start"))


def weighings(pages: DataFrame, keep_undated: bool = False) -> DataFrame:
    """Weigh measurements of pages; a record without date or time is left out, unless
    `keep_undated` asks for it to count it as an error."""
    records = weigh_records(pages)
    w = weights("FirstWeight", "SecondWeight", "NettWeight")
    p = geo.point_from_text("Longitude", "Latitude")
    fraction = F.when(F.col("has_fraction"), canonical_fraction("FractionId")).otherwise(canonical_fraction(None))
    rows = records.select(
        "page_id", safe_int("Seq").alias("seq_id"), safe_int("SystemId").alias("system_id"),
        combine_date_time("Date", "Time").alias("weigh_at"),
        F.col("ContIds").alias("container_ids"), F.col("NoOfCont").alias("container_count"),
        fraction.alias("fractie"), safe_float("FillChance").alias("fill_chance"),
        safe_float("FillLevel").alias("fill_level"), *[c.alias(n) for n, c in w.items()],
        F.col("District").alias("district"), F.col("Neighborhood").alias("neighborhood"),
        F.col("Location").alias("location"), safe_int("Location").alias("location_id"),
        safe_int("CustId").alias("site_id"), p["lon"].alias("lon"), p["lat"].alias("lat"))
    return rows if keep_undated else rows.filter("weigh_at is not null")


def sensor_states(snapshots: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """Press-container states; records without a container are left out."""
    items = sensor_items(snapshots).filter("ContainerId is not null and ContainerId <> 0")
    p = geo.point_from_text("Lon", "Lat")
    special = {"Id": "_id"}
    columns = [F.col(n).alias(special.get(n, snake_name(n))) for n in SENSOR_FIELDS
               if n not in ("HouseNumber", "PressStatus", "PlacementDate", "CommunicationDateTime")]
    rows = items.select(
        "scraped_at", *columns, safe_int("HouseNumber").alias("house_number"),
        safe_int("PressStatus").alias("press_status"), F.try_to_timestamp("PlacementDate").alias("placement_date"),
        F.try_to_timestamp("CommunicationDateTime").alias("communication_date_time"),
        p["lon"].alias("geo_lon"), p["lat"].alias("geo_lat"))
    return rows if known_ids is None else sensor_sites(rows, known_ids)


FILL_LEVEL = (
    "time: string, frozen: boolean, fillLevel: int, confidence: int, containerSlot: bigint, contentType: bigint, "
    "contentTypeName: string, siteContentType: bigint, site: bigint, siteName: string, containerSlotName: string"
)


def fill_levels(pages: DataFrame) -> DataFrame:
    """Fill levels of historical pages."""
    return (
        pages.select(F.explode(F.from_json("data", f"fillLevels array<struct<{FILL_LEVEL}>>")["fillLevels"]).alias("d"))
        .select(
            _timestamp("time", "time"), "d.frozen", F.col("d.fillLevel").alias("fill_level"), "d.confidence",
            F.col("d.containerSlot").alias("container_slot"), F.col("d.contentType").alias("content_type"),
            F.col("d.contentTypeName").alias("content_type_name"),
            F.col("d.siteContentType").alias("e_site_content_type"), F.col("d.site").alias("e_site"),
            F.col("d.siteName").alias("e_site_name"), F.col("d.containerSlotName").alias("container_slot_name"))
    )


def _known_path(df: DataFrame, path: str) -> bool:
    kind = df.schema
    for name in path.split("."):
        if not hasattr(kind, "fieldNames") or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def sparse(df: DataFrame, fields: str | None = None, omit: str | None = None) -> DataFrame:
    """Pick columns by `a,b.c` and drop those of `omit`.

    An empty `fields` keeps none, unknown names are ignored. A dotted path gives a column
    named like the path.
    """
    wanted = list(df.columns) if fields is None else [f for f in fields.split(",") if f]
    dropped = set(filter(None, (omit or "").split(",")))
    known = [f for f in wanted if _known_path(df, f) and f not in dropped]
    order = {c: i for i, c in enumerate(df.columns)}
    known.sort(key=lambda f: order[f.split(".")[0]])
    return df.select(*[F.col(f).alias(f) if "." in f else F.col(f) for f in known])


# Columns of the short and the detailed lists.
LIST_COLUMNS = {
    "measurements": (
        ("id", "seq_id", "system_id", "weigh_at", "fractie", "site_id", "buurt_code", "first_weight",
         "second_weight", "net_weight"),
        ("id", "seq_id", "system_id", "weigh_at", "location", "fractie", "container_ids", "stadsdeel", "buurt_code",
         "site_id", "first_weight", "second_weight", "net_weight", "geometrie", "valid"),
    ),
    "sensor_states": (
        ("filling", "communication_date_time", "id", "container_id", "short_id"),
        None,
    ),
    "containers": (
        ("_display", "id", "id_number", "owner", "active", "waste_type", "waste_name", "container_type",
         "warranty_date", "operational_date", "placing_date", "well", "address"),
        ("_display", "id", "id_number", "owner", "active", "waste_type", "waste_name", "container_type",
         "warranty_date", "operational_date", "placing_date", "well", "address"),
    ),
    "sites": (
        ("_display", "id", "short_id", "stadsdeel", "straatnaam", "huisnummer", "wells", "fracties", "centroid"),
        ("_display", "id", "short_id", "stadsdeel", "buurt_code", "straatnaam", "huisnummer", "wells", "fracties",
         "bgt_based", "extra_attributes", "centroid", "geometrie", "distance_to_address"),
    ),
}


def list_columns(df: DataFrame, entity: str, detailed: bool) -> DataFrame:
    """Columns of a list; a table that lacks one of them is an error."""
    names = LIST_COLUMNS[entity][1 if detailed else 0] or df.columns
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"{entity} lack {', '.join(missing)}")
    return df.select(*names)


def expand_one(child: DataFrame, key: str, parent: DataFrame, fields: Sequence[str], name: str) -> DataFrame:
    """The parent's fields as a struct column, NULL without a parent."""
    parents = parent.select(F.col("id").alias(key), F.struct(*fields).alias(name))
    return child.join(parents, key, "left")


def expand_many(parent: DataFrame, child: DataFrame, key: str, fields: Sequence[str], name: str) -> DataFrame:
    """The relation as rows: the parent's columns and one child's fields as a struct, which
    is NULL for a parent without any. However many children a parent has, a row holds one."""
    children = child.select(F.col(key).alias("id"), F.struct(*fields).alias(name))
    return parent.join(children, "id", "left")


def fraction_maps(sites: DataFrame, fractions: DataFrame) -> DataFrame:
    """Containers and volume of each site as maps by fraction."""
    rows = fractions.groupBy("site_id", "fractie").agg(
        F.max("containers").alias("containers"), F.max("volume_m3").alias("volume_m3"))
    maps = rows.groupBy("site_id").agg(
        F.map_from_entries(F.collect_list(F.struct("fractie", "containers"))).alias("containers"),
        F.map_from_entries(F.collect_list(F.struct("fractie", "volume_m3"))).alias("volumes_m3"))
    return sites.join(
        maps.select(F.col("site_id").alias("id"), F.struct("containers", "volumes_m3").alias("fracties")), "id", "left")


def child_count(parent: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    counts = child.groupBy(F.col(key).alias("id")).agg(F.count("*").alias(name))
    return parent.join(counts, "id", "left").withColumn(name, F.coalesce(name, F.lit(0)))


def public_names(df: DataFrame) -> DataFrame:
    """Names of the lists: a site's `distance` and a sensor state's `description`."""
    return df.withColumnsRenamed({"distance": "distance_to_address", "description": "container_id"})


def container_address(rows: DataFrame, well_rows: DataFrame) -> DataFrame:
    place = well_rows.select(F.col("id").alias("well_id"), F.col("summary").alias("address"))
    return rows.join(place, "well_id", "left")


def display(entity: str) -> Column:
    """Display text of a site, a site fraction or a container type."""
    if entity == "sites":
        return F.format_string("%s-%s %s", "id", "straatnaam", "huisnummer")
    if entity == "site_fractions":
        return F.format_string("%s - %s - %s", "fractie", "volume_m3", "short_id")
    if entity == "container_types":
        return F.format_string("%s - %sM3", "name", "volume")
    raise ValueError(f"no display text for {entity!r}")
