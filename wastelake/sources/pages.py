"""Landed JSON pages as tables.

A raw page is a row `(id, scraped_at, data)` with the page text in `data`. A page
that breaks its contract goes to an error frame, never to an exception on the driver.

Pages that hold a list are parsed once by `listed`: `listed_errors` of that table has the pages
without a readable list, and the functions that give rows take the table (or raw pages) and read
all others. So each page is either read, if only as an empty list, or an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import col, combine_date_time, strip_whitespace
from ..functions import geo

# Endpoint names of the second fill-level supplier and their item keys.
COLLECTION_KEYS = {
    "containers": "containers",
    "container_types": "containerTypes",
    "container_slots": "containerSlots",
    "content_types": "contentTypes",
    "sites": "sites",
    "site_content_types": "siteContentTypes",
    "fill_levels": "fillLevels",
    "alerts": "alerts",
}

# Header names a weigh page must have, and those it may lack.
REQUIRED_WEIGH_FIELDS = (
    "SystemId", "Seq", "Date", "Time", "CustId", "District", "ContIds", "NoOfCont", "TotalVolume",
    "Neighborhood", "FirstWeight", "SecondWeight", "NettWeight", "Latitude", "Longitude",
)
OPTIONAL_WEIGH_FIELDS = ("FillLevel", "FillChance", "FractionId", "Location")

WEIGH_PAGE = "Fields array<string>, Records array<array<string>>, Status string, Message string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files of `{id, scraped_at, data}` with `data` kept as text."""
    return spark.read.schema("id bigint, scraped_at timestamp, data string").json(path)


def detail_items(pages: DataFrame) -> DataFrame:
    """Unwrap pages with one key, such as `{"well": {...}}`."""
    item = F.map_values(F.from_json("data", "map<string,string>"))[0]
    return pages.select("scraped_at", item.alias("data")).select(
        F.get_json_object("data", "$.id").try_cast("bigint").alias("id"), "scraped_at", "data")


CORRUPT = "_corrupt"
LIST_SOURCES = ("ids", "sensors", "known", "population", *COLLECTION_KEYS)


def _list_shape(source: str) -> tuple[str, Column]:
    """The type of a source's page, and the list of items in a column `page` of that type; NULL for none."""
    if source == "ids":
        texts = F.filter(F.map_values("page"), lambda text: text.startswith("["))  # an object would read as a list of one
        lists = F.filter(F.transform(texts, lambda t: F.from_json(t, "array<struct<id:bigint>>")), lambda items: items.isNotNull())
        return "map<string,string>", F.when(F.size(lists) > 0, F.flatten(lists))
    if source == "sensors":
        state = ", ".join(f"{name}: {dtype}" for name, dtype in SENSOR_FIELDS.items())
        data = F.filter(F.transform("page", lambda response: response["result"]["data"]), lambda items: items.isNotNull())
        return f"array<struct<result: struct<data: array<struct<{state}>>>>>", F.when(F.size(data) > 0, F.flatten(data))
    if source == "known":
        item = "struct<id_number: string, well: struct<id: bigint, site: map<string,string>>>"
        return f"results array<{item}>, {CORRUPT} string", F.col("page.results")
    if source == "population":
        item = "struct<jaar: string, gebiedcode15: string, waarde: bigint>"
        return f"results array<{item}>, {CORRUPT} string", F.col("page.results")
    key = COLLECTION_KEYS[source]
    return f"`{key}` array<string>, {CORRUPT} string", F.col(f"page.`{key}`")


def listed(pages: DataFrame, source: str) -> DataFrame:
    """Pages with their list in `items`, or with the `reason` why there is none.

    The reasons are 'no text', 'malformed' (no JSON, or JSON of another form) and 'no list'.
    Where rows and errors are both wanted, write this table once and take both from it.
    """
    if "reason" in pages.columns and "items" in pages.columns:
        return pages
    shape, items = _list_shape(source)
    page = F.explode(F.array(F.from_json("data", shape, {"columnNameOfCorruptRecord": CORRUPT}))).alias("page")
    broken = F.col(f"page.{CORRUPT}").isNotNull() if CORRUPT in shape else F.col("page").isNull()
    reason = (
        F.when(F.col("items").isNotNull(), F.lit(None).cast("string")).when(F.trim(F.coalesce("data", F.lit(""))) == "", "no text")
        .when(broken, "malformed").otherwise("no list"))
    return pages.select("*", page).withColumn("items", items).withColumn("reason", reason).drop("page")


def listed_errors(pages: DataFrame, source: str) -> DataFrame:
    """Pages without a readable list: `(id, scraped_at, reason, data)`."""
    return listed(pages, source).filter("reason is not null").select("id", "scraped_at", "reason", "data")


def list_ids(pages: DataFrame) -> DataFrame:
    """Ids of the list pages `{"wells": [{"id": 1}, ...]}`, whatever the key."""
    return listed(pages, "ids").select(F.explode("items").alias("item")).select("item.id")


def parsed_weigh_pages(pages: DataFrame) -> DataFrame:
    """Pages with their parsed content; as a generator, so that a filter on the content
    does not parse the text a second time."""
    return pages.select("*", F.explode(F.array(F.from_json("data", WEIGH_PAGE))).alias("page"))


def weigh_raw(pages: DataFrame) -> DataFrame:
    """Weigh pages keyed by the system and time of their last record that has both.

    Pages without any such record are in `unkeyed_weigh_pages`.
    """
    return _keyed(pages).filter("key is not null").select("id", "scraped_at", "key.system_id", "key.weigh_at", "data")


def _keyed(pages: DataFrame) -> DataFrame:
    place = lambda name: F.nullif(F.array_position("page.Fields", F.lit(name)), F.lit(0)).cast("int").alias(name)

    def key(record: Column) -> Column:
        field = lambda name: F.try_element_at(record, F.col(f"at.{name}"))
        return F.struct(
            field("SystemId").try_cast("bigint").alias("system_id"),
            combine_date_time(field("Date"), field("Time")).alias("weigh_at"))

    def whole(k: Column) -> Column:
        return k["system_id"].isNotNull() & k["weigh_at"].isNotNull()

    # The last record mostly has both; only where it has not are the others looked at.
    at = F.explode(F.array(F.struct(place("SystemId"), place("Date"), place("Time")))).alias("at")
    last = F.explode(F.array(key(F.try_element_at("page.Records", F.lit(-1))))).alias("last")
    any_ = F.try_element_at(F.filter(F.transform("page.Records", key), whole), F.lit(-1))
    return (
        parsed_weigh_pages(pages).select("id", "scraped_at", "data", "page", at).select("id", "scraped_at", "data", "page", "at", last)
        .select("id", "scraped_at", "data", F.when(whole(F.col("last")), F.col("last")).otherwise(any_).alias("key"))
    )


def unkeyed_weigh_pages(pages: DataFrame) -> DataFrame:
    """Pages that no record gives a system and a time, malformed ones among them."""
    return _keyed(pages).filter("key is null").select("id", "scraped_at", "data")


def _has_required_header() -> Column:
    required = F.array(*[F.lit(f) for f in REQUIRED_WEIGH_FIELDS])
    return F.coalesce(F.size(F.array_except(required, F.col("page.Fields"))) == 0, F.lit(False))


def weigh_page_errors(pages: DataFrame) -> DataFrame:
    """Pages that miss a required header name, with the missing names."""
    required = F.array(*[F.lit(f) for f in REQUIRED_WEIGH_FIELDS])
    missing = F.array_except(required, F.coalesce("page.Fields", F.array().cast("array<string>")))
    return parsed_weigh_pages(pages).filter(~_has_required_header()).select(
        "id", F.array_join(missing, ",").alias("missing"))


def weigh_records(pages: DataFrame) -> DataFrame:
    """One row per positional record, as text columns under the header names.

    The header is looked up once per page; its records only carry the positions.
    """
    names = REQUIRED_WEIGH_FIELDS + OPTIONAL_WEIGH_FIELDS
    places = F.array(*[F.nullif(F.array_position("page.Fields", F.lit(n)), F.lit(0)).cast("int") for n in names])
    # As a generator, so that the filter does not look the header up a second time.
    located = parsed_weigh_pages(pages).select(
        F.col("id").alias("page_id"), F.col("page.Records").alias("records"), F.explode(F.array(places)).alias("at"))
    whole = located.filter(" and ".join(f"at[{i}] is not null" for i in range(len(REQUIRED_WEIGH_FIELDS))))
    return (
        whole.select("page_id", "at", F.explode("records").alias("record"))
        .select("page_id",
                *[F.try_element_at("record", F.col("at")[i]).alias(n) for i, n in enumerate(names)],
                F.col("at")[names.index("FractionId")].isNotNull().alias("has_fraction"))
    )


def weigh_systems(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """System ids of the successful pages, and the pages that failed."""
    parsed = pages.withColumn("page", F.from_json("data", "Systems array<string>, Status string, Message string"))
    good = F.coalesce(F.col("page.Status") == "SUCCESSFUL", F.lit(False))
    systems = parsed.filter(good).select(F.explode("page.Systems").alias("s")).select(
        F.col("s").try_cast("bigint").alias("system_id"))
    failed = parsed.filter(~good).select("id", "page.Status", "page.Message")
    return systems, failed


# Field names and types of a press-container state, as the sensor supplier sends them.
SENSOR_FIELDS = {
    "Id": "bigint", "UnitId": "bigint", "City": "string", "Number": "string", "Street": "string",
    "Filling": "int", "DeviceId": "bigint", "EntityId": "bigint", "Fraction": "string", "StatusId": "bigint",
    "LimitFull": "int", "ContainerId": "bigint", "Description": "string", "HouseNumber": "string",
    "PressStatus": "string", "PressCurrent": "int", "StatusDevice": "string", "ContainerName": "string",
    "LimitNearFull": "int", "PlacementDate": "string", "BatteryVoltage": "double", "NrPressStrokes": "int",
    "DrumActionCount": "int", "NetworkStrength": "int", "StatusChipcards": "string", "StatusContainer": "string",
    "StatusIncidents": "boolean", "MaxNrPressStrokes": "int", "StatusTriggerName": "string",
    "DrumPositionStatus": "int", "LockPositionStatus": "int", "NrPressStrokesToGo": "int",
    "StatusConfiguration": "string", "TotalNrPressStrokes": "bigint", "TotalNrEmptyDetected": "bigint",
    "CommunicationDateTime": "string", "VolumeCorrectionFactor": "double", "MaxDumpCountOnDumpLocation": "int",
    "SuccessfulTransactionsSinceReset": "bigint", "UnsuccessfulTransactionsSinceReset": "bigint",
    "Lat": "string", "Lon": "string",
}


def sensor_items(snapshots: DataFrame) -> DataFrame:
    """States of RPC snapshots; a response without `result.data` gives no rows."""
    return (
        listed(snapshots, "sensors").select("scraped_at", F.explode("items").alias("state"))
        .select("scraped_at", "state.*")
    )


def known_container_ids(pages: DataFrame) -> DataFrame:
    """Container id → site short id from the register's container list.

    Rows without an id, a well or a site are left out; the last one of equal ids counts.
    """
    rows = listed(pages, "known").select("id", F.posexplode("items").alias("pos", "item"))
    return (
        rows.filter("item.id_number is not null and item.well is not null and size(item.well.site) > 0")
        .select(strip_whitespace("item.id_number").alias("id_number"),
                F.col("item.well.site")["short_id"].try_cast("bigint").alias("short_id"), F.struct("id", "pos").alias("place"))
        .groupBy("id_number")
        .agg(F.max_by(F.struct("short_id"), "place")["short_id"].alias("short_id"))
    )


def collection_items(pages: DataFrame, endpoint: str) -> DataFrame:
    """Items of one endpoint of the second supplier as `(id, scraped_at, data)`."""
    return (
        listed(pages, endpoint).select("scraped_at", F.explode("items").alias("data"))
        .select(F.get_json_object("data", "$.id").try_cast("bigint").alias("id"), "scraped_at", "data")
    )


def timed_pages(pages: DataFrame, endpoint: str = "fill_levels") -> tuple[DataFrame, DataFrame]:
    """Historical pages stamped with the time of their last item, and the pages
    whose payload is no list or is empty."""
    key = COLLECTION_KEYS[endpoint]
    items = F.from_json("data", f"`{key}` array<struct<time: string>>")[key]
    time = F.try_to_timestamp(F.try_element_at(items, F.lit(-1))["time"])
    stamped = pages.withColumn("time", time)
    return stamped.filter("time is not null"), stamped.filter("time is null").drop("time")


def population(pages: DataFrame, this_year: int, years: int = 6) -> DataFrame:
    """Inhabitants per neighbourhood for this year and the ones before."""
    return (
        listed(pages, "population").select(F.explode("items").alias("r"))
        .select(F.col("r.jaar").try_cast("int").alias("year"), F.col("r.gebiedcode15").alias("buurt_code"),
                F.col("r.waarde").alias("inhabitants"))
        .filter((F.col("year") > this_year - years) & (F.col("year") <= this_year))
    )


GEOJSON = ("features array<struct<id: string, properties: map<string,string>, "
           "geometry: struct<type: string, coordinates: string>>>")


LAYER_TYPES = ("Point", "MultiPoint", "Polygon", "MultiPolygon")


def geo_layer_errors(pages: DataFrame) -> DataFrame:
    """Features that `geo_layer` gives no row for: `(id, fid, type)`; a malformed page is one without feature."""
    features = F.from_json("data", GEOJSON)["features"]
    named = pages.select("id", F.explode_outer(features).alias("f"))
    return named.filter(~F.coalesce(F.col("f.geometry.type").isin(*LAYER_TYPES), F.lit(False))).select(
        "id", F.col("f.id").alias("fid"), F.col("f.geometry.type").alias("type"))


def geo_layer(pages: DataFrame, to_rd: bool = True) -> DataFrame:
    """GeoJSON feature collections as rows `(fid, attrs, part, x, y, rings)`.

    Points fill x and y, polygons fill `rings`; each part of a many-part geometry is a
    row. Features of other types are in `geo_layer_errors`. With `to_rd` the WGS84 coordinates become RD metres.
    """
    rd = geo.wgs84_to_rd_sql("c[0]", "c[1]") if to_rd else {"x_rd": "c[0]", "y_rd": "c[1]"}
    place = f"c -> named_struct('x', {rd['x_rd']}, 'y', {rd['y_rd']})"

    def read(depth: int) -> str:
        return "from_json(f.geometry.coordinates, '" + "array<" * depth + "double" + ">" * depth + "')"

    def dots(points: str) -> str:
        return f"transform(transform({points}, {place}), p -> named_struct('point', p, 'rings', CAST(NULL AS {geo.RINGS})))"

    def shapes(polygons: str) -> str:
        rings = f"transform({polygons}, g -> transform(g, r -> transform(r, {place})))"
        return f"transform({rings}, g -> named_struct('point', CAST(NULL AS struct<x:double,y:double>), 'rings', g))"

    parts = F.expr(
        "CASE f.geometry.type"
        f" WHEN 'Point' THEN {dots(f'array({read(1)})')} WHEN 'MultiPoint' THEN {dots(read(2))}"
        f" WHEN 'Polygon' THEN {shapes(f'array({read(3)})')} WHEN 'MultiPolygon' THEN {shapes(read(4))} END")
    return (
        pages.select(F.explode(F.from_json("data", GEOJSON)["features"]).alias("f"))
        .select(F.col("f.id").alias("fid"), F.col("f.properties").alias("attrs"), F.posexplode(parts).alias("part", "g"))
        .select("fid", "attrs", "part", F.col("g.point.x").alias("x"), F.col("g.point.y").alias("y"),
                F.col("g.rings").alias("rings"))
    )


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Map and register tables from one Parquet file or folder each."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
