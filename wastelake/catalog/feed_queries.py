"""Sources, marks, record shaping and cleaning functions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, geo
from ..operators import checks, links, shape
from ..plans import feeds
from ..session import cut, work_path
from ..sources import incremental, pages as pg
from . import landed
from .registry import Tables, query


def _text(c: str):
    """Timestamp as text, the same in both engines."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query("src_01_detail_pages", "SELECT id, id_number FROM {wells}")
def _(t: Tables) -> DataFrame:
    items = pg.detail_items(landed.well_pages(t))
    return items.select("id", F.get_json_object("data", "$.id_number").alias("id_number"))


@query("src_02_list_ids", "SELECT id FROM {wells}")
def _(t: Tables) -> DataFrame:
    return pg.list_ids(landed.list_pages(t))


LAST = """SELECT l_linenumber AS system_id, l_orderkey, l_shipdate, l_tax,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC) AS rn FROM {lineitem}"""


@query("src_03_weigh_raw", """SELECT l_orderkey * 10 + l_linenumber AS id, l_linenumber AS system_id,
    strftime(max(l_shipdate), '%Y-%m-%d') || ' 10:44:34' AS weigh_at FROM {lineitem} WHERE l_tax <> 0
    GROUP BY l_orderkey, l_linenumber""")
def _(t: Tables) -> DataFrame:
    """Keyed pages, whether or not their last record is dated."""
    return pg.weigh_raw(landed.weigh_pages(t)).select("id", "system_id", _text("weigh_at"))


@query("src_03_unkeyed_pages", """SELECT l_orderkey * 10 + l_linenumber AS id FROM {lineitem}
    GROUP BY l_orderkey, l_linenumber HAVING max(l_tax) = 0""")
def _(t: Tables) -> DataFrame:
    return pg.unkeyed_weigh_pages(landed.weigh_pages(t)).select("id")


@query("src_04_weigh_records", """SELECT l_orderkey * 10 + l_linenumber AS page_id, CAST(l_suppkey AS VARCHAR) AS cust,
    CASE WHEN l_orderkey % 2 = 0 THEN 'Laan ' || l_suppkey END AS location FROM {lineitem}""")
def _(t: Tables) -> DataFrame:
    return pg.weigh_records(landed.weigh_pages(t)).select(
        "page_id", F.col("CustId").alias("cust"), F.col("Location").alias("location"))


@query("src_05_sensor_items", "SELECT event_id AS id, user_id, CAST(floor(value) AS INT) AS filling FROM {events}")
def _(t: Tables) -> DataFrame:
    return pg.sensor_items(landed.sensor_snapshots(t)).select(
        F.col("Id").alias("id"), F.split("Description", r"\s+")[2].cast("bigint").alias("user_id"),
        F.col("Filling").alias("filling"))


@query("src_06_collection_items", "SELECT p_partkey AS id, p_name AS name FROM {part}")
def _(t: Tables) -> DataFrame:
    items = pg.collection_items(landed.collection_pages(t, "container_types"), "container_types")
    return items.select("id", F.get_json_object("data", "$.name").alias("name"))


@query("src_07_timed_pages", """SELECT CAST(floor(event_id / 100) AS BIGINT) AS id,
    strftime(max_by(ts, event_id), '%Y-%m-%d %H:%M:%S') AS time FROM {events} GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    good, _bad = pg.timed_pages(landed.collection_pages(t, "fill_levels"))
    return good.select("id", _text("time"))


@query("src_07_untimed_pages", """SELECT CAST(floor(event_id / 100) AS BIGINT) AS id
    FROM {events} GROUP BY 1 HAVING count(*) > 0""")
def _(t: Tables) -> DataFrame:
    broken = landed.collection_pages(t, "fill_levels").withColumn("data", F.lit('{"fillLevels":{"message":"busy"}}'))
    return pg.timed_pages(broken)[1].select("id")


@query("src_08_population", "SELECT year, buurt_code, inhabitants FROM {population} WHERE year > 2000 - 6 AND year <= 2000")
def _(t: Tables) -> DataFrame:
    return pg.population(landed.population_pages(t), 2000).select("year", "buurt_code", "inhabitants")


KNOWN = """SELECT 'REK' || user_id AS id_number, user_id + 1000 AS short_id FROM {events}
    GROUP BY user_id HAVING max(value) > 60"""


@query("src_09_known_container_ids", KNOWN)
def _(t: Tables) -> DataFrame:
    return pg.known_container_ids(landed.known_id_pages(t))


# Pages of each list source: raw pages and the SQL of their ids.
LISTED = {
    "src_02_list_errors": ("ids", landed.list_pages, "SELECT DISTINCT CAST(floor(id / 100) AS BIGINT) AS id FROM {wells}"),
    "src_05_sensor_errors": ("sensors", landed.sensor_snapshots, """SELECT DISTINCT
        CAST(epoch(date_trunc('minute', ts)) * 1000 + user_id AS BIGINT) AS id FROM {events}"""),
    "src_06_collection_errors": ("alerts", lambda t: landed.collection_pages(t, "alerts"),
                                 "SELECT DISTINCT CAST(floor(event_id / 100) AS BIGINT) AS id FROM {events}"),
    "src_08_population_errors": ("population", landed.population_pages,
                                 "SELECT DISTINCT CAST(floor(year / 100) AS BIGINT) AS id FROM {population}"),
    "src_09_known_errors": ("known", landed.known_id_pages,
                            "SELECT DISTINCT CAST(floor(user_id / 100) AS BIGINT) AS id FROM {events}"),
}


def _listed_errors(source: str, pages) -> Callable[[Tables], DataFrame]:
    """All pages of a source three times: whole, without the last character, and emptied of their
    list. Each gives its rows or an error; the rows are counted, too."""
    none = "[{}]" if source == "sensors" else "{}"

    def errors(t: Tables) -> DataFrame:
        whole = cut(pages(t))
        cut_off = whole.withColumn("data", F.expr("left(data, length(data) - 1)"))
        read = cut(pg.listed(whole.unionByName(cut_off).unionByName(whole.withColumn("data", F.lit(none))), source))
        found = read.filter("reason is null").select("id", F.lit("read").alias("reason"))
        return found.unionByName(pg.listed_errors(read, source).select("id", "reason"))
    return errors


for _name, (_source, _pages, _ids) in LISTED.items():
    query(_name, f"""SELECT id, reason FROM ({_ids}) CROSS JOIN
        (SELECT unnest(['read', 'malformed', 'no list']) AS reason)""")(_listed_errors(_source, _pages))


@query("src_10_geo_layer", """SELECT 'pand.' || id AS fid, brand, minx, miny, maxx, maxy FROM {buildings}""")
def _(t: Tables) -> DataFrame:
    layer = pg.geo_layer(landed.geojson_pages(t))
    b = geo.bounds("rings")
    return layer.select("fid", F.col("attrs")["brand"].alias("brand"),
                        *[F.round(b[n], 1).alias(n) for n in ("minx", "miny", "maxx", "maxy")])


@query("src_10_layer_errors", """SELECT id * 10 AS id, 'pand.' || id AS fid, 'LineString' AS type FROM {buildings} WHERE id % 3 = 0
    UNION ALL SELECT id * 10, NULL, NULL FROM {buildings} WHERE id % 3 = 1""")
def _(t: Tables) -> DataFrame:
    """Lines and broken pages among polygons are told, not lost."""
    feature = (lambda kind: F.format_string(
        '{"features": [{"id": "pand.%d", "properties": {}, "geometry": {"type": "' + kind + '", "coordinates": [[[4, 52], [5, 52], [5, 53], [4, 52]]]}}]}', "id"))
    text = F.when(F.col("id") % 3 == 0, feature("LineString")).when(F.col("id") % 3 == 1, F.lit("not json")).otherwise(feature("Polygon"))
    return pg.geo_layer_errors(t.buildings.select((F.col("id") * 10).alias("id"), text.alias("data")))


@query("src_11_read_tables", "SELECT (SELECT count(*) FROM {part}) AS parts, (SELECT count(*) FROM {orders}) AS orders")
def _(t: Tables) -> DataFrame:
    tables = pg.read_tables(t.spark, t.folder, ["part", "orders"])
    return tables["part"].agg(F.count("*").alias("parts")).crossJoin(tables["orders"].agg(F.count("*").alias("orders")))


@query("src_12_weigh_systems", """SELECT s_suppkey AS system_id FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
    WHERE n_regionkey <> 2""")
def _(t: Tables) -> DataFrame:
    return pg.weigh_systems(landed.system_pages(t))[0]


@query("src_12_failed_pages", """SELECT DISTINCT CAST(floor(s_suppkey / 100) * 100 + n_nationkey AS BIGINT) AS id
    FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE n_regionkey = 2""")
def _(t: Tables) -> DataFrame:
    return pg.weigh_systems(landed.system_pages(t))[1].select("id")


def _raw_weighings(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("bigint").alias("system_id"),
        F.col("l_shipdate").alias("weigh_at"))


OLD = "SELECT l_linenumber AS system_id, max(l_shipdate) AS mark FROM {lineitem} WHERE l_linestatus = 'O' AND l_linenumber <= 5 GROUP BY 1"


NEW_PAGES = f"""WITH m AS ({OLD})
    SELECT l_linenumber AS system_id, strftime(l_shipdate, '%Y-%m-%d') AS day, min(l_orderkey) AS id
    FROM {{lineitem}} LEFT JOIN m ON m.system_id = l_linenumber WHERE mark IS NULL OR l_shipdate > mark GROUP BY 1, 2"""


def _stored_weighings(t: Tables) -> DataFrame:
    """Loaded measurements: all up to the mark of each system that has one."""
    marked = t.lineitem.filter("l_linestatus = 'O' and l_linenumber <= 5").select(
        F.col("l_linenumber").cast("bigint").alias("system_id"), F.col("l_shipdate").alias("weigh_at"))
    return _raw_weighings(t).join(marked.distinct(), ["system_id", "weigh_at"], "left_semi")


@query("inc_01_new_weigh_pages", NEW_PAGES)
def _(t: Tables) -> DataFrame:
    fresh = incremental.new_weigh_pages(_raw_weighings(t), _stored_weighings(t))
    return fresh.select("system_id", F.date_format("weigh_at", "yyyy-MM-dd").alias("day"), "id")


@query("inc_01_stored_pages", NEW_PAGES)
def _(t: Tables) -> DataFrame:
    """The same from pages in folders by system and year, stored in two loads, one of them twice."""
    path = work_path(t.spark, "raw")
    raw = _raw_weighings(t).withColumn("weigh_at", F.col("weigh_at").cast("timestamp"))
    for load in ("0", "1", "1"):
        incremental.store_weigh_pages(raw.filter(F.col("id") % 2 == int(load)), path, load, "year")
    fresh = incremental.new_stored_weigh_pages(
        t.spark, path, "id bigint, system_id bigint, weigh_at timestamp", _stored_weighings(t))
    return fresh.select("system_id", F.date_format("weigh_at", "yyyy-MM-dd").alias("day"), "id")


@query("inc_02_new_snapshots", """SELECT id FROM {states} WHERE scraped_at > (SELECT max(scraped_at) FROM {states}
    WHERE scraped_at < TIMESTAMP '2024-01-15 00:00:00')""")
def _(t: Tables) -> DataFrame:
    return incremental.new_snapshots(t.states, t.states.filter("scraped_at < timestamp '2024-01-15 00:00:00'")).select("id")


@query("inc_02_first_snapshots", "SELECT id FROM {states}")
def _(t: Tables) -> DataFrame:
    return incremental.new_snapshots(t.states, t.states.filter("filling > 1000")).select("id")


@query("inc_03_new_fill_level_pages", """SELECT event_id FROM {events}
    WHERE ts > (SELECT max(ts) FROM {events} WHERE ts < TIMESTAMP '2024-01-15 00:00:00')""")
def _(t: Tables) -> DataFrame:
    raw = t.events.select("event_id", F.col("ts").alias("time"))
    done = raw.filter("time < timestamp '2024-01-15 00:00:00'").select("time")
    return incremental.new_fill_level_pages(raw, done).select("event_id")


@query("inc_04_resume_points", """SELECT s.system_id, strftime(m.at, '%Y-%m-%d') AS date, strftime(m.at, '%H:%M:%S') AS time
    FROM (SELECT DISTINCT l_suppkey AS system_id FROM {lineitem}) s LEFT JOIN
         (SELECT l_suppkey, max(l_shipdate) AS at FROM {lineitem} WHERE l_suppkey > 10 GROUP BY 1) m ON m.l_suppkey = s.system_id""")
def _(t: Tables) -> DataFrame:
    systems = t.lineitem.select(F.col("l_suppkey").alias("system_id")).distinct()
    raw = t.lineitem.filter("l_suppkey > 10").select(F.col("l_suppkey").alias("system_id"), F.col("l_shipdate").alias("weigh_at"))
    return incremental.resume_points(systems, raw)


@query("inc_05_missing_days", """WITH m AS (SELECT min(ts) AS first, max(ts) AS now FROM {events})
    SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS after, strftime(a + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS until
    FROM (SELECT unnest(generate_series(first, now, INTERVAL 1 DAY)) AS a, now FROM m) WHERE a < now""")
def _(t: Tables) -> DataFrame:
    first = t.events.agg(F.min("ts").alias("time"))
    now = t.events.agg(F.max("ts")).first()[0]
    return incremental.missing_days(first, F.lit(now)).select(_text("after"), _text("until"))


@query("inc_06_page_progress", """SELECT CAST(floor(event_id / 100) AS BIGINT) AS id, max(ts) < TIMESTAMP '2024-01-20 00:00:00' AS in_range,
    count(*) = 100 AS is_full FROM {events} GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    pages = t.events.groupBy(F.floor(F.col("event_id") / 100).cast("bigint").alias("id")).agg(
        F.max("ts").alias("last_time"), F.count("*").alias("count"))
    pages = pages.withColumn("until", F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return incremental.page_progress(pages, 100).select("id", "in_range", "is_full")


@query("prj_01_wells", """SELECT id, left(serial_number, 45) AS serial_number, CASE WHEN active = 1 THEN 1 ELSE 0 END AS active,
    owner_id AS owner, '2012-03-29 10:00:00' AS created_at, CAST(NULL AS VARCHAR) AS placing_date,
    CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, summary FROM {wells}""")
def _(t: Tables) -> DataFrame:
    wells = shape.wells(pg.detail_items(landed.well_pages(t)))
    return wells.select("id", "serial_number", "active", F.col("owner.id").alias("owner"), _text("created_at"),
                        _text("placing_date"), F.rint("x").cast("bigint").alias("x"), F.rint("y").cast("bigint").alias("y"),
                        "summary")


@query("prj_02_containers", """SELECT id, id_number, active,
    CASE active WHEN 1 THEN waste_type END AS waste_type,
    CASE active WHEN 1 THEN waste_name WHEN 0 THEN 'Unknown' ELSE 'Unkown' END AS waste_name, container_type_id,
    strftime(placing_date, '%Y-%m-%d %H:%M:%S') AS placing_date FROM {containers}""")
def _(t: Tables) -> DataFrame:
    rows = shape.containers(pg.detail_items(landed.container_pages(t)))
    return rows.select("id", "id_number", "active", "waste_type", "waste_name", "container_type_id", _text("placing_date"))


@query("prj_03_container_types", "SELECT id, name, volume, weight FROM {container_types}")
def _(t: Tables) -> DataFrame:
    return shape.container_types(pg.detail_items(landed.type_pages(t)))


def _items(t: Tables, endpoint: str) -> DataFrame:
    return pg.collection_items(landed.collection_pages(t, endpoint), endpoint)


STAMP = "'2019-01-03 20:00:00' AS last_modified"


@query("prj_04_supplier_content_types", f"""SELECT p_partkey AS id, p_size AS category, p_type AS category_name,
    p_name AS name, p_retailprice AS weight_to_volume_ratio, {STAMP} FROM {{part}}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_content_types(_items(t, "content_types")).select(
        "id", "category", "category_name", "name", "weight_to_volume_ratio", _text("last_modified"))


@query("prj_05_supplier_sites", f"""SELECT id, name, CAST(NULL AS VARCHAR) AS postal_code, CAST(x AS BIGINT) AS x,
    CAST(y AS BIGINT) AS y, true AS photo, {STAMP} FROM {{supplier_points}}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_sites(_items(t, "sites")).select(
        "id", "name", "postal_code", F.rint("x").cast("bigint").alias("x"), F.rint("y").cast("bigint").alias("y"), "photo",
        _text("last_modified"))


@query("prj_06_supplier_site_content_types", """SELECT o_orderkey AS id, o_custkey AS content_type_id,
    o_orderpriority AS content_type_name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_when_full,
    o_totalprice AS build_up_rate, 9 AS fill_up_time FROM {orders}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_site_content_types(_items(t, "site_content_types")).select(
        "id", "content_type_id", "content_type_name", _text("date_when_full"), "build_up_rate", "fill_up_time")


@query("prj_07_supplier_container_types", """SELECT p_partkey AS id, p_name AS name, p_size AS volume,
    p_size / 2 AS sensor_height, p_type AS shape, p_size > 25 AS has_bag, p_brand AS servicing_method FROM {part}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_container_types(_items(t, "container_types")).select(
        "id", "name", "volume", "sensor_height", "shape", "has_bag", "servicing_method")


@query("prj_08_supplier_slots", """SELECT o_orderkey AS id, o_orderstatus AS name, o_custkey AS container,
    o_orderkey * 2 AS site_content_type_fk, o_custkey * 2 AS site_fk, false AS photo FROM {orders}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_container_slots(_items(t, "container_slots")).select(
        "id", "name", "container", "site_content_type_fk", "site_fk", "photo")


@query("prj_09_supplier_containers", """SELECT id, CASE WHEN active <> 2 THEN 'RE' || id * 5 END AS customer_key,
    CASE WHEN active = 1 THEN CAST(x AS BIGINT) END AS x, CASE WHEN active = 1 THEN 10 END AS geo_accuracy FROM {wells}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_containers(_items(t, "containers")).select(
        "id", "customer_key", F.rint("x").cast("bigint").alias("x"), "geo_accuracy")


@query("prj_10_supplier_alerts", """SELECT event_id AS id, event_type AS type_name, 'site ' || user_id AS site_name,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS reported FROM {events}""")
def _(t: Tables) -> DataFrame:
    return shape.supplier_alerts(_items(t, "alerts")).select("id", "type_name", "site_name", _text("reported"))


WEIGHED = """SELECT l_orderkey AS seq_id, l_linenumber AS system_id, l_suppkey AS site_id,
    strftime(l_shipdate, '%Y-%m-%d') || ' 10:44:34' AS weigh_at,
    CASE WHEN l_orderkey % 2 = 1 OR l_returnflag = 'A' THEN 'Rest' WHEN l_returnflag = 'N' THEN 'GFT' ELSE 'Plastic' END AS fractie,
    CASE WHEN l_discount <> 0 THEN CAST(floor(l_extendedprice / 20) AS BIGINT) END AS first_weight,
    CAST(floor(l_extendedprice / 40) AS BIGINT) AS second_weight,
    CASE WHEN l_quantity <= 45 THEN CAST(floor(l_quantity) AS BIGINT) * 10 - 30 END AS net_weight,
    l_quantity <= 45 AND l_quantity >= 3 AND floor(l_extendedprice / 40) >= 250
        AND (l_discount = 0 OR floor(l_extendedprice / 20) >= 250) AS valid,
    CASE WHEN l_orderkey % 2 = 0 THEN l_quantity END AS fill_level,
    CAST(NULL AS DOUBLE) AS fill_chance, CASE WHEN l_discount <> 0.05 THEN 4.96802 END AS lon
    FROM {lineitem} WHERE l_tax <> 0"""


@query("prj_11_weighings", WEIGHED)
def _(t: Tables) -> DataFrame:
    return shape.weighings(landed.weigh_pages(t)).select(
        "seq_id", "system_id", "site_id", _text("weigh_at"), "fractie", "first_weight", "second_weight", "net_weight",
        "valid", "fill_level", "fill_chance", "lon")


@query("fn_14_load_errors", """SELECT count(*) AS rows,
    count(*) FILTER (l_tax = 0 OR l_quantity > 45 OR floor(l_quantity) = 3) AS errors,
    count(*) FILTER (l_tax = 0 OR l_quantity > 45 OR floor(l_quantity) = 3) <= 50000 AS ok FROM {lineitem}""")
def _(t: Tables) -> DataFrame:
    return checks.load_errors(shape.weighings(landed.weigh_pages(t), keep_undated=True))


@query("fn_14_errors_of_the_load", """SELECT count(*) AS rows,
    count(*) FILTER (l_tax = 0 OR l_quantity > 45 OR floor(l_quantity) = 3) AS errors,
    count(*) FILTER (l_tax <> 0) AS stored FROM {lineitem}""")
def _(t: Tables) -> DataFrame:
    """The same numbers, counted by the job that writes the dated records."""
    rules = checks.few_load_errors(2 ** 62)
    watched = checks.Watched(shape.weighings(landed.weigh_pages(t), keep_undated=True), rules)
    stored = cut(watched.df.filter("weigh_at is not null"))
    counts = watched.stop_unless_held("weighings")
    return stored.agg(*[F.lit(counts[r.name]).alias(r.name) for r in rules], F.count("*").alias("stored"))


STATES = f"""SELECT e.event_id AS _id, 'REK' || e.user_id AS description, k.id_number IS NOT NULL AS valid, k.short_id,
    CAST(floor(e.value) AS INT) AS filling, CASE WHEN e.value >= 50 THEN 12 END AS house_number,
    CASE WHEN e.value >= 10 THEN 4.9 END AS geo_lon,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS communication_date_time
    FROM {{events}} e LEFT JOIN ({KNOWN}) k ON k.id_number = 'REK' || e.user_id WHERE e.value <= 300 AND e.user_id <> 0"""


def _state_columns(df: DataFrame) -> DataFrame:
    return df.select("_id", "description", "valid", "short_id", "filling", "house_number", "geo_lon",
                     _text("communication_date_time"))


@query("prj_12_sensor_states", STATES)
def _(t: Tables) -> DataFrame:
    known = pg.known_container_ids(landed.known_id_pages(t))
    return _state_columns(shape.sensor_states(landed.sensor_snapshots(t), known))


LEVELS = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, value > 100 AS frozen, CAST(floor(value) AS INT) AS fill_level,
    CASE WHEN value > 50 THEN user_id END AS container_slot, p_name || ' ' || p_partkey AS e_site_name
    FROM {events} JOIN {part} ON p_partkey = event_id % (SELECT count(*) FROM {part})"""


@query("prj_13_fill_levels", LEVELS)
def _(t: Tables) -> DataFrame:
    return shape.fill_levels(landed.collection_pages(t, "fill_levels")).select(
        _text("time"), "frozen", "fill_level", "container_slot", "e_site_name")


@query("prj_14_sparse_fields", "SELECT id, straatnaam FROM {sites}")
def _(t: Tables) -> DataFrame:
    return shape.sparse(t.sites, "straatnaam,id,nothing,huisnummer", "huisnummer")


@query("prj_14_dotted_fields", """SELECT c.id, w.site_id AS "well.site_id" FROM {containers} c
    LEFT JOIN {wells} w ON w.id = c.well_id""")
def _(t: Tables) -> DataFrame:
    rows = shape.expand_one(t.containers, "well_id", t.wells, ["id", "site_id"], "well")
    return shape.sparse(rows, "id,well.site_id")


LISTED = "seq_id * 10 + system_id AS id, seq_id, system_id, strftime(weigh_at, '%Y-%m-%d') AS weigh_at"


def _listed_measurements(t: Tables) -> DataFrame:
    return t.measurements.withColumns({
        "id": F.col("seq_id") * 10 + F.col("system_id"), "weigh_at": F.date_format("weigh_at", "yyyy-MM-dd"),
        "location": F.concat(F.lit("Laan "), F.col("site_id").cast("string")), "container_ids": F.col("seq_id").cast("string"),
        "buurt_code": F.concat("stadsdeel", F.lit("01")), "geometrie": geo.point_to_wkt("x", "y")})


@query("prj_15_list_columns", f"""SELECT {LISTED}, fractie, site_id, stadsdeel || '01' AS buurt_code, first_weight, second_weight,
    net_weight FROM {{measurements}}""")
def _(t: Tables) -> DataFrame:
    return shape.list_columns(_listed_measurements(t), "measurements", False)


@query("prj_15_detail_columns", f"""SELECT {LISTED}, 'Laan ' || site_id AS location, fractie, CAST(seq_id AS VARCHAR) AS container_ids,
    stadsdeel, stadsdeel || '01' AS buurt_code, site_id, first_weight, second_weight, net_weight,
    'POINT(' || CAST(x AS BIGINT) || ' ' || CAST(y AS BIGINT) || ')' AS geometrie, valid FROM {{measurements}}""")
def _(t: Tables) -> DataFrame:
    return shape.list_columns(_listed_measurements(t), "measurements", True)


@query("prj_16_expand_one", """SELECT c.id, w.id_number AS well_number, s.short_id FROM {containers} c
    LEFT JOIN {wells} w ON w.id = c.well_id LEFT JOIN {sites} s ON s.id = w.site_id""")
def _(t: Tables) -> DataFrame:
    wells = shape.expand_one(t.wells, "site_id", t.sites, ["id", "short_id"], "site")
    rows = shape.expand_one(t.containers, "well_id", wells, ["id", "id_number", "site"], "well")
    return rows.select("id", F.col("well.id_number").alias("well_number"), F.col("well.site.short_id").alias("short_id"))


@query("prj_16_expand_many", """SELECT w.id, w.site_id, c.id AS container_id, c.waste_name
    FROM {wells} w LEFT JOIN {containers} c ON c.well_id = w.id""")
def _(t: Tables) -> DataFrame:
    rows = shape.expand_many(t.wells, t.containers, "well_id", ["id", "waste_name"], "container")
    return rows.select("id", "site_id", F.col("container.id").alias("container_id"), "container.waste_name")


FRACTIE = """SELECT w.site_id, c.waste_name AS fractie, count(*) AS containers
    FROM {containers} c JOIN {wells} w ON c.well_id = w.id JOIN {sites} s ON s.id = w.site_id GROUP BY 1, 2"""


def _fractions(t: Tables) -> DataFrame:
    from ..operators.stats import site_fractions
    return site_fractions(t.sites, t.containers, t.wells, t.container_types)


@query("prj_17_fraction_maps", f"""WITH f AS ({FRACTIE}) SELECT s.id, max(CASE WHEN f.fractie = 'Rest' THEN f.containers END) AS rest,
    max(CASE WHEN f.fractie = 'Glas' THEN f.containers END) AS glas FROM {{sites}} s LEFT JOIN f ON f.site_id = s.id GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    rows = shape.fraction_maps(t.sites, _fractions(t))
    return rows.select("id", F.col("fracties.containers")["Rest"].alias("rest"), F.col("fracties.containers")["Glas"].alias("glas"))


@query("prj_18_child_count", """SELECT w.id, count(c.id) AS containers FROM {wells} w
    LEFT JOIN {containers} c ON c.well_id = w.id GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return shape.child_count(t.wells, t.containers, "well_id", "containers").select("id", "containers")


@query("prj_19_public_names", "SELECT id, distance AS distance_to_address FROM {sites}")
def _(t: Tables) -> DataFrame:
    return shape.public_names(t.sites).select("id", "distance_to_address")


@query("prj_20_container_address", """SELECT c.id, w.summary AS address FROM {containers} c
    LEFT JOIN {wells} w ON w.id = c.well_id""")
def _(t: Tables) -> DataFrame:
    return shape.container_address(t.containers, t.wells).select("id", "address")


@query("prj_21_display", "SELECT id, id || '-' || straatnaam || ' ' || huisnummer AS _display FROM {sites}")
def _(t: Tables) -> DataFrame:
    return t.sites.select("id", shape.display("sites").alias("_display"))


@query("prj_21_type_display", "SELECT id, name || ' - ' || volume || 'M3' AS _display FROM {container_types}")
def _(t: Tables) -> DataFrame:
    return t.container_types.select("id", shape.display("container_types").alias("_display"))


# Cleaning functions, each over a whole table.

@query("fn_01_json_value", "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM {events}")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", clean.json_value("props", "$.k", "int").alias("k"))


@query("fn_02_left_text", "SELECT doc_id, left(text, 45) AS head FROM {documents}")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", clean.left_text("text", 45).alias("head"))


@query("fn_03_strip_whitespace", "SELECT doc_id, length(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', '', 'g')) AS n FROM {documents}")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.length(clean.strip_whitespace("text")).alias("n"))


@query("fn_04_remove_blanks", "SELECT p_partkey, replace(p_name, ' ', '') AS name FROM {part}")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", clean.remove_blanks("p_name").alias("name"))


@query("fn_05_snake_keys", "SELECT p_partkey, 'nr_press_strokes_' || lower(p_type) AS key FROM {part}")
def _(t: Tables) -> DataFrame:
    name = F.concat(F.lit("NrPressStrokes"), F.initcap("p_type"))
    keys = clean.snake_keys(F.create_map(name, F.col("p_name")))
    return t.part.select("p_partkey", F.map_keys(keys)[0].alias("key"))


@query("fn_06_safe_int", """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END AS n FROM {customer}""")
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).otherwise(
        F.col("c_name"))
    return t.customer.select("c_custkey", clean.safe_int(text).alias("n"))


@query("fn_07_safe_float", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS v FROM {orders}")
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")).when(
        F.col("o_orderstatus") == "O", F.lit("nan")).otherwise(F.lit(""))
    return t.orders.select("o_orderkey", clean.safe_float(text).alias("v"))


@query("fn_08_combine_date_time", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN
    strftime(o_orderdate, '%Y-%m-%d') || ' 09:17:54' END AS at FROM {orders}""")
def _(t: Tables) -> DataFrame:
    time = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.lit("09:17:54"))
    at = clean.combine_date_time(F.date_format("o_orderdate", "yyyy-MM-dd"), time).alias("at")
    return t.orders.select("o_orderkey", at).select("o_orderkey", _text("at"))


@query("fn_09_drop_bad_date", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM {orders}""")
def _(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderstatus") == "F", day).when(
        F.col("o_orderpriority") < "3", F.concat(F.lit("-0001"), F.substring(day, 5, 6))).when(
        F.col("o_orderpriority") < "4", F.concat(F.lit("0000"), F.substring(day, 5, 6))).otherwise(
        F.concat(F.lit("-1001"), F.substring(day, 5, 6)))
    return t.orders.select("o_orderkey", clean.drop_bad_date(text).alias("day"))


@query("fn_10_waste_name", """SELECT id, CASE active WHEN 1 THEN waste_name WHEN 0 THEN 'Unknown' ELSE 'Unkown' END AS waste_name
    FROM {containers}""")
def _(t: Tables) -> DataFrame:
    return pg.detail_items(landed.container_pages(t)).select("id", clean.waste_name("data").alias("waste_name"))


@query("fn_11_canonical_fraction", """SELECT seq_id, CASE WHEN net_weight < 100 THEN NULL WHEN fractie = 'Kunststof' THEN 'Plastic' ELSE fractie END AS fractie
    FROM {measurements}""")
def _(t: Tables) -> DataFrame:
    known = F.when(F.col("net_weight") >= 100, F.col("fractie"))
    return t.measurements.select("seq_id", clean.canonical_fraction(known).alias("fractie"))


@query("fn_12_weights", """SELECT seq_id, first_weight AS f, second_weight AS s, net_weight AS n,
    second_weight >= 250 AND first_weight >= 250 AS valid FROM {measurements}""")
def _(t: Tables) -> DataFrame:
    w = clean.weights("first_weight", "second_weight", "net_weight")
    return t.measurements.select("seq_id", w["first_weight"].alias("f"), w["second_weight"].alias("s"),
                                 w["net_weight"].alias("n"), w["valid"].alias("valid"))


@query("fn_13_location_ids", "SELECT id, CASE WHEN active = 1 THEN id END AS location_id FROM {wells}")
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("active") == 1, F.col("id").cast("string")).otherwise(F.col("summary"))
    return t.wells.select("id", clean.safe_int(text).alias("location_id"))


@query("fn_15_point_from_text", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS lon FROM {customer}")
def _(t: Tables) -> DataFrame:
    lon = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).otherwise(F.lit("0"))
    return t.customer.select("c_custkey", geo.point_from_text(lon, F.lit("52.1"))["lon"].alias("lon"))


@query("fn_16_wgs84_to_rd", "SELECT id, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM {wells}")
def _(t: Tables) -> DataFrame:
    """There and back again over all wells, to the metre."""
    lonlat = t.wells.select("id", *clean.alias_all(geo.rd_to_wgs84("x", "y")))
    rd = geo.wgs84_to_rd("lon", "lat")
    return lonlat.select("id", F.rint(rd["x_rd"]).cast("bigint").alias("x"), F.rint(rd["y_rd"]).cast("bigint").alias("y"))


@query("fn_17_rd_to_wgs84", "SELECT id, round({lon}, 6) AS lon, round({lat}, 6) AS lat FROM {{wells}}".format(
    **{k: re.sub(r"(?<=\d)D\b", "::DOUBLE", text) for k, text in geo.rd_to_wgs84_sql("x", "y").items()}))
def _(t: Tables) -> DataFrame:
    p = geo.rd_to_wgs84("x", "y")
    return t.wells.select("id", F.round(p["lon"], 6).alias("lon"), F.round(p["lat"], 6).alias("lat"))


@query("fn_18_set_flag", "SELECT id, true AS flagged, 1 AS n FROM {wells}")
def _(t: Tables) -> DataFrame:
    attrs = F.when(F.col("active") == 1, F.create_map(F.lit("in_pand"), F.lit("false"))).otherwise(
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    out = t.wells.select("id", clean.set_flag(attrs, "in_pand").alias("a"))
    return out.select("id", (F.col("a")["in_pand"] == "true").alias("flagged"), F.size("a").alias("n"))


@query("fn_19_chauffeur_attributes", "SELECT id, summary AS chauffeur FROM {wells}")
def _(t: Tables) -> DataFrame:
    return t.wells.select("id", clean.chauffeur_attributes("summary")["chauffeur"].alias("chauffeur"))


@query("fn_20_site_key", """SELECT id, CAST(x AS BIGINT) || '-' || CAST(y AS BIGINT) || '-' || stadsdeel ||
    CASE WHEN active = 1 THEN buurt_code ELSE '' END AS key FROM {wells}""")
def _(t: Tables) -> DataFrame:
    area = F.when(F.col("active") == 1, F.col("buurt_code"))
    return t.wells.select("id", clean.site_key("x", "y", "stadsdeel", area).alias("key"))


@query("fn_21_period_parts", """SELECT l_orderkey, week(l_shipdate) AS week, month(l_shipdate) AS month, year(l_shipdate) AS year
    FROM {lineitem}""")
def _(t: Tables) -> DataFrame:
    parts = clean.period_parts("l_shipdate")
    return t.lineitem.select("l_orderkey", *clean.alias_all(parts))


@query("fn_22_capacity", """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN NULL WHEN p_type = 'PROMO' THEN p_retailprice / 300 / p_size
    ELSE p_retailprice / 100 / p_size END AS capacity FROM {part}""")
def _(t: Tables) -> DataFrame:
    fraction = F.when(F.col("p_type") == "SMALL", F.lit("KCA")).when(F.col("p_type") == "PROMO", F.lit("Glas")).otherwise(F.lit("Rest"))
    return t.part.select("p_partkey", clean.capacity("p_retailprice", "p_size", fraction).alias("capacity"))


@query("fn_23_choice_labels", "SELECT vollcode, naam || ' (' || vollcode || ')' AS label FROM {areas}")
def _(t: Tables) -> DataFrame:
    return t.areas.select("vollcode", clean.choice_label("naam", "vollcode").alias("label")).orderBy("vollcode")


# Feeds as whole plans.

def _register_tables(t: Tables) -> dict[str, DataFrame]:
    """The layers are grown by a centimetre: places come back from degrees to the millimetre."""
    grown = lambda df: df.withColumn("rings", geo.box(F.col("minx") - 0.01, F.col("miny") - 0.01,
                                                      F.col("maxx") + 0.01, F.col("maxy") + 0.01))
    return feeds.register(landed.well_pages(t), landed.container_pages(t), landed.type_pages(t),
                          grown(t.districts), grown(t.areas))


@query("pl_01_register_clean", """SELECT c.id, w.stadsdeel, w.buurt_code, w.summary,
    CASE c.active WHEN 1 THEN c.waste_name WHEN 0 THEN 'Unknown' ELSE 'Unkown' END AS waste_name
    FROM {containers} c JOIN (
        SELECT w.id, w.summary, min(d.code) AS stadsdeel, min(a.vollcode) AS buurt_code FROM {wells} w
        LEFT JOIN {districts} d ON w.x BETWEEN d.minx - 0.01 AND d.maxx + 0.01 AND w.y BETWEEN d.miny AND d.maxy
        LEFT JOIN {areas} a ON w.x BETWEEN a.minx - 0.01 AND a.maxx + 0.01 AND w.y BETWEEN a.miny - 0.01 AND a.maxy + 0.01
        GROUP BY 1, 2) w ON w.id = c.well_id""")
def _(t: Tables) -> DataFrame:
    return _register_tables(t)["container_locations"].select("id", "stadsdeel", "buurt_code", "summary", "waste_name")


@query("pl_01_register_tables", """SELECT 'wells' AS name, w.id, concat_ws('/', w.summary, min(d.code), min(a.vollcode)) AS fields FROM {wells} w
    LEFT JOIN {districts} d ON w.x BETWEEN d.minx - 0.01 AND d.maxx + 0.01 AND w.y BETWEEN d.miny AND d.maxy
    LEFT JOIN {areas} a ON w.x BETWEEN a.minx - 0.01 AND a.maxx + 0.01 AND w.y BETWEEN a.miny - 0.01 AND a.maxy + 0.01
    GROUP BY w.id, w.summary
    UNION ALL SELECT 'containers', c.id, concat_ws('/', w.id, c.container_type_id,
        CASE c.active WHEN 1 THEN c.waste_name WHEN 0 THEN 'Unknown' ELSE 'Unkown' END)
        FROM {containers} c LEFT JOIN {wells} w ON w.id = c.well_id
    UNION ALL SELECT 'container_types', id, concat_ws('/', name, volume, weight) FROM {container_types}""")
def _(t: Tables) -> DataFrame:
    """The other three tables of one load."""
    tables = _register_tables(t)
    fields = {"wells": ("summary", "stadsdeel", "buurt_code"), "containers": ("well_id", "container_type_id", "waste_name"),
              "container_types": ("name", "volume", "weight")}
    rows = [tables[name].select(F.lit(name).alias("name"), "id", F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("fields"))
            for name, columns in fields.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


FIRST_LOAD = """WITH p AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS last FROM {lineitem} WHERE l_tax <> 0 GROUP BY 1, 2),
    q AS (SELECT l_linenumber, last, min(l_orderkey) AS l_orderkey FROM p GROUP BY 1, 2)
    SELECT i.l_orderkey AS seq_id, i.l_linenumber AS system_id, i.l_suppkey AS site_id
    FROM {lineitem} i JOIN q ON q.l_orderkey = i.l_orderkey AND q.l_linenumber = i.l_linenumber WHERE i.l_tax <> 0"""


@query("pl_04_weigh_feed_first", FIRST_LOAD)
def _(t: Tables) -> DataFrame:
    """First load of all pages; undated records are left out of the measurements."""
    none = t.spark.createDataFrame([], "system_id bigint, weigh_at timestamp")
    records = t.lineitem.count()
    return feeds.weighings(cut(landed.weigh_pages(t)), none, t.districts, t.areas, most_errors=records).select("seq_id", "system_id", "site_id")


@query("pl_04_weigh_feed", f"SELECT * FROM ({FIRST_LOAD}) WHERE system_id > 3")
def _(t: Tables) -> DataFrame:
    """A second load, when three of the systems are stored already, finds the others only."""
    pages = cut(landed.weigh_pages(t))  # landed once, read by both loads
    stored = pg.weigh_raw(pages).filter("system_id <= 3")
    return feeds.weighings(pages, stored, t.districts, t.areas).select("seq_id", "system_id", "site_id")


@query("pl_06_sensor_feed", STATES)
def _(t: Tables) -> DataFrame:
    none = t.states.filter("filling > 1000")
    return _state_columns(feeds.sensor_feed(landed.sensor_snapshots(t), landed.known_id_pages(t), none))


@query("weigh_page_errors", "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, 'CustId' AS missing FROM {lineitem}")
def _(t: Tables) -> DataFrame:
    broken = landed.weigh_pages(t).withColumn("data", F.regexp_replace("data", '"CustId"', '"Client"'))
    return pg.weigh_page_errors(broken)


@query("jn_27_sensor_sites", f"""SELECT s.id, k.id_number IS NOT NULL AS valid, k.short_id
    FROM {{states}} s LEFT JOIN ({KNOWN}) k ON k.id_number = s.description""")
def _(t: Tables) -> DataFrame:
    known = pg.known_container_ids(landed.known_id_pages(t))
    return links.sensor_sites(t.states.drop("valid", "short_id"), known).select("id", "valid", "short_id")
