"""Equality links, list filters, writers and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sinks
from ..functions import geo
from ..operators import checks, filters as fl, links, lists, service, sites as st, spatial
from ..session import work_path
from ..sources import pages as pg
from ..streaming import latest, live
from . import landed
from .feed_queries import FIRST_LOAD, KNOWN, LEVELS, STATES, _state_columns, _text
from .map_queries import SUPPLIER
from .registry import Tables, query

CLAIMS = """SELECT id AS container, well_id FROM {containers} WHERE well_id IS NOT NULL
    UNION ALL SELECT id, well_id - 1 FROM {containers} WHERE active = 1 AND well_id > 0"""


@query("jn_01_containers_to_wells", f"""SELECT c.id, min(l.well_id) AS well_id FROM {{containers}} c
    LEFT JOIN ({CLAIMS}) l ON l.container = c.id GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    """Active containers are claimed by two wells."""
    mine = t.containers.filter("well_id is not null").select("well_id", "id")
    also = t.containers.filter("active = 1 and well_id > 0").select((F.col("well_id") - 1).alias("well_id"), "id")
    lists = mine.unionByName(also).groupBy(F.col("well_id").alias("id")).agg(
        F.array_sort(F.collect_list("id")).alias("containers_bron"))
    return links.containers_to_wells(t.wells.select("id").join(lists, "id"), t.containers).select("id", "well_id")


@query("jn_02_container_locations", """SELECT c.id, c.waste_name, w.stadsdeel, w.summary, w.x FROM {containers} c
    JOIN {wells} w ON w.id = c.well_id""")
def _(t: Tables) -> DataFrame:
    return links.container_locations(t.containers, t.wells).select("id", "waste_name", "stadsdeel", "summary", "x")


@query("snk_03_container_view", """SELECT c.id, w.buurt_code FROM {containers} c JOIN {wells} w ON w.id = c.well_id""")
def _(t: Tables) -> DataFrame:
    return sinks.replace_view(links.container_locations(t.containers, t.wells), "container_locations").select("id", "buurt_code")


@query("jn_14_sites_with_wells", "SELECT id FROM {sites} WHERE id IN (SELECT site_id FROM {wells} WHERE active = 2)")
def _(t: Tables) -> DataFrame:
    return links.sites_with_wells(t.sites, t.wells.filter("active = 2")).select("id")


@query("jn_31_slot_links", """SELECT o_orderkey AS id, CASE WHEN o_custkey * 2 IN (SELECT c_custkey FROM {customer}) THEN o_custkey * 2 END AS site_id,
    CASE WHEN o_orderkey * 2 IN (SELECT o_orderkey FROM {orders}) THEN o_orderkey * 2 END AS site_content_type_id FROM {orders}""")
def _(t: Tables) -> DataFrame:
    slots = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") * 2).alias("site_fk"),
                            (F.col("o_orderkey") * 2).alias("site_content_type_fk"))
    content = t.orders.select(F.col("o_orderkey").alias("id"))
    return links.slot_links(slots, t.wells, content).select("id", "site_id", "site_content_type_id")


KEYS = "SELECT id, CASE WHEN active <> 2 THEN 'RE' || id * 5 END AS customer_key FROM {wells}"


def _keys(t: Tables) -> DataFrame:
    key = F.when(F.col("active") != 2, F.concat(F.lit("RE"), (F.col("id") * 5).cast("string")))
    return t.wells.select("id", key.alias("customer_key"))


@query("jn_32_register_validity", f"""SELECT k.id, CASE WHEN k.customer_key IN (SELECT id_number FROM {{containers}}) THEN true
    WHEN k.customer_key NOT IN (SELECT id_number FROM {{containers}}) THEN false END AS valid FROM ({KEYS}) k""")
def _(t: Tables) -> DataFrame:
    return links.register_validity(_keys(t), t.containers).select("id", "valid")


@query("jn_32_register_validity_without_nulls", f"""SELECT k.id, k.customer_key IN (SELECT id_number FROM {{containers}}
    WHERE id_number IS NOT NULL) AS valid FROM ({KEYS}) k""")
def _(t: Tables) -> DataFrame:
    return links.register_validity(_keys(t), t.containers.filter("id_number is not null")).select("id", "valid")


@query("jn_33_sites_with_type_term", """SELECT DISTINCT s.id, s.short_id FROM {sites} s JOIN {wells} w ON w.site_id = s.id
    JOIN {containers} c ON c.well_id = w.id JOIN {container_types} t ON t.id = c.container_type_id WHERE lower(t.name) LIKE '%ring%'""")
def _(t: Tables) -> DataFrame:
    keyed = t.sites.select("id", "short_id")
    return keyed.join(links.sites_with_type_term("Ring", t.container_types, t.containers, t.wells, keyed.withColumn(
        "short_id", F.col("id"))).withColumnRenamed("short_id", "id"), "id", "left_semi")


@query("jn_34_lonely_wells", """SELECT w.id AS well_id, c.id AS container_id FROM {wells} w JOIN {containers} c ON c.well_id = w.id
    WHERE w.id NOT IN (SELECT p.id FROM {wells} p JOIN {buildings} b ON p.x > b.minx AND p.x < b.maxx AND p.y > b.miny AND p.y < b.maxy)""")
def _(t: Tables) -> DataFrame:
    matched = service.wells_with_buildings(t.wells.select("id", "x", "y"), t.buildings).select(F.col("id").alias("well_id"))
    return links.lonely_wells(t.wells, matched, t.containers).select("well_id", "container_id")


# List filters.

@query("fil_01_containers", "SELECT id FROM {containers} WHERE active < 2 AND waste_name = 'Glas'")
def _(t: Tables) -> DataFrame:
    return fl.apply_filters(t.containers, {"active__lt": 2, "waste_name": "Glas"}, fl.FILTERS["containers"]).select("id")


@query("fil_01_containers_by_area", """SELECT c.id FROM {containers} c JOIN {wells} w ON w.id = c.well_id
    WHERE w.stadsdeel = 'A' AND c.active < 2""")
def _(t: Tables) -> DataFrame:
    """District and neighbourhood of a container are those of its well."""
    rows = fl.with_well_area(t.containers, t.wells)
    return fl.apply_filters(rows, {"stadsdeel": "A", "active__lt": 2}, fl.FILTERS["containers"]).select("id")


@query("fil_01_measurements", "SELECT seq_id, net_weight FROM {measurements} WHERE fractie = 'Rest' AND valid")
def _(t: Tables) -> DataFrame:
    return fl.apply_filters(t.measurements, {"fractie": "Rest", "valid": True}, fl.FILTERS["measurements"]).select(
        "seq_id", "net_weight")


@query("fil_01_sensor_states", "SELECT id FROM {states} WHERE filling > 50 AND filling < 90 AND valid")
def _(t: Tables) -> DataFrame:
    return fl.apply_filters(t.states, {"filling__gt": 50, "filling__lt": 90, "valid": True}, fl.FILTERS["sensor_states"]).select("id")


@query("fil_02_choice", "SELECT id FROM {containers} WHERE waste_name = 'Papier'")
def _(t: Tables) -> DataFrame:
    return fl.choice(t.containers, "waste_name", "Papier", fl.WASTE_CHOICES).select("id")


@query("fil_02_choice_in_table", "SELECT seq_id FROM {measurements} WHERE fractie = 'Glas'")
def _(t: Tables) -> DataFrame:
    return fl.choice_in(t.measurements, "fractie", "Glas", t.measurements, "fractie").select("seq_id")


@query("fil_03_id_contains", "SELECT id FROM {containers} WHERE contains(id_number, '99')")
def _(t: Tables) -> DataFrame:
    return fl.id_contains(t.containers, "99").select("id")


@query("fil_04_id_equals", "SELECT id FROM {containers} WHERE id_number = 'RE77'")
def _(t: Tables) -> DataFrame:
    return fl.id_equals(t.containers, " RE 7\t7").select("id")


BOX = (481000.0, 116000.0, 483000.0, 118500.0)
IN_BOX = "x BETWEEN 116000 AND 118500 AND y BETWEEN 481000 AND 483000"


@query("fil_05_wells_in_bbox", f"SELECT id FROM {{wells}} WHERE {IN_BOX}")
def _(t: Tables) -> DataFrame:
    return fl.in_bbox(t.wells, BOX).select("id")


@query("fil_05_containers_in_bbox", f"SELECT id FROM {{containers}} WHERE well_id IN (SELECT id FROM {{wells}} WHERE {IN_BOX})")
def _(t: Tables) -> DataFrame:
    return fl.via(t.containers, "well_id", fl.in_bbox(t.wells, BOX)).select("id")


@query("fil_05_sites_in_bbox", """SELECT id FROM {site_boxes} WHERE minx <= 118500 AND maxx >= 116000 AND miny <= 483000 AND maxy >= 481000""")
def _(t: Tables) -> DataFrame:
    return fl.polygon_in_bbox(t.site_boxes, BOX).select("id")


@query("fil_06_within_radius", """SELECT seq_id FROM {measurements}
    WHERE (x - 117000) * (x - 117000) + (y - 482000) * (y - 482000) <= 490000""")
def _(t: Tables) -> DataFrame:
    return fl.within_radius(t.measurements, *fl.parse_xyr("117000,482000,700")).select("seq_id")


@query("fil_07_containers_without_well", "SELECT id FROM {containers} WHERE well_id IS NULL")
def _(t: Tables) -> DataFrame:
    return fl.containers_without_well(t.containers).select("id")


@query("fil_07_containers_without_site", """SELECT c.id FROM {containers} c LEFT JOIN {wells} w ON w.id = c.well_id
    WHERE w.site_id IS NULL""")
def _(t: Tables) -> DataFrame:
    return fl.containers_without_site(t.containers, t.wells).select("id")


@query("fil_07_wells_without_container", """SELECT id FROM {wells} WHERE id NOT IN (SELECT well_id FROM {containers}
    WHERE well_id IS NOT NULL AND waste_name = 'Glas')""")
def _(t: Tables) -> DataFrame:
    return fl.wells_without_container(t.wells, t.containers.filter("waste_name = 'Glas'")).select("id")


@query("fil_07_sites_without_short_id", "SELECT id FROM {sites} WHERE short_id IS NULL")
def _(t: Tables) -> DataFrame:
    return fl.sites_without_short_id(t.sites).select("id")


@query("fil_08_sites_with_empty_well", """SELECT s.id FROM {sites} s LEFT JOIN {wells} w ON w.site_id = s.id
    LEFT JOIN (SELECT DISTINCT well_id FROM {containers} WHERE waste_name = 'Glas') c ON c.well_id = w.id WHERE c.well_id IS NULL""")
def _(t: Tables) -> DataFrame:
    return fl.sites_with_empty_well(t.sites, t.wells, t.containers.filter("waste_name = 'Glas'")).select("id")


@query("fil_09_malformed_ids", """SELECT id FROM {containers} WHERE length(id_number) > 10 OR length(id_number) < 4
    OR (id_number IS NULL AND active = 1)""")
def _(t: Tables) -> DataFrame:
    return fl.malformed_ids(t.containers).select("id")


@query("fil_10_with_flag", "SELECT id FROM {wells} p WHERE EXISTS (SELECT 1 FROM {buildings} b WHERE p.x > b.minx AND p.x < b.maxx AND p.y > b.miny AND p.y < b.maxy)")
def _(t: Tables) -> DataFrame:
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    flagged = service.wells_in_buildings(t.wells.withColumn("extra_attributes", empty), t.buildings)
    return fl.with_flag(flagged, "in_pand", True).select("id")


@query("fil_11_sites_with_fraction", """SELECT id FROM {sites} WHERE id IN (SELECT w.site_id FROM {wells} w JOIN {containers} c
    ON c.well_id = w.id WHERE c.waste_name = 'Glas' AND w.active = 2)""")
def _(t: Tables) -> DataFrame:
    return fl.sites_with_container(t.sites, t.wells.filter("active = 2"), t.containers, F.col("waste_name") == "Glas").select("id")


@query("fil_12_containers_by_volume", """SELECT c.id FROM {containers} c JOIN {container_types} t ON t.id = c.container_type_id
    WHERE t.volume > 4.5""")
def _(t: Tables) -> DataFrame:
    return fl.by_type(t.containers, t.container_types, "volume", "gt", 4.5).select("id")


@query("fil_12_sites_by_weight", """SELECT s.id FROM {sites} s JOIN {wells} w ON w.site_id = s.id JOIN {containers} c ON c.well_id = w.id
    JOIN {container_types} t ON t.id = c.container_type_id WHERE t.weight < 10""")
def _(t: Tables) -> DataFrame:
    return fl.sites_by_type(t.sites, t.wells, t.containers, t.container_types, "weight", "lt", 10).select("id")


def _register(t: Tables) -> lists.Register:
    return lists.Register(t.containers, t.wells, t.container_types, t.site_boxes)


@query("fil_11_sites_with_type", """SELECT id FROM {site_boxes} WHERE id IN (SELECT w.site_id FROM {wells} w JOIN {containers} c
    ON c.well_id = w.id JOIN {container_types} k ON k.id = c.container_type_id WHERE k.name = (SELECT min(name) FROM {container_types}))""")
def _(t: Tables) -> DataFrame:
    name = t.container_types.agg(F.min("name")).first()[0]
    return lists.related("sites", _register(t), {"container_type": name}).select("id")


@query("fil_01_container_list", f"""SELECT id, waste_name FROM {{containers}} WHERE active < 2
    AND well_id IN (SELECT id FROM {{wells}} WHERE stadsdeel = 'A' AND site_id IS NULL)
    AND well_id IN (SELECT id FROM {{wells}} WHERE {IN_BOX})
    AND container_type_id IN (SELECT id FROM {{container_types}} WHERE volume > 0.5)""")
def _(t: Tables) -> DataFrame:
    """Filters on the container, its well, the well's place and site, and its type, in one list."""
    params = {"active__lt": 2, "well__stadsdeel": "A", "no_site": True, "in_bbox": BOX, "container_type__volume__gt": 0.5}
    return lists.related("containers", _register(t), params).select("id", "waste_name")


@query("fil_01_container_page", """SELECT id, waste_name FROM {containers} WHERE waste_name = 'Glas'
    AND well_id IN (SELECT id FROM {wells} WHERE stadsdeel = 'A') ORDER BY id DESC LIMIT 30 OFFSET 30""")
def _(t: Tables) -> DataFrame:
    return lists.related_page("containers", _register(t), {"waste_name": "Glas", "well__stadsdeel": "A", "detailed": True},
                              "id,waste_name", None, "-id", 2, 30)


@query("fil_01_well_list", f"""SELECT id FROM {{wells}} WHERE {IN_BOX} AND stadsdeel = 'A'""")
def _(t: Tables) -> DataFrame:
    return lists.related("wells", _register(t), {"in_bbox": BOX, "stadsdeel": "A"}).select("id")


@query("fil_01_site_list", """SELECT s.id, count(*) AS n FROM {site_boxes} s JOIN {wells} w ON w.site_id = s.id
    JOIN {containers} c ON c.well_id = w.id JOIN {container_types} t ON t.id = c.container_type_id
    WHERE t.volume > 1 AND minx <= 118500 AND maxx >= 116000 AND miny <= 483000 AND maxy >= 481000 GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    """A site is listed once per container whose type meets the filter."""
    params = {"in_bbox": "481000,116000,483000,118500", "wells__containers__container_type__volume__gt": 1}
    return lists.related("sites", _register(t), params).groupBy("id").agg(F.count("*").alias("n"))


@query("fil_01_site_list_once", """SELECT id, 1 AS n FROM {site_boxes} WHERE id IN (SELECT w.site_id FROM {wells} w
    JOIN {containers} c ON c.well_id = w.id WHERE c.waste_name = 'Glas') AND id IN (SELECT w.site_id FROM {wells} w
    JOIN {containers} c ON c.well_id = w.id JOIN {container_types} t ON t.id = c.container_type_id WHERE t.weight < 30)""")
def _(t: Tables) -> DataFrame:
    """With a filter on the fraction, a site is listed once."""
    params = {"fractie": "Glas", "wells__containers__container_type__weight__lt": 30}
    return lists.related("sites", _register(t), params).groupBy("id").agg(F.count("*").alias("n"))


@query("fil_13_search_names", "SELECT id FROM {container_types} WHERE lower(name) LIKE '%re%' AND lower(name) LIKE '%ring%'")
def _(t: Tables) -> DataFrame:
    return fl.search_names(t.container_types, "RE ring").select("id")


def _at(t: Tables, fn) -> DataFrame:
    now = t.states.agg(F.max("communication_date_time").alias("now"))
    return fn(t.states.crossJoin(F.broadcast(now)), F.col("now")).select("id")  # one row


@query("fil_14_last_days", """SELECT id FROM {states} WHERE communication_date_time >
    (SELECT max(communication_date_time) FROM {states}) - INTERVAL 7 DAY""")
def _(t: Tables) -> DataFrame:
    return _at(t, lambda states, now: fl.last_days(states, 7, now))


@query("fil_15_full_today", """SELECT id FROM {states} WHERE filling > 90 AND communication_date_time >
    (SELECT max(communication_date_time) FROM {states}) - INTERVAL 1 DAY""")
def _(t: Tables) -> DataFrame:
    return _at(t, fl.full_today)


@query("fil_16_weighed_between", """SELECT seq_id FROM {measurements} WHERE weigh_at > TIMESTAMP '1996-01-01'
    AND weigh_at < TIMESTAMP '1997-01-01' AND valid""")
def _(t: Tables) -> DataFrame:
    return fl.weighed_between(t.measurements, "1996-01-01", "1997-01-01").select("seq_id")


@query("fil_17_in_register", f"SELECT id FROM ({KEYS}) WHERE customer_key IN (SELECT id_number FROM {{containers}})")
def _(t: Tables) -> DataFrame:
    return fl.in_register(links.register_validity(_keys(t), t.containers), True).select("id")


@query("fil_18_no_site", f"SELECT id FROM ({SUPPLIER}) WHERE site_id IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return fl.no_site(st.supplier_sites(t.supplier_points, t.site_boxes), True).select("id")


@query("fil_19_usable_wells", """SELECT id FROM {wells} WHERE active = 1 AND id IN (SELECT well_id FROM {containers})""")
def _(t: Tables) -> DataFrame:
    return links.usable_wells(t.wells, t.containers).select("id")


# Writers; each query reads back what it wrote.

@query("snk_01_full_refresh", "SELECT id, waste_name FROM {containers}")
def _(t: Tables) -> DataFrame:
    """Three loads; the last reads the table that it replaces."""
    path = work_path(t.spark, "refresh")
    closed = F.col("active") == 0
    sinks.full_refresh(t.containers.filter(closed).select("id", "waste_name"), path)
    sinks.full_refresh(t.containers.filter(~closed).select("id", "waste_name"), path)
    kept = sinks.published(t.spark, path)
    sinks.full_refresh(kept.unionByName(t.containers.filter(F.coalesce(closed, F.lit(True))).select("id", "waste_name")), path)
    return sinks.published(t.spark, path)


@query("snk_01_several_tables", """SELECT 'containers' AS name, count(*) AS n FROM {containers} UNION ALL
    SELECT 'wells', count(*) FROM {wells}""")
def _(t: Tables) -> DataFrame:
    """Two tables published together, their counts checked while they are written."""
    path = work_path(t.spark, "refresh")
    tables = {name: getattr(t, name).select("id") for name in ("containers", "wells")}
    done = sinks.publish(t.spark, path, tables, {name: [checks.at_least(1)] for name in tables})
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in done.items()]
    return counts[0].unionByName(counts[1])


@query("snk_02_append_history", "SELECT id FROM {states} UNION ALL SELECT id FROM {states}")
def _(t: Tables) -> DataFrame:
    path = work_path(t.spark, "history")
    sinks.append_history(t.states.select("id"), path)
    return sinks.append_history(t.states.select("id"), path)


def _exported(t: Tables, kind: str) -> DataFrame:
    path = work_path(t.spark, f"export-{kind}")
    sinks.export(t.sites.select("id", "huisnummer"), path, kind)
    return sinks.read_export(t.spark, path, kind, "id string, huisnummer bigint")


@query("snk_04_export_json", "SELECT id, huisnummer FROM {sites}")
def _(t: Tables) -> DataFrame:
    return _exported(t, "json")


@query("snk_04_export_csv", "SELECT id, huisnummer FROM {sites}")
def _(t: Tables) -> DataFrame:
    return _exported(t, "csv")


@query("snk_04_export_xml", "SELECT id, huisnummer FROM {sites}")
def _(t: Tables) -> DataFrame:
    return _exported(t, "xml")


@query("snk_05_csv_per_site", """SELECT s.short_id, m.seq_id, m.net_weight FROM {measurements} m JOIN {sites} s
    ON m.x BETWEEN s.x - 17 AND s.x + 17 AND m.y BETWEEN s.y - 17 AND s.y + 17
    WHERE (m.x - s.x) * (m.x - s.x) + (m.y - s.y) * (m.y - s.y) <= 289 AND s.short_id IS NOT NULL""")
def _(t: Tables) -> DataFrame:
    path = work_path(t.spark, "per-site")
    rows = service.weighings_at_sites(t.sites.filter("short_id is not null"), t.measurements)
    sinks.csv_per_site(rows.select("short_id", "seq_id", "net_weight"), path, 4)
    return t.spark.read.schema("seq_id bigint, net_weight bigint, short_id bigint").option("header", True).csv(path)


@query("snk_06_staged_snapshots", """SELECT stage, strftime(day, '%Y-%m-%d') AS day, count(*) AS n FROM {wells}, (
    SELECT 'raw' AS stage, DATE '2024-01-20' AS day UNION ALL SELECT 'cleaned', DATE '2024-01-31') GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    path = work_path(t.spark, "stages")
    rows = t.wells.select("id")
    for stage, day in (("raw", "2023-12-31"), ("raw", "2024-01-20"), ("cleaned", "2024-01-31"), ("cleaned", "2024-01-31")):
        sinks.write_snapshot(rows, path, stage, day)
    kept = sinks.kept_snapshots(t.spark, path, "2024-02-01")
    return kept.groupBy("stage", F.date_format("snapshot_date", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("snk_06_expired_snapshots", """SELECT 'cleaned' AS stage, '2024-01-31' AS day, count(*) AS n FROM {containers}""")
def _(t: Tables) -> DataFrame:
    """What is left when all older snapshots have been deleted, read without a filter."""
    path = work_path(t.spark, "stages")
    for stage, day in (("raw", "2023-12-31"), ("raw", "2024-01-10"), ("cleaned", "2024-01-31")):
        sinks.write_snapshot(t.containers.select("id"), path, stage, day)
    sinks.expire_snapshots(t.spark, path, "2024-02-01")
    left = t.spark.read.parquet(path)
    return left.groupBy("stage", F.date_format("snapshot_date", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


# Streams over landed pages; each query reads the finished table.

def _landed(t: Tables, pages: DataFrame, name: str, files: int = 64) -> DataFrame:
    """A stream of all pages in one batch; the files are as many as the tasks that make them, `files` at most."""
    path = work_path(t.spark, f"landed-{name}")
    pages.select("id", "scraped_at", "data").coalesce(files).write.option("compression", "gzip").json(path)
    return live.page_stream(t.spark, path)


@query("str_01_sensor_stream", STATES)
def _(t: Tables) -> DataFrame:
    stream = _landed(t, landed.sensor_snapshots(t), "states")
    out, marks = work_path(t.spark, "states"), work_path(t.spark, "marks")
    live.sensor_states(stream, pg.known_container_ids(landed.known_id_pages(t)), out, marks).awaitTermination()
    return _state_columns(t.spark.read.parquet(out))


@query("str_02_fill_level_stream", f"""WITH s AS ({SUPPLIER}), l AS ({LEVELS})
    SELECT l.time, l.fill_level, l.e_site_name, s.site_id FROM l LEFT JOIN s ON s.name = l.e_site_name""")
def _(t: Tables) -> DataFrame:
    linked = st.supplier_sites(t.supplier_points, t.site_boxes)
    names = linked.groupBy(F.col("name").alias("e_site_name")).agg(F.min("site_id").alias("site_id"))
    stream = _landed(t, landed.collection_pages(t, "fill_levels"), "levels")
    out, marks = work_path(t.spark, "levels"), work_path(t.spark, "marks")
    live.fill_levels(stream, names, out, marks).awaitTermination()
    return t.spark.read.parquet(out).select(_text("time"), "fill_level", "e_site_name", "site_id")


@query("str_03_weigh_stream", FIRST_LOAD)
def _(t: Tables) -> DataFrame:
    """All pages come in one batch; a second run of the stream finds none."""
    stream = _landed(t, landed.weigh_pages(t), "weighings")
    out, marks = work_path(t.spark, "weighings"), work_path(t.spark, "marks")
    for _run in range(2):
        live.weighings(stream, t.districts, t.areas, out, marks).awaitTermination()
    return t.spark.read.parquet(out).select("seq_id", "system_id", "site_id")


LATEST = ("scraped_at", ["id"])


@query("str_04_latest_per_container", """SELECT strftime(max(scraped_at), '%Y-%m-%d %H:%M:%S') AS scraped_at, description,
    arg_max(id, (scraped_at, id)) AS id FROM {states} GROUP BY description""")
def _(t: Tables) -> DataFrame:
    """The states come in several batches and in any order; each container has one row of state."""
    path = _latest_states(t, t.states.repartition(4, "id"), None)
    return latest.stored_states(t.spark, path, *LATEST).select(_text("scraped_at"), "description", "id")


@query("str_04_last_hour", """SELECT description, arg_max(id, (scraped_at, id)) AS id FROM {states}
    WHERE scraped_at > (SELECT max(scraped_at) - INTERVAL 1 HOUR FROM {states}) GROUP BY description""")
def _(t: Tables) -> DataFrame:
    """Containers not seen for an hour leave the state; states that come later than that are dropped."""
    now = t.states.agg(F.max("scraped_at")).first()[0]
    path = _latest_states(t, t.states.repartition(4, "id"), "1 hour")
    return latest.within_last_hour(t.spark, path, F.lit(now), *LATEST).select("description", "id")


def _latest_states(t: Tables, rows: DataFrame, reach: str | None) -> str:
    source, out, marks = (work_path(t.spark, n) for n in ("states-in", "states-out", "marks"))
    rows.write.parquet(source)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
    latest.latest_states(stream, *LATEST, out, marks, reach=reach).awaitTermination()
    return out
