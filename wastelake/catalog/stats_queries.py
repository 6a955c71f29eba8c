"""Statistics, checks, windows, order and table changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import corrected_press_weights
from ..operators import checks, links, merge, paging, skew, states as st, stats
from ..plans import feeds
from ..session import work_path
from .registry import Tables, query

EXACT_SPREAD = """
       sum(net_weight) AS sum, min(net_weight) AS min, max(net_weight) AS max, count(*) AS measurements,
       ceil(sum(net_weight) / count(net_weight)) AS avg,
       CASE WHEN count(*) > 1 THEN ceil(sqrt(CAST(count(*) * sum(net_weight * net_weight) - sum(net_weight) * sum(net_weight) AS DOUBLE)
            / (count(*) * (count(*) - 1)))) END AS stddev"""


def _site_sql(period: str) -> str:
    return f"""SELECT site_id, fractie, {period}(weigh_at) AS {period}, year(weigh_at) AS year, {EXACT_SPREAD}
        FROM {{measurements}} JOIN {{sites}} s ON site_id = s.short_id WHERE valid GROUP BY 1, 2, 3, 4"""


def _area_sql(period: str) -> str:
    return f"""SELECT s.stadsdeel || s.buurt_code AS buurt_code, fractie, {period}(weigh_at) AS {period},
        year(weigh_at) AS year, {EXACT_SPREAD}
        FROM {{measurements}} JOIN {{sites}} s ON site_id = s.short_id WHERE valid GROUP BY 1, 2, 3, 4"""


FRACTIONS = """SELECT w.site_id, c.waste_name AS fractie, count(*) AS containers, sum(t.volume) AS volume_m3
    FROM {containers} c JOIN {wells} w ON c.well_id = w.id JOIN {container_types} t ON t.id = c.container_type_id
    JOIN {sites} s ON s.id = w.site_id GROUP BY 1, 2"""

AREA_COUNTS = """SELECT w.buurt_code, c.waste_name AS fractie, count(*) AS containers
    FROM {containers} c JOIN {wells} w ON c.well_id = w.id JOIN {areas} b ON b.vollcode = w.buurt_code GROUP BY 1, 2"""


def _capacity_sql(period: str) -> str:
    return f"""WITH k AS ({_site_sql(period)}), f AS ({FRACTIONS}), v AS (
        SELECT s.short_id, f.fractie, f.containers, CAST(round(f.volume_m3) AS BIGINT) AS volume
        FROM f JOIN {{sites}} s ON s.id = f.site_id)
        SELECT k.*, v.volume, v.containers,
               CASE WHEN k.sum > 0 AND v.volume > 0 THEN CAST(k.sum AS DOUBLE) / CASE k.fractie WHEN 'Rest' THEN 100
                    WHEN 'Papier' THEN 70 WHEN 'Glas' THEN 300 WHEN 'Kunststof' THEN 25 END / v.volume END AS capacity
        FROM k LEFT JOIN v ON v.short_id = k.site_id
             AND v.fractie = CASE k.fractie WHEN 'Kunststof' THEN 'Plastic' ELSE k.fractie END"""


def _fractions(t: Tables) -> DataFrame:
    return stats.site_fractions(t.sites, t.containers, t.wells, t.container_types)


@query("ag_01_site_week", _site_sql("week"))
def _(t: Tables) -> DataFrame:
    return stats.site_stats(t.measurements, t.sites, "week")


@query("ag_02_site_month", _site_sql("month"))
def _(t: Tables) -> DataFrame:
    return stats.site_stats(t.measurements, t.sites, "month")


@query("ag_03_area_week", _area_sql("week"))
def _(t: Tables) -> DataFrame:
    return stats.area_stats(t.measurements, t.sites, "week")


@query("ag_04_area_month", _area_sql("month"))
def _(t: Tables) -> DataFrame:
    return stats.area_stats(t.measurements, t.sites, "month")


@query("ag_05_site_fractions", FRACTIONS)
def _(t: Tables) -> DataFrame:
    return _fractions(t)


@query("ag_06_area_container_counts", f"""WITH k AS ({_area_sql('month')}), c AS ({AREA_COUNTS})
    SELECT k.buurt_code, k.fractie, k.month, k.year, k.measurements, c.containers FROM k LEFT JOIN c
      ON c.buurt_code = k.buurt_code AND c.fractie = CASE k.fractie WHEN 'Kunststof' THEN 'Plastic' ELSE k.fractie END""")
def _(t: Tables) -> DataFrame:
    counts = stats.area_container_counts(t.wells, t.containers, t.areas)
    return stats.add_area_counts(stats.area_stats(t.measurements, t.sites, "month"), counts).select(
        "buurt_code", "fractie", "month", "year", "measurements", "containers")


@query("ag_09_distinct_fractions", "SELECT DISTINCT fractie FROM {measurements}")
def _(t: Tables) -> DataFrame:
    return stats.distinct_values(t.measurements, "fractie")


@query("ag_10_minimum_counts", """
    SELECT 'wells' AS "check", count(*) AS n, 1000 AS target, count(*) >= 1000 AS ok FROM {wells}
    UNION ALL SELECT 'containers', count(*), 1000000000, count(*) >= 1000000000 FROM {containers}
    UNION ALL SELECT 'container_types', count(*), 200, count(*) >= 200 FROM {container_types}""")
def _(t: Tables) -> DataFrame:
    return checks.minimum_counts({
        "wells": (t.wells, 1000), "containers": (t.containers, 10 ** 9), "container_types": (t.container_types, 200)})


@query("ag_11_range_checks", """
    WITH c AS (SELECT count(*) FILTER (site_id IS NULL) AS a, count(*) FILTER (active = 1) AS b,
                      count(*) FILTER (stadsdeel = 'N') AS d FROM {wells})
    SELECT 'well_without_site' AS "check", a AS n, 0 AS low, 315 AS high, a BETWEEN 0 AND 315 AS ok FROM c
    UNION ALL SELECT 'active', b, 1, 1000000, b BETWEEN 1 AND 1000000 FROM c
    UNION ALL SELECT 'north', d, 5, 10, d BETWEEN 5 AND 10 FROM c""")
def _(t: Tables) -> DataFrame:
    return checks.range_checks(t.wells, {
        "well_without_site": (F.col("site_id").isNull(), 0, 315),
        "active": (F.col("active") == 1, 1, 1_000_000),
        "north": (F.col("stadsdeel") == "N", 5, 10)})


@query("ag_12_health", "SELECT count(*) AS n, count(*) >= 20000 AS healthy FROM {containers}")
def _(t: Tables) -> DataFrame:
    return checks.health(t.containers)


@query("ag_13_site_week_capacity", _capacity_sql("week"))
def _(t: Tables) -> DataFrame:
    return stats.all_statistics(t.measurements, t.sites, _fractions(t), t.population)["site_week"]


@query("ag_13_site_month_capacity", _capacity_sql("month"))
def _(t: Tables) -> DataFrame:
    return stats.all_statistics(t.measurements, t.sites, _fractions(t), t.population)["site_month"]


@query("jn_24_measurements_at_sites", """SELECT m.seq_id, m.site_id, m.net_weight, s.straatnaam
    FROM {measurements} m JOIN {sites} s ON m.site_id = s.short_id""")
def _(t: Tables) -> DataFrame:
    return links.measurements_at_sites(t.measurements, t.sites, ["straatnaam"]).select(
        "seq_id", "site_id", "net_weight", "straatnaam")


@query("jn_25_site_volumes", f"""WITH k AS ({_site_sql('month')}), f AS ({FRACTIONS})
    SELECT k.site_id, k.fractie, k.month, k.year, CAST(round(f.volume_m3) AS BIGINT) AS volume, f.containers
    FROM k JOIN {{sites}} s ON s.short_id = k.site_id LEFT JOIN f ON f.site_id = s.id
      AND f.fractie = CASE k.fractie WHEN 'Kunststof' THEN 'Plastic' ELSE k.fractie END""")
def _(t: Tables) -> DataFrame:
    return stats.add_site_volumes(stats.site_stats(t.measurements, t.sites, "month"), _fractions(t), t.sites).select(
        "site_id", "fractie", "month", "year", "volume", "containers")


@query("jn_26_inhabitants", f"""WITH k AS ({_area_sql('week')})
    SELECT k.buurt_code, k.fractie, k.week, k.year, k.sum, p.inhabitants
    FROM k LEFT JOIN {{population}} p ON p.buurt_code = k.buurt_code AND p.year = k.year""")
def _(t: Tables) -> DataFrame:
    return links.inhabitants(stats.area_stats(t.measurements, t.sites, "week"), t.population).select(
        "buurt_code", "fractie", "week", "year", "sum", "inhabitants")


def _area_table_sql(period: str) -> str:
    return f"""WITH k AS ({_area_sql(period)}), c AS ({AREA_COUNTS})
    SELECT k.*, p.inhabitants, c.containers FROM k
    LEFT JOIN {{population}} p ON p.buurt_code = k.buurt_code AND p.year = k.year
    LEFT JOIN c ON c.buurt_code = k.buurt_code
      AND c.fractie = CASE k.fractie WHEN 'Kunststof' THEN 'Plastic' ELSE k.fractie END"""


def _statistics(t: Tables) -> dict[str, DataFrame]:
    return feeds.statistics(t.measurements, t.sites, t.wells, t.containers, t.container_types, t.population, t.areas)


@query("pl_07_area_month_statistics", _area_table_sql("month"))
def _(t: Tables) -> DataFrame:
    return _statistics(t)["area_month"]


@query("pl_07_area_week_statistics", _area_table_sql("week"))
def _(t: Tables) -> DataFrame:
    return _statistics(t)["area_week"]


@query("pl_07_site_month_statistics", _capacity_sql("month"))
def _(t: Tables) -> DataFrame:
    return _statistics(t)["site_month"]


@query("pl_07_site_week_statistics", _capacity_sql("week"))
def _(t: Tables) -> DataFrame:
    return _statistics(t)["site_week"]


AS_OF = "(SELECT max(communication_date_time) FROM {states})"


def _as_of(t: Tables):
    """The latest state stands in for the clock."""
    return t.states.agg(F.max("communication_date_time").alias("now"))


def _at(t: Tables, fn) -> DataFrame:
    """Call `fn(states, now)` with the latest time as a column of every state."""
    return fn(t.states.crossJoin(F.broadcast(_as_of(t))), F.col("now")).drop("now")


_LATEST = """SELECT id, description, filling FROM (
    SELECT *, row_number() OVER (PARTITION BY scraped_at, description ORDER BY id) AS rn FROM {states}
    WHERE communication_date_time > """ + AS_OF + """ - INTERVAL 1 HOUR %s) WHERE rn = 1"""


@query("wn_05_latest_states", _LATEST % "")
def _(t: Tables) -> DataFrame:
    return _at(t, st.latest_states).select("id", "description", "filling")


@query("wn_06_latest_invalid", _LATEST % "AND NOT valid")
def _(t: Tables) -> DataFrame:
    return _at(t, st.latest_invalid).select("id", "description", "filling")


@query("wn_07_latest_per_key", """SELECT description, max(id) AS id, max(communication_date_time) AS at
    FROM {states} s WHERE id = (SELECT max(id) FROM {states} o WHERE o.description = s.description) GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return st.latest_per(t.states, ["description"], "id").select(
        "description", "id", F.col("communication_date_time").alias("at"))


@query("wn_07_latest", "SELECT id, description FROM {states} ORDER BY communication_date_time DESC, id DESC LIMIT 1")
def _(t: Tables) -> DataFrame:
    return st.latest(t.states, F.struct("communication_date_time", "id")).select("id", "description")


@query("wn_ranked_rows", """SELECT straatnaam, id,
    row_number() OVER (PARTITION BY straatnaam ORDER BY id) AS rown FROM {sites}""")
def _(t: Tables) -> DataFrame:
    return skew.ranked(t.sites.select("straatnaam", "id"), ["straatnaam"], ["id"])


@query("so_01_ordered", "SELECT id, distance FROM {sites} ORDER BY distance DESC, id")
def _(t: Tables) -> DataFrame:
    return paging.ordered(t.sites.select("id", "distance"), "-distance,id")


@query("so_02_numbered_page", """SELECT id, short_id, (SELECT count(*) FROM {sites}) AS total
    FROM {sites} ORDER BY id LIMIT 10 OFFSET 20""")
def _(t: Tables) -> DataFrame:
    return paging.page(t.sites.select("id", "short_id"), "id", 3, paging.SITE_PAGE_SIZE)


@query("so_02_deep_page", """SELECT id, waste_name, (SELECT count(*) FROM {containers}) AS total
    FROM {containers} ORDER BY waste_name DESC, id LIMIT 50 OFFSET (SELECT count(*) // 100 * 50 FROM {containers})""")
def _(t: Tables) -> DataFrame:
    """A page from the middle of a list that is stored in parts; reads the parts that hold it."""
    path = work_path(t.spark, "pages")
    rows, order = t.containers.select("id", "waste_name"), "-waste_name,id"
    paging.store_pages(rows, order, path, 1000)
    middle = rows.count() // 100 + 1
    return paging.stored_page(t.spark, path, "id bigint, waste_name string", order, middle, 50)


@query("so_03_cursor_page", """SELECT id, filling FROM {states} ORDER BY id DESC LIMIT 100""")
def _(t: Tables) -> DataFrame:
    return paging.cursor_page(t.states.select("id", "filling"), "id", 100, None, "id", 5000)


@query("so_03_cursor_ties", """SELECT id, filling, n FROM (SELECT id, filling, (row_number() OVER (ORDER BY filling DESC, id DESC) - 1) // 40 AS n
    FROM {states}) WHERE n < 3""")
def _(t: Tables) -> DataFrame:
    """Three pages in a row over a key that most rows share with others."""
    rows, cursor, pages = t.states.select("id", "filling"), None, None
    for n in range(3):
        part = paging.cursor_page(rows, "filling", 40, cursor)
        last = part.collect()[-1]  # as a client does with the page it was given
        cursor = (last["filling"], last["id"])
        numbered = part.withColumn("n", F.lit(n).cast("bigint"))
        pages = numbered if pages is None else pages.unionByName(numbered)
    return pages


@query("so_04_default_order", f"WITH k AS ({_site_sql('month')}) SELECT site_id, fractie, month, year, sum FROM k")
def _(t: Tables) -> DataFrame:
    return paging.default_ordered(stats.site_stats(t.measurements, t.sites, "month"), "site_month_stats").select(
        "site_id", "fractie", "month", "year", "sum")


@query("so_list_query", """SELECT id, huisnummer FROM {sites} WHERE stadsdeel = 'A' AND bgt_based
    ORDER BY huisnummer DESC, id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return paging.list_query(t.sites, "sites", {"stadsdeel": "A", "bgt_based": True}, "id,huisnummer", None, "-huisnummer,id")


@query("set_03_distinct", "SELECT DISTINCT straatnaam, stadsdeel FROM {sites}")
def _(t: Tables) -> DataFrame:
    return t.sites.select("straatnaam", "stadsdeel").dropDuplicates()


@query("mut_01_update_from", """SELECT w.id, coalesce(s.first, w.summary) AS summary FROM {wells} w LEFT JOIN
    (SELECT well_id, min(serial_number) AS first FROM {containers} GROUP BY 1) s ON s.well_id = w.id""")
def _(t: Tables) -> DataFrame:
    source = t.containers.select(F.col("well_id").alias("id"), F.col("serial_number").alias("summary"))
    return merge.update_from(t.wells.select("id", "summary"), source, ["id"], ["summary"])


@query("mut_02_delete_in", """SELECT id FROM {containers}
    WHERE container_type_id NOT IN (SELECT id FROM {container_types} WHERE weight > 25)""")
def _(t: Tables) -> DataFrame:
    heavy = t.container_types.filter("weight > 25").select(F.col("id").alias("container_type_id"))
    return merge.delete_in(t.containers, heavy, ["container_type_id"]).select("id")


@query("mut_03_press_weights", """
    WITH x AS (SELECT *, first_weight = 0 AND second_weight > 840 AND second_weight = net_weight AND stadsdeel = 'N'
               AND fractie IN ('Rest', 'Papier', 'Glas') AS hit FROM {measurements})
    SELECT seq_id, site_id, CASE WHEN hit THEN second_weight - CASE fractie WHEN 'Rest' THEN 1520 ELSE 850 END
           ELSE net_weight END AS net_weight, hit OR valid AS valid FROM x""")
def _(t: Tables) -> DataFrame:
    return t.measurements.withColumns(corrected_press_weights(
        "first_weight", "second_weight", "net_weight", "fractie", "stadsdeel", "valid")).select(
            "seq_id", "site_id", "net_weight", "valid")


@query("mut_04_reset_links", "SELECT id, CAST(NULL AS VARCHAR) AS site_id FROM {wells}")
def _(t: Tables) -> DataFrame:
    return merge.reset(t.wells.select("id", "site_id"), ["site_id"])


@query("fk_orphans", """SELECT id, well_id FROM {containers}
    WHERE well_id IS NOT NULL AND well_id NOT IN (SELECT id FROM {wells} WHERE active = 1)""")
def _(t: Tables) -> DataFrame:
    return checks.orphans(t.containers, "well_id", t.wells.filter("active = 1")).select("id", "well_id")
