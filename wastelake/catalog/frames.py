"""Domain frames made from the benchmark tables, in SQL that Spark and DuckDB both read.

Places are whole metres on a square of about 4 km, spread by arithmetic on the keys.
`{name}` stands for another frame or a benchmark table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import geo

EAST, NORTH = 115000, 480000


def _x(key: str, a: int, b: int) -> str:
    return f"({EAST} + ({key} * {a} + {b}) % 4007)"


def _y(key: str, a: int, b: int) -> str:
    return f"({NORTH} + (({key} % 4013) * ({key} % 4013) * {a} + {key} * {b}) % 4013)"


def _place(key: str, a: int, b: int) -> str:
    return f"CAST({_x(key, a, b)} AS DOUBLE) AS x, CAST({_y(key, b, a)} AS DOUBLE) AS y"


DISTRICT = "substr('ABEFKMNT', CAST(n_nationkey % 8 + 1 AS INT), 1)"
AREA = f"{DISTRICT} || CAST(10 + n_nationkey AS STRING)"

FRAMES = {
    "sites": f"""
        SELECT 'S' || CAST(s_suppkey AS STRING) AS id,
               CASE WHEN s_acctbal < 500 THEN NULL ELSE s_suppkey END AS short_id,
               {DISTRICT} AS stadsdeel, CAST(10 + n_nationkey AS STRING) AS buurt_code,
               'Straat ' || CAST(n_nationkey AS STRING) AS straatnaam,
               CAST(floor(abs(s_acctbal) / 1000) AS BIGINT) + 1 AS huisnummer,
               s_acctbal > 5000 AS bgt_based, CAST(floor(s_acctbal / 50) AS BIGINT) AS distance,
               {_place('s_suppkey', 7919, 101)}, s_suppkey AS num
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "wells": f"""
        SELECT c_custkey AS id, 'W' || CAST(c_custkey AS STRING) AS id_number, c_name AS serial_number,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 0 WHEN 'MACHINERY' THEN 2 ELSE 1 END AS active,
               c_nationkey AS owner_id, {DISTRICT} AS stadsdeel, {AREA} AS buurt_code,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
                    ELSE 'S' || CAST(c_custkey % (SELECT count(*) FROM {{supplier}}) AS STRING) END AS site_id,
               c_name || ', ' || c_mktsegment AS summary, {_place('c_custkey', 104729, 37)}
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "containers": """
        SELECT o_orderkey AS id,
               CASE WHEN o_totalprice < 30000 THEN NULL WHEN o_totalprice < 60000 THEN 'R' || substr(o_orderstatus, 1, 1)
                    WHEN o_totalprice < 90000 THEN 'RE  NUMBER ' || CAST(o_orderkey AS STRING)
                    ELSE 'RE' || CAST(o_orderkey AS STRING) END AS id_number,
               'C' || CAST(o_orderkey AS STRING) AS serial_number,
               CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_custkey END AS well_id,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE 2 END AS active,
               CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 6
                    WHEN '4-NOT SPECIFIED' THEN 25 ELSE 5 END AS waste_type,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Rest' WHEN '2-HIGH' THEN 'Glas' WHEN '3-MEDIUM' THEN 'Papier'
                    WHEN '4-NOT SPECIFIED' THEN 'Plastic' ELSE 'GFT' END AS waste_name,
               CAST(floor(o_totalprice) AS BIGINT) % (SELECT count(*) FROM {part}) AS container_type_id,
               o_orderdate AS placing_date
        FROM {orders}""",
    "container_types": """
        SELECT p_partkey AS id, p_name AS name, CAST(p_size / 10.0 AS DECIMAL(6,3)) AS volume, p_size AS weight
        FROM {part}""",
    "measurements": f"""
        SELECT l_orderkey AS seq_id, CAST(l_linenumber AS BIGINT) AS system_id, l_suppkey AS site_id,
               l_shipdate AS weigh_at,
               CASE WHEN l_returnflag = 'A' THEN 'Rest' WHEN l_returnflag = 'N' THEN 'Papier'
                    WHEN l_linestatus = 'O' THEN 'Kunststof' ELSE 'Glas' END AS fractie,
               CASE WHEN l_discount = 0 THEN 0 ELSE CAST(floor(l_extendedprice / 20) AS BIGINT) + 100 END AS first_weight,
               CAST(floor(l_extendedprice / 20) AS BIGINT) AS second_weight,
               CASE WHEN l_discount = 0 THEN CAST(floor(l_extendedprice / 20) AS BIGINT)
                    ELSE CAST(floor(l_quantity * 10) AS BIGINT) END AS net_weight,
               substr('ABEFKMNT', CAST(l_suppkey % 8 + 1 AS INT), 1) AS stadsdeel,
               l_extendedprice >= 5000 AND l_tax > 0 AS valid, {_place('l_orderkey', 2741, 59)}
        FROM {{lineitem}}""",
    "states": """
        SELECT event_id AS id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS scraped_at,
               'REK' || CAST(user_id AS STRING) AS description, CAST(ts AS TIMESTAMP) AS communication_date_time,
               CAST(floor(value) AS BIGINT) % 101 AS filling, event_type AS fraction, value > 20 AS valid,
               user_id AS short_id
        FROM {events}""",
    "population": f"""
        SELECT {AREA} AS buurt_code, y.year AS year, 1000 + n_nationkey * 10 + y.year % 100 AS inhabitants
        FROM {{nation}} CROSS JOIN (SELECT DISTINCT CAST(year(l_shipdate) AS BIGINT) AS year FROM {{lineitem}}) y""",
    "areas": f"""
        SELECT {AREA} AS vollcode, CAST(10 + n_nationkey AS STRING) AS code, n_name AS naam,
               CAST({EAST} + n_nationkey % 5 * 803 AS DOUBLE) AS minx,
               CAST({NORTH} + floor(n_nationkey / 5) * 803 AS DOUBLE) AS miny,
               CAST({EAST} + n_nationkey % 5 * 803 + 803 AS DOUBLE) AS maxx,
               CAST({NORTH} + floor(n_nationkey / 5) * 803 + 803 AS DOUBLE) AS maxy
        FROM {{nation}}""",
    "districts": f"""
        SELECT substr('ABEFKMNT', CAST(r_regionkey + 1 AS INT), 1) AS code, r_name AS display,
               CAST({EAST} + r_regionkey * 803 AS DOUBLE) AS minx, CAST({NORTH} - 1 AS DOUBLE) AS miny,
               CAST({EAST} + r_regionkey * 803 + 803 AS DOUBLE) AS maxx, CAST({NORTH} + 4015 AS DOUBLE) AS maxy
        FROM {{region}}""",
    "streets": f"""
        SELECT CAST(3630000 + n_nationkey AS BIGINT) AS id, 'Straat ' || CAST(n_nationkey AS STRING) AS display,
               CASE WHEN n_regionkey = 4 THEN 'Water' ELSE 'Weg' END AS opr_type,
               CAST({EAST} + n_nationkey % 5 * 803 + 100 AS DOUBLE) AS minx,
               CAST({NORTH} + floor(n_nationkey / 5) * 803 + 400 AS DOUBLE) AS miny,
               CAST({EAST} + n_nationkey % 5 * 803 + 700 AS DOUBLE) AS maxx,
               CAST({NORTH} + floor(n_nationkey / 5) * 803 + 410 AS DOUBLE) AS maxy
        FROM {{nation}}""",
    "buildings": f"""
        SELECT p_partkey AS id, p_brand AS brand, p_type AS kind,
               CAST({_x('p_partkey', 611, 953)} AS DOUBLE) AS minx, CAST({_y('p_partkey', 953, 611)} AS DOUBLE) AS miny,
               CAST({_x('p_partkey', 611, 953)} + p_size AS DOUBLE) AS maxx,
               CAST({_y('p_partkey', 953, 611)} + p_size AS DOUBLE) AS maxy
        FROM {{part}}""",
    "addresses": f"""
        SELECT c_custkey AS id, 'Straat ' || CAST(c_nationkey AS STRING) AS street,
               CAST(floor(abs(c_acctbal) / 100) AS BIGINT) AS huisnummer, {_place('c_custkey', 3571, 89)}
        FROM {{customer}}""",
    "moorings": f"""
        SELECT s_suppkey AS id, 'Straat ' || CAST(s_nationkey AS STRING) AS street,
               CAST(floor(abs(s_acctbal) / 100) AS BIGINT) AS huisnummer,
               CAST({_x('s_suppkey', 1237, 53)} AS DOUBLE) AS minx, CAST({_y('s_suppkey', 53, 1237)} AS DOUBLE) AS miny,
               CAST({_x('s_suppkey', 1237, 53)} + 12 AS DOUBLE) AS maxx,
               CAST({_y('s_suppkey', 53, 1237)} + 12 AS DOUBLE) AS maxy
        FROM {{supplier}}""",
    "site_boxes": """
        SELECT id, short_id, num, bgt_based, stadsdeel, buurt_code, straatnaam, huisnummer, distance, x, y,
               x - 30 AS minx, y - 30 AS miny, x + 30 AS maxx, y + 30 AS maxy
        FROM {sites}""",
    "bins": f"""
        SELECT o_orderkey AS id, {_place('o_orderkey', 389, 71)} FROM {{orders}}""",
    "part_bins": f"""
        SELECT p_partkey AS id, {_place('p_partkey', 389, 71)} FROM {{part}}""",
    "supplier_points": f"""
        SELECT p_partkey AS id, p_name || ' ' || CAST(p_partkey AS STRING) AS name, {_place('p_partkey', 2203, 29)}
        FROM {{part}}""",
}

SHAPES = {"areas", "districts", "streets", "buildings", "moorings", "site_boxes"}


def add_shapes(name: str, df: DataFrame) -> DataFrame:
    """Boxes as polygons."""
    return df.withColumn("rings", geo.box("minx", "miny", "maxx", "maxy")) if name in SHAPES else df
