"""Collection sites: clusters with an address, merged and linked to wells.

A site row is `(id, cluster, bgt_based, active, stadsdeel, stadsdeel_naam, buurt_code,
straatnaam, huisnummer, distance, x, y, rings)`; `rings` is its shape, read even-odd: a
hull, or the outer rings and holes of several shapes dissolved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.clean import rounded, site_key
from ..session import cut
from . import nearest as nn
from .cluster import clusters, components, hulls
from .dissolve import dissolve
from .links import usable_wells
from .merge import update_from
from .overlap import overlaps, polygon_distance
from .spatial import area_code, points_in_polygons, polygon_pairs

BIN_REACH = 7.0
WELL_REACH = 12.0
CLOSE_SITES = 5.0


def bin_clusters(bins: DataFrame, districts: DataFrame, reach: float = BIN_REACH) -> DataFrame:
    """Clusters of map bins (id, x, y) that lie strictly inside a district."""
    shapes = districts.select("rings").distinct()
    inside = points_in_polygons(bins.select("id", "x", "y"), shapes, True, 1000.0, "left_semi")
    return clusters(inside, reach)


def well_clusters(wells: DataFrame, containers: DataFrame, reach: float = WELL_REACH) -> DataFrame:
    """Clusters of active wells that hold a container and have no site yet."""
    left = usable_wells(wells.filter("site_id is null"), containers)
    return clusters(left.select("id", "x", "y"), reach)


def cluster_hulls(grouped: DataFrame, radius: float) -> DataFrame:
    """Distinct cluster shapes with their centroid (cx, cy), rounded as (x, y)."""
    return hulls(grouped, "cluster", radius).withColumns(geo.centroid("rings")).withColumns(
        {"x": rounded(F.col("cx")), "y": rounded(F.col("cy"))}).dropDuplicates(["rings"])


def cluster_areas(shapes: DataFrame, districts: DataFrame, areas: DataFrame) -> DataFrame:
    """District and neighbourhood around each centroid, edge included; NULL outside."""
    centres = shapes.withColumnsRenamed({"x": "_x", "y": "_y"}).withColumnsRenamed({"cx": "x", "cy": "y"})
    coded = area_code(centres, districts, "code", "stadsdeel")
    coded = area_code(coded, areas, "code", "buurt_code")
    return coded.withColumnsRenamed({"x": "cx", "y": "cy"}).withColumnsRenamed({"_x": "x", "_y": "y"})


def nearest_street(shapes: DataFrame, streets: DataFrame, key: str = "cluster") -> DataFrame:
    """`(key, street_id, straatnaam)` of the nearest road by shape."""
    roads = streets.filter("opr_type = 'Weg'")
    found = nn.of_shapes(nn.nearest(nn.shape_items(shapes, key), nn.polygon_items(roads, "id"), nn.polygon_to_polygon, cell=64.0))
    names = roads.select(F.col("id").alias("target"), F.col("display").alias("straatnaam"))
    return found.join(names, "target").select(F.col("key").alias(key), F.col("target").alias("street_id"), "straatnaam")


def street_addresses(
    shapes: DataFrame, streets: DataFrame, addresses: DataFrame, only_used: bool = False, key: str = "cluster",
) -> DataFrame:
    """Nearest street, then the nearest address of that street: adds `straatnaam`,
    `huisnummer` and the rounded `distance` from the centroid (cx, cy).

    A shape without street or address drops out. `only_used` skips streets that have no
    address at all.
    """
    if only_used:
        used = addresses.select(F.col("street").alias("display"))
        streets = streets.join(used, "display", "left_semi")
    named = cut(shapes.join(nearest_street(shapes, streets, key).drop("street_id"), key))
    found = nn.of_shapes(nn.nearest(
        nn.shape_items(named, key, by=["straatnaam"]),
        nn.point_items(addresses.withColumnRenamed("street", "straatnaam"), "id", by=["straatnaam"]),
        nn.polygon_to_point, by=["straatnaam"], cell=64.0), ["straatnaam"])
    numbers = addresses.select(F.col("id").alias("target"), "huisnummer", F.col("x").alias("ax"), F.col("y").alias("ay"))
    picked = found.join(numbers, "target").select(F.col("key").alias(key), "huisnummer", "ax", "ay")
    return named.join(picked, key).withColumn(
        "distance", rounded(geo.distance("cx", "cy", "ax", "ay"))).drop("ax", "ay")


def sites_from(
    grouped: DataFrame, radius: float, bgt_based: bool,
    districts: DataFrame, areas: DataFrame, streets: DataFrame, addresses: DataFrame,
) -> DataFrame:
    """Site rows of clustered points."""
    shapes = cut(cluster_areas(cut(cluster_hulls(grouped, radius)), districts, areas))
    addressed = street_addresses(shapes, streets, addresses, only_used=not bgt_based)
    names = districts.select(F.col("code").alias("stadsdeel"), F.col("display").alias("stadsdeel_naam")).dropDuplicates(["stadsdeel"])
    return (
        addressed.join(names, "stadsdeel", "left")
        .select(
            site_key("x", "y", "stadsdeel", "buurt_code").alias("id"), "cluster",
            F.lit(bgt_based).alias("bgt_based"), F.lit(None).cast("int").alias("active"),
            "stadsdeel", "stadsdeel_naam", "buurt_code", "straatnaam", "huisnummer", "distance",
            F.col("cx").alias("x"), F.col("cy").alias("y"), "rings")
    )


def key_clashes(map_sites: DataFrame, well_sites: DataFrame) -> DataFrame:
    """Ids that both inserts would write."""
    return map_sites.select("id").join(well_sites.select("id"), "id", "left_semi").distinct()


def all_sites(map_sites: DataFrame, well_sites: DataFrame) -> DataFrame:
    """Both kinds of site; a map-based one keeps a contested id."""
    fresh = well_sites.join(map_sites.select("id"), "id", "left_anti")
    return map_sites.unionByName(fresh).dropDuplicates(["id"])


def site_shapes(sites: DataFrame) -> DataFrame:
    """Shapes under the name a link has, for joins with points."""
    return sites.select(F.col("id").alias("site_id"), "rings")


def wells_in_sites(wells: DataFrame, sites: DataFrame, keep: bool = False) -> DataFrame:
    """`site_id` of the site strictly around each well, the lowest when several are.

    Links are set anew; `keep` only fills the missing ones.
    """
    placed = wells.select("id", "x", "y")
    if keep:
        placed = wells.filter("site_id is null").select("id", "x", "y")
    found = points_in_polygons(placed, site_shapes(sites), True, 16.0).groupBy("id").agg(
        F.min("site_id").alias("_site"))
    site_id = F.coalesce("site_id", "_site") if keep else F.col("_site")
    return wells.join(found, "id", "left").withColumn("site_id", site_id).drop("_site")


def _boxes(sites: DataFrame) -> DataFrame:
    return sites.select("id", "bgt_based", "rings", *[c.alias(n) for n, c in geo.bounds("rings").items()])


def overlapping_pairs(sites: DataFrame) -> DataFrame:
    """`(id, b_id)` with `id` map-based and both shapes overlapping."""
    boxed = _boxes(sites)
    pairs = polygon_pairs(boxed.filter("bgt_based"), boxed, 0.0, F.col("id") != F.col("b_id"))
    return pairs.filter(overlaps("rings", "b_rings"))


def merge_overlapping(sites: DataFrame) -> DataFrame:
    """Map-based sites take the shapes they overlap (`active` 4); absorbed sites that
    are not map-based go. The shape becomes the dissolved union, the centroid that of the union;
    `parts` counts the different shapes in it. Pairs are taken from one state of the table."""
    sites = cut(sites)
    pairs = cut(overlapping_pairs(sites).select("id", "b_id", "b_bgt_based", "b_rings"))
    taken = pairs.select("id", F.col("b_rings").alias("rings")).distinct()
    grown = taken.groupBy("id").agg((F.count("*") + 1).alias("_parts"))
    own = sites.select("id", "rings").join(grown.select("id"), "id", "left_semi")
    unions = dissolve(own.unionByName(taken), ["id"]).withColumnsRenamed({"rings": "_rings"})
    gone = pairs.filter("not b_bgt_based").select(F.col("b_id").alias("id")).distinct()
    merged = F.col("_rings").isNotNull()
    before = F.col("parts") if "parts" in sites.columns else F.lit(1)
    return (
        sites.join(unions, "id", "left").join(grown, "id", "left")
        .withColumn("active", F.when(merged, F.lit(4)).otherwise(F.col("active")))
        .withColumns({c: F.when(merged, centre).otherwise(F.col(c)) for c, centre in zip(("x", "y"), geo.centroid("_rings").values())})
        .withColumns({"rings": F.coalesce("_rings", "rings"), "parts": F.coalesce("_parts", before)})
        .drop("_rings", "_parts").join(gone, "id", "left_anti")
    )


def merge_close(sites: DataFrame, layer: DataFrame, reach: float = CLOSE_SITES) -> DataFrame:
    """Sites within `reach` of each other and with their centroids in the same polygon
    of a layer become one: the largest id stays with the hull of all and its centroid (`active` 5).

    Whole groups are merged from one state of the table.
    """
    sites = cut(sites)
    first = sites.select("id", "x", "y")
    inside = points_in_polygons(first, layer.select("object_id", "rings"), False).select("id", "object_id")
    shapes = cut(
        sites.select("id", "rings").join(inside, "id").select("id", "object_id", "rings")
        .withColumns(geo.bounds("rings")))
    together = (F.col("object_id") == F.col("b_object_id")) & (F.col("id") > F.col("b_id"))
    pairs = polygon_pairs(shapes, shapes, reach, together).filter(
        polygon_distance("rings", "b_rings") <= reach).select("id", "b_id").distinct()  # once, however many areas they share
    roots = components(pairs.select(F.col("id").alias("u"), F.col("b_id").alias("v")))
    member = sites.select("id").join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("root", "id").alias("root"))
    keeper = member.groupBy("root").agg(F.max("id").alias("keeper"), F.count("*").alias("size"))
    groups = cut(member.join(keeper, "root").filter("size > 1").select("id", "keeper"))
    corners = (
        sites.join(groups, "id").select("keeper", F.explode(F.flatten("rings")).alias("p"))
        .select("keeper", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    )
    merged = hulls(corners, "keeper").select(F.col("keeper").alias("id"), F.col("rings").alias("_rings"))
    gone = groups.filter("id <> keeper").select("id")
    changed = F.col("_rings").isNotNull()
    return (
        sites.join(gone, "id", "left_anti").join(merged, "id", "left")
        .withColumn("active", F.when(changed, F.lit(5)).otherwise(F.col("active")))
        .withColumns({c: F.when(changed, centre).otherwise(F.col(c)) for c, centre in zip(("x", "y"), geo.centroid("_rings").values())})
        .withColumn("rings", F.when(changed, F.col("_rings")).otherwise(F.col("rings")))
        .drop("_rings")
    )


def _with_wells(sites: DataFrame, wells: DataFrame) -> DataFrame:
    return sites.join(wells.filter("site_id is not null").select(F.col("site_id").alias("id")), "id", "left_semi")


def readdress(
    sites: DataFrame, wells: DataFrame, places: DataFrame, gain: int, limit: int | None = None,
) -> DataFrame:
    """Take the address of the nearest place where that is more than `gain` metres nearer
    (and nearer than `limit`); only sites that have a well. Places are points or polygons
    with `street` and `huisnummer`; the distance is the rounded one to the site's shape."""
    sites = cut(sites)
    candidates = _with_wells(sites, wells)
    if "rings" in places.columns:
        items, exact = nn.polygon_items(places, "id"), nn.polygon_to_polygon
    else:
        items, exact = nn.point_items(places, "id"), nn.polygon_to_point
    found = nn.nearest(nn.polygon_items(candidates, "id"), items, exact, cell=64.0)
    new = found.join(places.select(F.col("id").alias("target"), "street", "huisnummer"), "target").select(
        F.col("key").alias("id"), F.col("street").alias("straatnaam"), "huisnummer", rounded(F.col("distance")).alias("distance"))
    before = sites.select("id", F.col("distance").alias("_old"))
    better = F.col("distance") - F.col("_old") < -gain
    if limit is not None:
        better = better & (F.col("distance") < limit)
    return update_from(sites, new.join(before, "id").filter(better), ["id"], ["straatnaam", "huisnummer", "distance"])


def supplier_sites(supplier: DataFrame, sites: DataFrame, within: int = 30) -> DataFrame:
    """`site_id` (short id) of the nearest site whose rounded distance is below `within`."""
    found = nn.nearest(
        nn.point_items(supplier, "id"), nn.polygon_items(sites, "id"),
        nn.point_to_polygon, cell=32.0, max_distance=float(within))
    short = sites.select(F.col("id").alias("target"), F.col("short_id").alias("site_id"))
    link = found.filter(rounded(F.col("distance")) < within).join(short, "target").select(
        F.col("key").alias("id"), "site_id")
    return supplier.drop("site_id").join(link, "id", "left")


def fill_level_sites(levels: DataFrame, supplier: DataFrame, sites: DataFrame, within: int = 30) -> DataFrame:
    """`site_id` of fill levels, by the name of their supplier site; links that are there
    stay. The nearest site is found once per supplier site."""
    linked = supplier_sites(supplier, sites, within).filter("site_id is not null")
    by_name = linked.groupBy(F.col("name").alias("e_site_name")).agg(F.min("site_id").alias("_site"))
    return (
        levels.join(by_name, "e_site_name", "left")
        .withColumn("site_id", F.coalesce("site_id", "_site")).drop("_site")
    )
