"""The lists of containers, wells and sites with all filters, also those that go through a relation.

A request is a mapping of filter names to values. Plain columns are compared as in
`filters.apply_filters`; the names below ask for related tables. All filters must hold, and
each is one join at most, on keys, so a list of any size is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import filters as fl, paging
from .shape import sparse

# Names of the flags of a well's attributes.
WELL_FLAGS = {"no_bgt": "missing_bgt_afval", "in_weg": "in_wegdeel", "in_pand": "in_pand"}
TYPE_OF_SITE = "wells__containers__container_type"


@dataclass
class Register:
    """The tables that the lists are about."""

    containers: DataFrame
    wells: DataFrame
    types: DataFrame
    sites: DataFrame


Step = Callable[[DataFrame, Register, object], DataFrame]


def _box(value: object) -> tuple[float, float, float, float]:
    lat1, lon1, lat2, lon2 = (float(v) for v in value.split(",")) if isinstance(value, str) else value
    return lat1, lon1, lat2, lon2


def _of_well(pick: Callable[[DataFrame, object], DataFrame]) -> Step:
    """Containers whose well is picked."""
    return lambda rows, register, value: fl.via(rows, "well_id", pick(register.wells, value))


def _flag(name: str) -> Step:
    return lambda rows, register, value: fl.with_flag(rows, name, bool(value))


def _area(wells: DataFrame, value: object) -> DataFrame:
    return fl.choice_in(wells, "buurt_code", value, wells, "buurt_code")


def _near(rows: DataFrame, value: object) -> DataFrame:
    return fl.within_radius(rows, *fl.parse_xyr(value))


def _district(rows: DataFrame, value: object) -> DataFrame:
    return fl.choice(rows, "stadsdeel", value, fl.DISTRICTS)


def type_called(types: DataFrame, name: str) -> DataFrame:
    """Types of a name; one that no type has makes the query fail when it runs."""
    return fl.choice_in(types, "name", name, types, "name")


def sites_with_type(sites: DataFrame, wells: DataFrame, containers: DataFrame, types: DataFrame, name: str) -> DataFrame:
    """Sites that have a container whose type has a name, each once."""
    of_type = fl.via(containers, "container_type_id", type_called(types, name))
    return fl.sites_with_container(sites, wells, of_type, F.lit(True))


# Names with a meaning of their own. The value of a flag for a missing relation is not looked at.
STEPS: dict[str, dict[str, Step]] = {
    "containers": {
        "id_number": lambda rows, r, v: fl.id_equals(rows, v),
        "like_id_number": lambda rows, r, v: fl.id_contains(rows, v),
        "invalid_id": lambda rows, r, v: fl.malformed_ids(rows),
        "waste_name": lambda rows, r, v: fl.choice(rows, "waste_name", v, fl.WASTE_CHOICES),
        "well": lambda rows, r, v: rows.filter(F.col("well_id") == F.lit(v)),
        "container_type": lambda rows, r, v: rows.filter(F.col("container_type_id") == F.lit(v)),
        "no_well": lambda rows, r, v: fl.containers_without_well(rows),
        "no_site": lambda rows, r, v: fl.containers_without_site(rows, r.wells),
        "in_bbox": _of_well(lambda wells, v: fl.in_bbox(wells, _box(v))),
        "location": _of_well(_near),
        "well__stadsdeel": _of_well(_district),
        "well__buurt_code": _of_well(_area),
    },
    "wells": {
        "in_bbox": lambda rows, r, v: fl.in_bbox(rows, _box(v)),
        "location": lambda rows, r, v: _near(rows, v),
        "stadsdeel": lambda rows, r, v: _district(rows, v),
        "buurt_code": lambda rows, r, v: _area(rows, v),
        "site": lambda rows, r, v: rows.filter(F.col("site_id") == F.lit(v)),
        "containers": lambda rows, r, v: rows.join(
            r.containers.filter(F.col("id") == F.lit(v)).select(F.col("well_id").alias("id")), "id", "left_semi"),
        "no_container": lambda rows, r, v: fl.wells_without_container(rows, r.containers),
        **{name: _flag(flag) for name, flag in WELL_FLAGS.items()},
    },
    "sites": {
        "in_bbox": lambda rows, r, v: fl.polygon_in_bbox(rows, _box(v)),
        "location": lambda rows, r, v: _near(rows, v),
        "stadsdeel": lambda rows, r, v: _district(rows, v),
        "buurt_code": lambda rows, r, v: _area(rows, v),
        "wells": lambda rows, r, v: rows.join(
            r.wells.filter(F.col("id") == F.lit(v)).select(F.col("site_id").alias("id")), "id", "left_semi"),
        "no_container": lambda rows, r, v: fl.sites_with_empty_well(rows, r.wells, r.containers),
        "no_short_id": lambda rows, r, v: fl.sites_without_short_id(rows),
        "fractie": lambda rows, r, v: fl.sites_with_container(
            rows, r.wells, fl.choice(r.containers, "waste_name", v, fl.WASTE_CHOICES), F.lit(True)),
        "container_type": lambda rows, r, v: sites_with_type(rows, r.wells, r.containers, r.types, v),
    },
}
DISTINCT = {"fractie", "container_type"}


def _by_type(entity: str, rows: DataFrame, register: Register, name: str, value: float, once: bool) -> DataFrame | None:
    """Filters on the volume or weight of a container's type; None for another name."""
    prefix = {"containers": "container_type", "sites": TYPE_OF_SITE}.get(entity)
    parts = (name.removeprefix(f"{prefix}__") if prefix and name.startswith(f"{prefix}__") else "").split("__")
    column, op = parts[0], parts[1] if len(parts) == 2 else "exact"
    if column not in ("volume", "weight") or op not in fl.RANGE or len(parts) > 2:
        return None
    if entity == "containers":
        return fl.by_type(rows, register.types, column, op, value)
    if once:
        hits = fl.by_type(register.containers, register.types, column, op, value)
        return fl.sites_with_container(rows, register.wells, hits, F.lit(True))
    return fl.sites_by_type(rows, register.wells, register.containers, register.types, column, op, value)


def related(entity: str, register: Register, params: Mapping[str, object] | None = None) -> DataFrame:
    """Rows of a list (`containers`, `wells` or `sites`) that meet all filters.

    A site is there once for each container whose type meets a filter on volume or weight, and
    once per well without a container; a filter on a fraction or a type's name makes
    all rows distinct. An undeclared filter is an error, as is a choice that does not exist.
    """
    rows, plain = getattr(register, entity), {}
    once = entity == "sites" and bool(DISTINCT & set(params or {}))
    for name, value in (params or {}).items():
        if name == "detailed":  # asks for another form of the rows, not for others
            continue
        step = STEPS[entity].get(name)
        typed = None if step else _by_type(entity, rows, register, name, value, once)
        if step:
            rows = step(rows, register, value)
        elif typed is not None:
            rows = typed
        else:
            plain[name] = value
    rows = fl.apply_filters(rows, plain, fl.FILTERS[entity])
    return rows.dropDuplicates(["id"]) if once and "no_container" in params else rows


def related_page(
    entity: str, register: Register, params: Mapping[str, object] | None = None, fields: str | None = None,
    omit: str | None = None, order: str | None = None, number: int = 1, size: int | None = None,
) -> DataFrame:
    """One page of a list, filtered, ordered and with some of its fields."""
    rows = related(entity, register, params)
    size = size or paging.PAGE_SIZES.get(entity, paging.PAGE_SIZE)
    return sparse(paging.numbered_rows(rows, order or paging.DEFAULT_ORDER[entity], number, size), fields, omit)
