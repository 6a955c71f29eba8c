"""Scalar cleaning rules as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Waste codes of the container register.
WASTE_NAMES = {
    1: "Rest",
    2: "Glas",
    5: "GFT",
    6: "Papier",
    7: "Textiel",
    23: "Unknown",
    25: "Plastic",
    31: "KCA",
}
WASTE_NAME_NULL = "Unknown"
WASTE_NAME_MISSING = "Unkown"

# Fraction names the weigh feed spells differently.
FRACTION_ALIASES = {
    "": "Rest",
    "1": "Rest",
    "Kunststof": "Plastic",
    "Gft": "GFT",
    "Pmd": "PMD",
}
DEFAULT_FRACTION = "Rest"

# Kilograms per cubic metre.
KG_PER_M3 = {
    "Rest": 100,
    "Papier": 70,
    "Glas": 300,
    "Plastic": 25,
    "Kunststof": 25,
    "Textiel": 120,
    "GFT": 400,
}

# Empty weight in kilograms of a press container.
PRESS_TARE_KG = {"Rest": 1520, "Papier": 850, "Glas": 850}

# Starts of dates that mean "no date".
BAD_DATE_STARTS = ("000", "-0", "-10")

MIN_TRUCK_WEIGHT = 250
DATE_KEYS = ("created_at", "placing_date", "warranty_date", "operational_date")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def json_value(json: Column | str, path: str, dtype: str) -> Column:
    """Value at a JSON path; NULL when absent or not of the type."""
    return F.try_variant_get(F.try_parse_json(col(json)), path, dtype)


def left_text(c: Column | str, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def strip_whitespace(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\s+", "")


def remove_blanks(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit(""))


# A word begins at a capital after a small letter or digit, or before a small letter.
WORD_BORDER = "(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"


def snake_name(name: str) -> str:
    """CamelCase schema name in snake_case."""
    return re.sub(WORD_BORDER, "_", name).lower()


def snake_keys(m: Column | str) -> Column:
    """Map column with its CamelCase keys in snake_case."""
    return F.transform_keys(col(m), lambda key, _value: F.lower(F.regexp_replace(key, WORD_BORDER, "_")))


def safe_int(c: Column | str) -> Column:
    return F.trim(col(c).cast("string")).try_cast("int")


def safe_float(c: Column | str) -> Column:
    """Number or NULL; a text `nan` counts as no number."""
    number = F.trim(col(c).cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def combine_date_time(date: Column | str, time: Column | str) -> Column:
    both = (F.length(col(date)) > 0) & (F.length(col(time)) > 0)
    text = F.concat_ws(" ", col(date), col(time))
    return F.when(both, F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def drop_bad_date(c: Column | str) -> Column:
    """Text date, NULL where it starts like a placeholder. Apply before any cast."""
    text = col(c)
    bad = F.lit(False)
    for start in BAD_DATE_STARTS:
        bad = bad | text.startswith(start)
    return F.when(~bad, text)


def waste_name(json: Column | str) -> Column:
    """Waste name of a container record: a JSON null, an absent key and an
    unlisted code give different names."""
    variant = F.try_variant_get(F.try_parse_json(col(json)), "$.waste_type", "variant")
    code = F.try_variant_get(variant, "$", "int")
    return (
        F.when(variant.isNull(), F.lit(WASTE_NAME_MISSING))
        .when(F.is_variant_null(variant), F.lit(WASTE_NAME_NULL))
        .otherwise(F.coalesce(F.try_element_at(literal_map(WASTE_NAMES), code), F.lit(WASTE_NAME_MISSING)))
    )


def canonical_fraction(c: Column | str | None) -> Column:
    """Fraction under its usual name; no column means residual waste, no value stays none."""
    if c is None:
        return F.lit(DEFAULT_FRACTION)
    return F.coalesce(F.try_element_at(literal_map(FRACTION_ALIASES), col(c)), col(c))


def weights(first: Column | str, second: Column | str, net: Column | str) -> dict[str, Column]:
    """Integer weights and whether the weighing is valid."""
    f, s, n = safe_int(first), safe_int(second), safe_int(net)
    valid = (
        F.coalesce(s >= MIN_TRUCK_WEIGHT, F.lit(False))
        & F.coalesce(n >= 0, F.lit(False))
        & F.coalesce(f >= MIN_TRUCK_WEIGHT, F.lit(True))
    )
    return {"first_weight": f, "second_weight": s, "net_weight": n, "valid": valid}


def set_flag(attrs: Column | str, key: str) -> Column:
    """Attribute map with `key` set to true, whether or not it was there."""
    others = F.map_filter(col(attrs), lambda k, _v: k != F.lit(key))
    return F.map_concat(others, F.create_map(F.lit(key), F.lit("true")))


def chauffeur_attributes(summary: Column | str) -> Column:
    return F.create_map(F.lit("chauffeur"), col(summary))


def rounded(c: Column) -> Column:
    """Whole number, halves to even, as the integer cast of the source does."""
    return F.rint(c).cast("bigint")


def site_key(x: Column | str, y: Column | str, district: Column | str, area: Column | str) -> Column:
    """Site key from a rounded centroid and the codes around it; missing codes leave no trace."""
    def blank(c: Column | str) -> Column:
        return F.coalesce(col(c).cast("string"), F.lit(""))
    return F.concat(
        rounded(col(x)).cast("string"), F.lit("-"), rounded(col(y)).cast("string"),
        F.lit("-"), blank(district), blank(area),
    )


def period_parts(ts: Column | str, iso_year: bool = False) -> dict[str, Column]:
    """ISO week, month and calendar year; `iso_year` pairs the week with its own year."""
    t = col(ts)
    year = F.extract(F.lit("YEAROFWEEK"), t) if iso_year else F.year(t)
    return {"week": F.weekofyear(t), "month": F.month(t), "year": year}


def capacity(total_kg: Column | str, volume: Column | str, fraction: Column | str) -> Column:
    """How often the volume was filled; only for a known density and positive inputs."""
    density = F.try_element_at(literal_map(KG_PER_M3), col(fraction)).cast("double")
    kg, m3 = col(total_kg).cast("double"), col(volume).cast("double")
    return F.when((kg > 0) & (m3 > 0) & density.isNotNull(), kg / density / m3)


def corrected_press_weights(
    first: Column | str, second: Column | str, net: Column | str,
    fraction: Column | str, district: Column | str, valid: Column | str,
) -> dict[str, Column]:
    """Net weight and validity of weighings made with press containers, which
    lack a first weight: the tare comes off the second one."""
    tare = F.try_element_at(literal_map(PRESS_TARE_KG), col(fraction))
    applies = F.coalesce(
        (col(first) == 0) & (col(second) > 840) & (col(second) == col(net))
        & (col(district) == "N") & tare.isNotNull(),
        F.lit(False),
    )
    return {
        "net_weight": F.when(applies, col(second) - tare).otherwise(col(net)),
        "valid": F.when(applies, F.lit(True)).otherwise(col(valid)),
    }


def choice_label(name: Column | str, code: Column | str) -> Column:
    return F.format_string("%s (%s)", col(name), col(code))


def alias_all(columns: Mapping[str, Column]) -> Iterable[Column]:
    return [c.alias(name) for name, c in columns.items()]
