"""Order and pages of the list queries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut
from . import filters as fl
from .shape import sparse

# Page sizes and default orders of the lists.
PAGE_SIZE, SITE_PAGE_SIZE, MAX_PAGE = 20, 10, 9000
PAGE_SIZES = {"sites": SITE_PAGE_SIZE}
PART, PART_ROWS = "_part", 1_000_000
RANGE_BITS = 33  # of a part's number; as many bits as a row's number within its partition has
CURSOR_SIZES = {"measurements": (100, 9000), "sensor_states": (100, 5000), "fill_levels": (100, 9000)}
DEFAULT_ORDER = {
    "containers": "id", "wells": "id", "container_types": "id", "sites": "id", "supplier_sites": "id",
    "measurements": "-weigh_at", "fill_levels": "-time", "sensor_states": "-id",
    "site_week_stats": "-year", "site_month_stats": "-year", "area_week_stats": "-year", "area_month_stats": "-year",
}


def order_columns(spec: str) -> list[Column]:
    """`a,-b` as sort columns; NULLs come last in ascending order and first in descending."""
    out = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        out.append(F.col(part[1:]).desc_nulls_first() if part.startswith("-") else F.col(part).asc_nulls_last())
    return out


def ordered(df: DataFrame, spec: str) -> DataFrame:
    return df.orderBy(*order_columns(spec))


def default_ordered(df: DataFrame, entity: str) -> DataFrame:
    return ordered(df, DEFAULT_ORDER[entity])


def _allowed(size: int, largest: int) -> int:
    if size > largest:
        raise ValueError(f"a page has at most {largest} rows")
    return size


def numbered_rows(df: DataFrame, order: str, number: int = 1, size: int = PAGE_SIZE, largest: int = MAX_PAGE) -> DataFrame:
    """One numbered page; `order` should be unique."""
    size = _allowed(size, largest)
    return ordered(df, order).offset((number - 1) * size).limit(size)


def page(df: DataFrame, order: str, number: int = 1, size: int = PAGE_SIZE, largest: int = MAX_PAGE) -> DataFrame:
    """One numbered page with the total count."""
    total = df.agg(F.count("*").alias("total"))
    return numbered_rows(df, order, number, size, largest).crossJoin(F.broadcast(total))  # one row


def _schema_text(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def store_pages(df: DataFrame, order: str, path: str, part_rows: int = PART_ROWS) -> None:
    """Write a list in parts of about `part_rows` rows, in the order of its pages; `order` should be unique.

    The rows are sorted in ranges of up to PART_ROWS rows, or as many as a shuffle has partitions, and each
    range is cut into parts by row number: what the driver samples to find the ranges does not grow
    with the parts. A small table beside the parts has the number of rows in and before each.
    """
    spark, columns = df.sparkSession, order_columns(order)
    rows = cut(df)
    total = rows.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_ROWS))
    ranges = max(1, min(ranges, -(-total // part_rows)))
    within = F.floor(F.expr(f"monotonically_increasing_id() & {2 ** RANGE_BITS - 1}") / part_rows).cast("bigint")
    (
        rows.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
        .withColumn(PART, F.shiftleft(F.spark_partition_id().cast("bigint"), RANGE_BITS) + within)
        .write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    )
    if total:
        stored = spark.read.schema(f"{_schema_text(df)}, {PART} bigint").parquet(f"{path}/rows")
        counts = stored.groupBy(F.col(PART).alias("part")).agg(F.count("*").alias("n"))
    else:
        counts = spark.createDataFrame([], "part bigint, n bigint")
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # one row per part
    counts.select("part", "n", before.alias("first"), F.sum("n").over(everything).alias("total")).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/parts")


def stored_page(
    spark: SparkSession, path: str, schema: str, order: str, number: int = 1, size: int = PAGE_SIZE, largest: int = MAX_PAGE,
) -> DataFrame:
    """A page of the list that `store_pages` wrote, with the total count.

    Reads the parts that the page overlaps, which its number tells, one or two as a rule;
    a page at any depth costs the same. Their numbers are few: each has a row of the page.
    """
    start = (number - 1) * _allowed(size, largest)
    parts = spark.read.schema("part bigint, n bigint, first bigint, total bigint").parquet(f"{path}/parts")
    total = parts.agg(F.max("total").alias("total")).first()["total"] or 0
    held = parts.filter((F.col("first") < start + size) & (F.col("first") + F.col("n") > start)).orderBy("part").collect()
    rows = spark.read.schema(f"{schema}, {PART} bigint").parquet(f"{path}/rows")
    rows = rows.filter(F.col(PART).isin([p["part"] for p in held])).drop(PART)
    skipped = start - held[0]["first"] if held else 0
    return ordered(rows, order).offset(skipped).limit(size).withColumn("total", F.lit(total).cast("bigint"))


def cursor_page(df: DataFrame, key: str, size: int, cursor: tuple | None = None, tie: str = "id", largest: int = 9000) -> DataFrame:
    """Newest rows after a cursor, the pair of `key` and `tie` of the last row seen.

    `tie` tells rows of equal key apart, so no row is met twice or left out. Rows without a
    key come last. Rows are neither counted nor skipped, so any depth costs the same.
    """
    rest, later = df, F.col(tie)
    if cursor is not None:
        at, last = cursor
        tied = F.col(key).eqNullSafe(F.lit(at)) & (later < F.lit(last))
        rest = df.filter(tied if at is None else (F.col(key) < F.lit(at)) | tied | F.col(key).isNull())
    return rest.orderBy(F.col(key).desc_nulls_last(), later.desc()).limit(_allowed(size, largest))


def list_query(
    df: DataFrame, entity: str, params: Mapping[str, object] | None = None, fields: str | None = None,
    omit: str | None = None, order: str | None = None, number: int = 1, size: int | None = None,
) -> DataFrame:
    """Filter, order, page and pick fields, as one lazy plan; the list's own page size unless given."""
    rows = fl.apply_filters(df, params or {}, fl.FILTERS[entity])
    rows = numbered_rows(rows, order or DEFAULT_ORDER[entity], number, size or PAGE_SIZES.get(entity, PAGE_SIZE))
    return sparse(rows, fields, omit)
