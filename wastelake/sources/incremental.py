"""High-water marks: what is new since the last load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

FIRST_FILL_LEVEL = "2014-01-01 00:00:00"
FIRST_HISTORY_DAY = "2018-10-01 00:00:00"


def new_weigh_pages(raw: DataFrame, measurements: DataFrame, inclusive: bool = False) -> DataFrame:
    """Pages later than the latest measurement of their system, one per (system, time).

    `inclusive` also keeps pages that end at the mark. The least ids are found first, by hashing, and only
    their pages are gathered: the texts of all others are neither sorted nor shuffled.
    """
    marks = measurements.groupBy("system_id").agg(F.max("weigh_at").alias("mark"))
    later = F.col("weigh_at") >= F.col("mark") if inclusive else F.col("weigh_at") > F.col("mark")
    fresh = raw.join(F.broadcast(marks), "system_id", "left").filter(  # a row per system
        F.col("mark").isNull() | later).drop("mark")
    others = [c for c in raw.columns if c not in ("system_id", "weigh_at")]
    least = fresh.groupBy("system_id", "weigh_at").agg(F.min("id").alias("_id")).withColumnsRenamed(
        {"system_id": "_system", "weigh_at": "_at"})
    is_least = (F.col("system_id").eqNullSafe(F.col("_system")) & F.col("weigh_at").eqNullSafe(F.col("_at"))
                & F.col("id").eqNullSafe(F.col("_id")))
    return (
        fresh.join(least, is_least, "left_semi").groupBy("system_id", "weigh_at")
        .agg(F.min_by(F.struct(*others), "id").alias("row"))
        .select("system_id", "weigh_at", "row.*")
        .select(*raw.columns)
    )


def _slot(system: Column, start: Column) -> Column:
    return F.concat_ws("_", system.cast("string"), F.date_format(start, "yyyy-MM-dd"))


def store_weigh_pages(raw: DataFrame, path: str, load: str, period: str = "day", files: int = 1) -> None:
    """Add keyed weigh pages to a table in folders by system and period (`day`, `month` or `year`).

    The pages of a load lie below its name, so a load that is repeated replaces itself. Each
    folder gets up to `files` files, written by as many tasks, for systems with many pages.
    A small table beside the pages lists the folders of each load.
    """
    spark = raw.sparkSession
    slot = _slot(F.col("system_id"), F.date_trunc(period, "weigh_at"))
    (
        raw.withColumn("slot", slot).repartition("slot", F.pmod(F.xxhash64("id"), F.lit(files)))
        .write.mode("overwrite").partitionBy("slot").parquet(f"{path}/pages/load={load}")
    )
    written = spark.read.schema(f"{_schema_text(raw)}, slot string").parquet(f"{path}/pages/load={load}")
    key = F.split("slot", "_")
    written.select("slot").distinct().select(
        "slot", key[0].cast("bigint").alias("system_id"), key[1].cast("date").alias("start"), F.lit(period).alias("period"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/slots/load={load}")  # one row per folder


def _schema_text(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def due_slots(spark: SparkSession, path: str, measurements: DataFrame) -> DataFrame:
    """Folders of `store_weigh_pages` that may hold pages later than the mark of their system."""
    marks = measurements.groupBy("system_id").agg(F.max("weigh_at").alias("mark"))
    slots = spark.read.parquet(f"{path}/slots").select("slot", "system_id", "start", "period").distinct()
    oldest = F.coalesce(F.expr("date_trunc(period, mark)").cast("date"), "start")
    return slots.join(marks, "system_id", "left").select("slot", "start", oldest.alias("oldest"))


def new_stored_weigh_pages(
    spark: SparkSession, path: str, raw_schema: str, measurements: DataFrame, inclusive: bool = False,
) -> DataFrame:
    """`new_weigh_pages` of a table of `store_weigh_pages`; reads the folders from the marks on.

    The list of folders that are due is written and joined with the pages' folder names. Where
    it is small enough to broadcast, the scan waits for it and skips all other folders. It
    is larger only if so many are due that they are most of the table.
    """
    due = cut(due_slots(spark, path, measurements)).filter(F.col("start") >= F.col("oldest")).select("slot")
    pages = spark.read.schema(f"{raw_schema}, load string, slot string").parquet(f"{path}/pages")
    fresh = pages.join(due, "slot", "left_semi").drop("slot", "load")
    return new_weigh_pages(fresh, measurements, inclusive)


def _mark(df: DataFrame, column: str) -> Column | None:
    """The latest time of a table as a literal, so that a scan can skip what is older; None without any.

    One value reaches the driver. It travels as text in the session's time zone.
    """
    text = df.agg(F.max(F.col(column).cast("timestamp")).cast("string")).first()[0]
    return None if text is None else F.lit(text).cast("timestamp")


def new_snapshots(raw: DataFrame, states: DataFrame) -> DataFrame:
    """Snapshots scraped after the latest stored state; all of them when none is stored."""
    mark = _mark(states, "scraped_at")
    return raw if mark is None else raw.filter(F.col("scraped_at") > mark)


def new_fill_level_pages(raw: DataFrame, levels: DataFrame, inclusive: bool = False) -> DataFrame:
    """Fill-level pages later than the latest stored level, else since the first year."""
    mark = _mark(levels, "time")
    mark = F.lit(FIRST_FILL_LEVEL).cast("timestamp") if mark is None else mark
    return raw.filter(F.col("time") >= mark if inclusive else F.col("time") > mark)


def resume_points(systems: DataFrame, raw: DataFrame) -> DataFrame:
    """Date and time to resume each system at; NULLs for a system without pages."""
    last = raw.groupBy("system_id").agg(F.max("weigh_at").alias("at"))
    return systems.join(last, "system_id", "left").select(
        "system_id",
        F.date_format("at", "yyyy-MM-dd").alias("date"),
        F.date_format("at", "HH:mm:ss").alias("time"),
    )


def missing_days(raw: DataFrame, now: Column, start: str = FIRST_HISTORY_DAY) -> DataFrame:
    """One-day windows `(after, until)` from the latest page time up to now."""
    day = F.expr("interval 1 day")
    latest = raw.agg(F.coalesce(F.max("time").cast("timestamp"), F.lit(start).cast("timestamp")).alias("first"))
    now = now.cast("timestamp")
    return (
        latest.filter(F.col("first") < now)
        .select(F.explode(F.sequence(F.col("first"), now, day)).alias("after"))
        .filter(F.col("after") < now)
        .select("after", (F.col("after") + day).alias("until"))
    )


def page_progress(pages: DataFrame, limit: int) -> DataFrame:
    """Per page of a range: whether its last time lies before the range end and whether
    the page is full, so that another one must follow. Needs no look at other pages."""
    return pages.select(
        *pages.columns,
        (F.col("last_time") < F.col("until")).alias("in_range"),
        (F.col("count") == limit).alias("is_full"),
    )
