"""The live feeds as Structured Streaming queries over landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import shape
from ..plans.feeds import weighed
from ..sinks import remove
from ..sources import incremental, pages as pg

PAGE = "id bigint, scraped_at timestamp, data string"


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_per_batch).json(path)


def _append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def sensor_states(pages: DataFrame, known_ids: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Snapshots → cleaned states; the checkpoint replaces the high-water mark."""
    return _append(shape.sensor_states(pages, known_ids), path, checkpoint)


def fill_levels(pages: DataFrame, site_names: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Fill-level pages → levels with the site linked to their supplier site's name.

    `site_names` is `(e_site_name, site_id)`, one row per name, found once per load.
    """
    levels = shape.fill_levels(pages).join(site_names, "e_site_name", "left")
    return _append(levels, path, checkpoint)


def weighings(
    pages: DataFrame, districts: DataFrame, areas: DataFrame, path: str, checkpoint: str,
) -> StreamingQuery:
    """Weigh pages → measurements; per system only pages later than what is stored.

    A batch writes to a folder of its own number, and the latest times of all systems so far
    to a marks table beside it. A batch that is run again after a failure replaces its earlier
    output and sees the marks of the batch before. Only the marks of the last two batches are
    kept: two rows per system, however many batches there were. Pages at the mark
    or before it are late or were sent twice, and are skipped. The marks are joined with the
    pages, so a system with many pages is not confined to one task.
    """
    marks = f"{path}-marks"

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = f"{path}/batch={number}"
        before = _marks(spark, marks, number - 1)
        fresh = incremental.new_weigh_pages(pg.weigh_raw(batch), before)
        weighed(fresh, districts, areas).write.mode("overwrite").parquet(done)
        seen = spark.read.parquet(done).select(F.col("system_id").cast("bigint").alias("system_id"), "weigh_at")
        latest = before.unionByName(seen).groupBy("system_id").agg(F.max("weigh_at").alias("weigh_at"))
        latest.write.mode("overwrite").parquet(f"{marks}/batch={number}")
        remove(spark, f"{marks}/batch={number - 2}")

    return (
        pages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _marks(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Latest time per system up to a batch; none before the first."""
    schema = "system_id bigint, weigh_at timestamp"
    return spark.createDataFrame([], schema) if batch < 0 else spark.read.schema(schema).parquet(f"{path}/batch={batch}")
