"""Joins and ranks that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Rows of one key that a task may be given; a key with more is split.
TASK_ROWS = 20_000


def hot_keys(df: DataFrame, keys: list[str], most: int = TASK_ROWS) -> DataFrame:
    """Keys with more than `most` rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*keys)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
    condition: Column | None = None, spread: Column | None = None, salts: int | None = None, most: int = TASK_ROWS,
) -> DataFrame:
    """Equi join that spreads the rows of a hot left key over several tasks.

    Rows of hot keys get a salt from `spread` (their whole content unless given) and the
    right rows of those keys are repeated once per salt; all other keys join as usual.
    `left` is read twice, so it should be cheap or materialised. Keys keep one column each.
    """
    spark = left.sparkSession
    salts = salts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(left, keys, most).withColumn("_hot", F.lit(True))
    spread = F.xxhash64(*left.columns) if spread is None else spread
    salted_left = left.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(spread, F.lit(salts))).otherwise(F.lit(0)).cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = (
        right.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    on = keys + ["_salt"]
    if condition is None:
        return salted_left.join(salted_right, on, how).drop("_salt")
    renamed = salted_right
    for k in on:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    equal = condition
    for k in on:
        equal = equal & (F.col(k) == F.col(f"_r_{k}"))
    joined = salted_left.join(renamed, equal, how)
    return joined.drop("_salt", *[f"_r_{k}" for k in on])


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str = "rown") -> DataFrame:
    """`row_number` per key without bringing a whole group into one task.

    Rows are range-partitioned on (keys, order), so a hot key covers several partitions.
    Each partition numbers its own rows; a key's rows in earlier partitions are added.
    `order` must tell the rows of a key apart.
    """
    ranges = cut(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    counts = ranges.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_k_part"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_k_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    return (
        ranges.withColumn("_local", local).join(offsets, same, "inner")
        .withColumn(name, (F.col("_local") + F.col("_offset")).cast("bigint"))
        .select(*df.columns, name)
    )
