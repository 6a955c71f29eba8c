"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words: its share by weight of the whole mix, at most
a number of times its own size, with the excess shared again. A target is met by complete
epochs of the source and, for what is left, by a sample without replacement: a document's
key is an exponential variate divided by its quality weight, and documents are taken in
the order of their keys until the running sum of their sizes meets the budget. The document
at the border is taken when more than half of it fits, so a source misses its target by at
most half a document.

The running sum is found by narrowing: sizes are added up per source and key range, only
the range that the budget falls in is looked at more closely, twice, and only documents of
the last narrow range are sorted. No source is ever sorted as a whole.

The quality weight is the share of words among words and symbol characters. The variate is
drawn from the id's MD5, so reruns agree. Sources are ranked by code point, null last, and
take the weights in turn. Nulls count as empty texts of size 0, which never take words. Rows
of equal id have equal keys and go by size. An empty table gives an empty result. Further
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SYMBOLS = "#*$%&|<>!"
RANGES = 1024


def variate(doc_id: Column, seed: int) -> Column:
    """A number between 0 and 1 from 52 bits of the id's MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def sized(docs: DataFrame, seed: int, doc_id: str, source: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """`(doc_id, source, size, key, coarse, fine)` of every row, and the carried columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.regexp_count(body, F.lit(common.WORD)).cast("bigint").alias("size"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).alias("symbols"), *carry)
    weight = F.when(F.col("size") > 0, F.col("size") / (F.col("size") + F.col("symbols"))).otherwise(F.lit(1.0))
    place = (F.lit(1.0) - F.exp(-F.col("key"))) * RANGES  # rises with the key, below RANGES or equal to it
    return rows.withColumn("key", -F.log(variate(F.col("doc_id"), seed)) / weight).withColumn("place", place).select(
        "doc_id", "source", "size", "key", F.floor("place").alias("coarse"),
        F.floor((F.col("place") - F.floor("place")) * RANGES).alias("fine"), *carry)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`(source, source_size, target)` from the size of each source.

    Shares are filled like vessels: sources by ascending limit per weight reach their limit as
    long as it is within what their weight gets of the rest. One row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumn("weight", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int"))).withColumn(
        "limit", (F.col("source_size") * most).cast("double"))
    filled = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, on = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumn("total", F.sum("source_size").over(whole) * F.lit(share)).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(on)).withColumn(
        "position", F.row_number().over(filled))
    open_ = F.when(F.col("limit") > F.col("weight") * F.col("level"), F.struct("position", "level"))
    border = levels.withColumn("border", F.min(open_).over(whole))
    reached = F.col("border").isNull() | (F.col("position") < F.col("border.position"))
    return border.select("source", "source_size", F.when(reached, F.col("limit")).otherwise(
        F.col("weight") * F.col("border.level")).alias("target"))


def narrowed(rows: DataFrame, budgets: DataFrame, by: str) -> DataFrame:
    """`(source, at, left)`: the range of `by` that each budget falls in, and what is left there.

    A source whose rows all fit has no row.
    """
    sums = rows.groupBy("source", by).agg(F.sum("size").alias("sum"))
    upto = F.sum("sum").over(Window.partitionBy("source").orderBy(by))
    met = sums.withColumn("upto", upto).join(budgets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    over = met.filter(F.col("upto") > F.col("budget"))
    first = over.groupBy("source").agg(F.min(F.struct(F.col(by).alias("at"), (F.col("upto") - F.col("sum")).alias("before"), "budget")).alias("m"))
    return first.select("source", F.col("m.at").alias("at"), (F.col("m.budget") - F.col("m.before")).alias("budget"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 0,
          doc_id: str = "doc_id", source: str = "source", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """`(doc_id, size, source_size, target, taken, times)` of every row, and the carried columns.

    `times` is how often the mix has the document and `taken` the words that makes.
    """
    rows = cut(sized(docs, seed, doc_id, source, text, carry))
    wanted = cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = wanted.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    budgets = plan.select("source", "budget")
    coarse = narrowed(rows, budgets, "coarse").withColumnRenamed("at", "coarse_at")
    inside = rows.join(coarse.select(F.col("source").alias("of"), "coarse_at"), F.col("source").eqNullSafe(F.col("of"))).filter(
        "coarse = coarse_at").drop("of")
    fine = narrowed(inside, coarse.select("source", "budget"), "fine").withColumnRenamed("at", "fine_at")
    borders = cut(plan.drop("budget").withColumnRenamed("source", "s").join(
        coarse.select(F.col("source").alias("cs"), "coarse_at"), F.col("s").eqNullSafe(F.col("cs")), "left").join(
        fine.select(F.col("source").alias("fs"), "fine_at", "budget"), F.col("s").eqNullSafe(F.col("fs")), "left").drop("cs", "fs"))
    placed = rows.join(borders, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    below = F.col("coarse_at").isNull() | (F.col("coarse") < F.col("coarse_at")) | (
        (F.col("coarse") == F.col("coarse_at")) & (F.col("fine") < F.col("fine_at")))
    at_border = F.coalesce((F.col("coarse") == F.col("coarse_at")) & (F.col("fine") == F.col("fine_at")), F.lit(False))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    close = placed.filter(at_border).withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn(
        "more", (F.col("before") + F.col("size") / 2 <= F.col("budget")).cast("int")).drop("before")
    clear = placed.filter(~at_border).withColumn("more", F.when(below, 1).otherwise(0))
    times = F.col("epochs") + F.col("more")
    return clear.unionByName(close).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).cast("bigint").alias("taken"), times.cast("int").alias("times"), *carry)


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The rows of the mix with all columns, each as often as the mix has it."""
    rows, row = common.numbered(docs)
    times = mixed(rows, doc_id=doc_id, source=source, text=text, carry=(row,), **options).filter("times > 0").select(row, "times")
    # A union of whole epochs, so that no column of the rows can clash with a count.
    out = rows.join(times.select(row), row, "left_semi")
    more = times.filter("times > 1").select(row, F.explode(F.sequence(F.lit(2), F.col("times"))).alias("epoch")).select(row)
    return out.unionByName(rows.join(more, row)).select(*docs.columns)


def oracle() -> str:
    """The same in DuckDB's SQL, with the query's parameters."""
    return f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{common.WORD}')) AS size,
         length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', '')) AS symbols,
         (('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
keyed AS (
  SELECT *, -ln(u) / CASE WHEN size > 0 THEN size::DOUBLE / (size + symbols) ELSE 1 END AS key FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, list_extract([{', '.join(f'{w}::DOUBLE' for w in WEIGHTS)}], rank % {len(WEIGHTS)} + 1) AS weight, (source_size * {MOST})::DOUBLE AS cap
  FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * {SHARE}::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / weight, rank) AS position
  FROM weighed),
border AS (
  SELECT min(position) AS edge, arg_min(level, position) AS level FROM levels WHERE cap > weight * level),
wanted AS (
  SELECT source, source_size, CASE WHEN edge IS NULL OR position < edge THEN cap ELSE weight * border.level END AS target
  FROM levels, border),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM wanted),
summed AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.whole,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken,
       (whole + CASE WHEN before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END)::INTEGER AS times
FROM summed"""
