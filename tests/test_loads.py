"""Publication of tables, checks of the writing job, errors of list pages and stream state."""

import datetime
import json
import re

import pytest
from pyspark.sql import functions as F

from wastelake import sinks
from wastelake.operators import checks, paging
from wastelake.session import cut, work_path
from wastelake.sources import incremental, pages as pg
from wastelake.streaming import latest


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or ("id",))).collect())


def test_a_failed_refresh_leaves_the_old_table(spark):
    path = work_path(spark, "refresh")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, path)
    sinks.full_refresh(spark.range(3), path)
    broken = spark.range(100, numPartitions=4).withColumn(
        "id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.full_refresh(broken, path)
    assert sinks.versions(spark, path) == {1: True, 2: False}
    assert ids(sinks.published(spark, path)) == [(0,), (1,), (2,)]
    old = sinks.published(spark, path)
    sinks.full_refresh(old.union(spark.range(3, 4)), path)  # reads what it replaces
    assert ids(sinks.published(spark, path)) == [(0,), (1,), (2,), (3,)]
    assert ids(old) == [(0,), (1,), (2,)]  # a reader of the version before goes on
    assert sinks.versions(spark, path) == {1: True, 3: True}
    sinks.full_refresh(spark.range(0), path)
    assert ids(sinks.published(spark, path)) == [] and list(sinks.versions(spark, path)) == [3, 4]


def test_tables_are_published_together_or_not_at_all(spark):
    path = work_path(spark, "tables")
    rules = {"a": [checks.at_least(2)], "b": checks.within({"even": (F.col("id") % 2 == 0, 0, 3)})}
    sinks.publish(spark, path, {"a": spark.range(2), "b": spark.range(6)}, rules)
    with pytest.raises(ValueError, match="b.even = 4, not in 0..3"):
        sinks.publish(spark, path, {"a": spark.range(5), "b": spark.range(7)}, rules)
    with pytest.raises(ValueError, match="a.rows = 0"):
        sinks.publish(spark, path, {"a": spark.range(5).filter("id > 7"), "b": spark.range(1)}, rules)
    assert ids(sinks.published(spark, path, "a")) == [(0,), (1,)] and sinks.published(spark, path, "b").count() == 6


def test_checks_count_in_the_pass_that_writes(spark):
    """The rows are counted before the filter, each once, while the table is written."""
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch
    rows = spark.range(1000, numPartitions=8).mapInArrow(counting, "id bigint")
    watched = checks.Watched(rows, [checks.at_least(1000), *checks.within({"low": (F.col("id") < 10, 0, 10)})])
    table = cut(watched.df.filter("id >= 10"))
    assert watched.stop_unless_held("t") == {"rows": 1000, "low": 10}
    assert table.count() == 990 and reads.value == 1000
    empty = checks.Watched(spark.createDataFrame([], "id int"), [checks.at_least(1)])
    cut(empty.df)
    with pytest.raises(ValueError, match="t.rows = 0"):
        empty.stop_unless_held("t")


def test_list_pages_are_read_or_errors(spark):
    good = {"ids": '{"wells": [{"id": 1}], "count": 3}', "known": '{"results": []}', "population": '{"results": [{"jaar": "2000"}]}',
            "alerts": '{"alerts": [{"id": 1}]}', "sensors": '[{"result": {}}, {"result": {"data": [{"Id": 1}]}}]'}
    empty = {"ids": '{"wells": []}', "alerts": '{"alerts": []}', "sensors": '[{"result": {"data": []}}]',
             "population": '{"results": []}', "known": '{"results": []}'}
    for source, text in good.items():
        texts = [text, empty[source], None, " ", text[:-1], "<html>", "{}" if source != "sensors" else "[]", '"busy"']
        raw = spark.createDataFrame(list(enumerate(texts)), "id bigint, data string").withColumn("scraped_at", F.lit(None).cast("timestamp"))
        read = pg.listed(raw, source)
        reasons = dict(ids(read, "id", F.coalesce("reason", F.lit("read"))))
        assert reasons == {0: "read", 1: "read", 2: "no text", 3: "no text", 4: "malformed", 5: "malformed", 6: "no list",
                           7: "malformed"}, source
        assert pg.listed_errors(raw, source).count() == 6
    raw = spark.createDataFrame([(1, json.dumps({"alerts": [{"id": 7}]})), (2, "{")], "id bigint, data string").withColumn(
        "scraped_at", F.lit(None).cast("timestamp"))
    assert ids(pg.collection_items(raw, "alerts")) == ids(pg.collection_items(pg.listed(raw, "alerts"), "alerts")) == [(7,)]


STATE = "scraped_at timestamp, id bigint, description string, filling int, weight double"


def run(spark, source, out, marks, reach, *rows):
    """Land a file of states given as (minute, id, name) and run the stream to its end; the rows of state it holds."""
    spark.createDataFrame([(m, i, n, None if i % 2 else i) for m, i, n in rows], "m int, id bigint, description string, filling int").select(
        F.timestamp_seconds(F.col("m") * 60).alias("scraped_at"), "id", "description", "filling", F.lit(None).cast("double").alias("weight"),
    ).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(STATE).parquet(source)
    query = latest.latest_states(stream, "scraped_at", ["id"], out, marks, reach=reach)
    query.awaitTermination()
    return query.lastProgress["stateOperators"][0]


def minutes(df):
    return ids(df, (F.unix_seconds("scraped_at") / 60).cast("int"), "id", "description", "filling")


def test_latest_states_survive_a_restart_and_are_forgotten(spark):
    source, out, marks = (work_path(spark, n) for n in ("in", "out", "marks"))
    order = ("scraped_at", ["id"])
    run(spark, source, out, marks, "1 hour", (0, 1, "a"), (10, 2, "a"), (10, 3, "a"), (5, 4, "b"), (7, 5, None))
    first = minutes(spark.read.parquet(out))  # one row per container and batch
    assert first == [(5, 4, "b", 4), (7, 5, None, None), (10, 3, "a", None)]
    # A state sent again, an older one, and a newer one of another container.
    run(spark, source, out, marks, "1 hour", (10, 3, "a"), (9, 9, "a"), (40, 6, "b"))
    assert {r[1] for r in minutes(spark.read.parquet(out))} == {3, 4, 5, 6}
    # Time goes on by hours: all others are forgotten, later states of the old time are dropped.
    run(spark, source, out, marks, "1 hour", (600, 7, "c"))
    run(spark, source, out, marks, "1 hour", (601, 8, "c"), (41, 10, "b"))
    got = spark.read.parquet(out)
    assert {r[1] for r in minutes(got)} == {3, 4, 5, 6, 7, 8}
    assert minutes(latest.within_last_hour(spark, out, F.timestamp_seconds(F.lit(601 * 60)), *order)) == [(601, 8, "c", 8)]
    # A forgotten container that is seen again is new.
    state = run(spark, source, out, marks, "1 hour", (602, 12, "b"))
    assert {r[1] for r in minutes(latest.stored_states(spark, out, *order)) if r[2] == "b"} == {12}
    assert state["numRowsTotal"] <= 2 * 3  # a row and two timer entries of each of b and c


def test_many_states_of_one_container_are_reduced_before_the_shuffle(spark):
    import pyarrow as pa
    batch = pa.record_batch({"k": ["x", None, "x", None, "y"], "t": [3, 1, None, None, 2], "i": [1, 2, 3, 4, 5]})
    got = pa.Table.from_batches(latest._greatest("k", ["t", "i"])([batch])).to_pylist()
    assert sorted(r["i"] for r in got) == [1, 2, 5]


def test_only_folders_from_the_marks_on_are_read(spark):
    path = work_path(spark, "raw")
    days = [f"2020-01-{d:02d} 10:00:00" for d in range(1, 21)]
    raw = spark.createDataFrame([(s * 100 + i, s, d) for s in (1, 2) for i, d in enumerate(days)], "id bigint, system_id bigint, day string")
    raw = raw.select("id", "system_id", F.col("day").cast("timestamp").alias("weigh_at"))
    incremental.store_weigh_pages(raw, path, "a")
    incremental.store_weigh_pages(raw, path, "a")  # a repeated load replaces itself
    late = raw.filter("id = 119").withColumns({"id": F.lit(7).cast("bigint"), "system_id": F.lit(3).cast("bigint")})
    incremental.store_weigh_pages(late, path, "b", files=3)
    schema = "id bigint, system_id bigint, weigh_at timestamp"
    marks = raw.filter("id = 117 or id = 203")
    fresh = incremental.new_stored_weigh_pages(spark, path, schema, marks)
    assert [r[0] for r in ids(fresh)] == [7, 118, 119, *range(204, 220)]
    assert [r[0] for r in ids(incremental.new_stored_weigh_pages(spark, path, schema, marks, inclusive=True))] == [
        7, 117, 118, 119, *range(203, 220)]
    plan = fresh._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    # The pages are all of the folders that are due: three of system 1, 17 of system 2, one of 3.
    due = incremental.due_slots(spark, path, marks).filter("start >= oldest")
    assert due.count() == 3 + 17 + 1


def test_deep_pages_read_the_parts_that_hold_them(spark):
    path = work_path(spark, "pages")
    rows = spark.range(10_000).select("id", (F.col("id") % 7).alias("k")).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    order, schema = "-k,id", "id bigint, k bigint"
    paging.store_pages(rows, order, path, 500)
    expected = [r[0] for r in paging.ordered(rows, order).select("id").collect()]
    for number in (1, 2, 77, 250, 500):
        got = paging.stored_page(spark, path, schema, order, number, 20)
        assert [r["id"] for r in got.collect()] == expected[(number - 1) * 20:number * 20]
        assert got.first()["total"] == 10_000
    plan = paging.stored_page(spark, path, schema, order, 300, 20)._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert len(re.findall(r"\d+", filters.partition(" IN ")[2] or filters.rpartition("=")[2])) <= 2, filters
    assert paging.stored_page(spark, path, schema, order, 501, 20).count() == 0
    with pytest.raises(ValueError):
        paging.stored_page(spark, path, schema, order, 1, 10 ** 6)
    empty = work_path(spark, "pages")
    paging.store_pages(rows.filter("id < 0"), order, empty)
    assert paging.stored_page(spark, empty, schema, order).count() == 0


def test_many_list_parts_need_few_ranges(spark):
    """What the driver samples grows with the ranges of a shuffle, so those must not grow with the parts."""
    path, rows = work_path(spark, "pages"), spark.range(10_000).select("id", (F.col("id") % 7).alias("k"))
    paging.store_pages(rows, "k,-id", path, 50)
    parts = spark.read.parquet(f"{path}/parts").orderBy("part").collect()
    ranges = {p["part"] >> paging.RANGE_BITS for p in parts}
    assert len(ranges) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(p["n"] == 50 for p, q in zip(parts, parts[1:]) if p["part"] >> paging.RANGE_BITS == q["part"] >> paging.RANGE_BITS)
    assert parts[-1]["first"] + parts[-1]["n"] == 10_000
    expected = [r[0] for r in paging.ordered(rows, "k,-id").select("id").collect()]
    assert [r["id"] for r in paging.stored_page(spark, path, "id bigint, k bigint", "k,-id", 333, 30).collect()] == expected[9960:9990]


def test_headers_of_weigh_pages_are_looked_up_in_compiled_code(spark):
    short = list(pg.REQUIRED_WEIGH_FIELDS)
    value = {"SystemId": "7", "Date": "2024-01-20", "Time": "10:00:00"}
    record = lambda names, **other: [(value | other).get(n, n.lower()) for n in names]
    text = lambda names, records: json.dumps({"Fields": names, "Records": records})
    swapped = [*reversed(short), "Location"]
    found = {
        1: text(short, [record(short, Time="09:00:00"), record(short)]),
        2: text(swapped, [record(swapped, Time="09:00:00"), record(swapped, Date="")]),  # the last record has no time
        3: text(short, [record(short, SystemId="x"), record(short)[:3]]),  # and this page neither system nor time
        4: text(short[1:], [record(short[1:])]), 5: "not json", 6: json.dumps({"Fields": short}), 7: None,
        8: text([None, *short], [["-", *record(short)]]),
    }
    pages = spark.createDataFrame([(i, None, t) for i, t in found.items()], "id bigint, scraped_at timestamp, data string")
    keyed = {r["id"]: (r["system_id"], str(r["weigh_at"])) for r in pg.weigh_raw(pages).collect()}
    assert keyed == {1: (7, "2024-01-20 10:00:00"), 2: (7, "2024-01-20 09:00:00"), 8: (7, "2024-01-20 10:00:00")}
    assert sorted(r["id"] for r in pg.unkeyed_weigh_pages(pages).collect()) == [3, 4, 5, 6, 7]
    records = pg.weigh_records(pages)
    assert sorted(r["page_id"] for r in records.collect()) == [1, 1, 2, 2, 3, 3, 8]
    assert {r["Location"] for r in records.filter("page_id = 2").collect()} == {"location"}
    assert "lambda" not in records._jdf.queryExecution().optimizedPlan().toString()


def test_only_least_pages_are_gathered(spark):
    """One page per system and time, the least id with all it has; no sort of all texts."""
    schema = "id bigint, scraped_at timestamp, system_id bigint, weigh_at timestamp, data string"
    at = lambda day: datetime.datetime(2024, 1, day)
    rows = [(3, None, 1, at(1), "c"), (2, None, 1, at(1), "b"), (9, None, 1, at(2), "i"), (1, None, None, at(1), "a"),
            (4, None, None, at(1), "d"), (5, None, 2, None, "e"), (None, None, 2, None, "n"), (6, None, 3, at(1), "f"), (6, None, 3, at(1), "f")]
    raw = spark.createDataFrame(rows, schema)
    fresh = incremental.new_weigh_pages(raw, spark.createDataFrame([], "system_id bigint, weigh_at timestamp"))
    assert sorted((r["id"], r["data"]) for r in fresh.collect()) == [(1, "a"), (2, "b"), (5, "e"), (6, "f"), (9, "i")]
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert "min(id" in plan and "LeftSemi" in plan
