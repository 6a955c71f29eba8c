"""Skewed joins and ranks, short ids, feeds, filters and checks on small frames."""

import json

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wastelake.operators import checks, filters as fl, links, merge, paging, shape, shortid, skew, stats
from wastelake.plans import feeds
from wastelake.sources import incremental, pages as pg


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_ranked_in_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1200, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
                                  ((F.col("id") * 7919) % 3001).alias("v"))
    got = rows(skew.ranked(df, ["k"], ["v"]), "k", "v", "rown")
    want = rows(df.selectExpr("k", "v", "row_number() over (partition by k order by v) rown"), "k", "v", "rown")
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_changes_nothing(spark, how):
    left = spark.range(900).select("id", F.when(F.col("id") < 400, F.lit(1)).otherwise(F.col("id") % 300).alias("k"))
    right = spark.range(0, 200, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    right = right.unionByName(right.filter("k < 4"))
    got = skew.salted_join(left, right, ["k"], how, salts=4, most=100)
    want = left.join(right, "k", how)
    assert rows(got, *sorted(got.columns)) == rows(want, *sorted(want.columns))


def test_every_child_is_a_row(spark):
    parents = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "id int, name string")
    children = spark.range(30_000).select("id", F.when(F.col("id") < 25_000, 1).otherwise(2).alias("k"))
    rows_ = shape.expand_many(parents, children, "k", ["id"], "child")
    counts = {r["id"]: (r["n"], r["named"]) for r in rows_.groupBy("id").agg(
        F.count("child.id").alias("n"), F.count("name").alias("named")).collect()}
    assert counts == {1: (25_000, 25_000), 2: (5_000, 5_000), 3: (0, 1)}


def test_short_ids_of_one_address(spark):
    sites = spark.createDataFrame(
        [("A", "Dam", 5), ("B", "Dam", 5), ("C", "Dam", 5), ("D", "Dam", 7), ("E", "Kade", 1), ("F", "Twee", 3), ("G", "Twee", 3)],
        "id string, straatnaam string, huisnummer int").withColumn("rings", F.lit(None).cast("array<array<struct<x:double,y:double>>>"))
    sites = sites.withColumn("short_id", F.lit(None).cast("bigint")).withColumn("extra_attributes", F.lit(None).cast("map<string,string>"))
    streets = spark.createDataFrame([("0363300000012345", "Dam", "Weg"), ("0363300000099999", "Kade", "Water"),
                                     ("0363300000022222", "Twee", "Weg"), ("0363300000011111", "Twee", "Weg")],
                                    "id string, display string, opr_type string")
    wells = spark.createDataFrame([(1, "A", "a"), (2, "B", "b"), (3, "C", "c"), (9, "C", "z"), (5, "F", "f"), (6, "G", "g")],
                                  "id int, site_id string, summary string")
    one = shortid.first_at_address(sites, streets, wells)
    assert rows(one, "id", "short_id")[:4] == [("A", 123455), ("B", None), ("C", None), ("D", None)]
    two = shortid.others_at_address(one, streets, wells)
    three = shortid.without_well(two, streets)
    got = {r["id"]: (r["short_id"], (r["extra_attributes"] or {}).get("chauffeur")) for r in three.collect()}
    assert got["A"] == (123455, "a") and got["C"] == (223455, "c")
    assert got["B"] == (1123455, None) and got["D"] == (1123457, None) and got["E"] == (None, None)
    assert got["F"] == (111113, "f")


def weigh_page(fields, records):
    return json.dumps({"Fields": fields, "Records": records, "Status": "SUCCESSFUL", "Message": ""})


def test_weigh_pages(spark):
    names = list(pg.REQUIRED_WEIGH_FIELDS) + ["FractionId"]
    base = dict(zip(names, ["4", "6214", "2017-01-01", "10:00:00", "322051", "Oost", "74006", "1", "4", "B", "1070", "835", "235",
                            "52.29538", "4.96802", "Gft"]))
    record = lambda **kw: [{**base, **kw}[n] for n in names]
    good = weigh_page(names, [record(), record(Time="10:44:34", NettWeight="", Latitude="0"), record(Date="")])
    short = weigh_page(names[:-1], [record()[:-1]])
    bad = weigh_page([n for n in names if n != "CustId"], [])
    raw = spark.createDataFrame([(1, good), (2, short), (3, bad)], "id int, data string").withColumn(
        "scraped_at", F.lit("2018-01-01").cast("timestamp"))
    got = shape.weighings(raw).orderBy("page_id", "weigh_at").collect()
    assert [(r["page_id"], r["fractie"], r["net_weight"], r["valid"], r["lon"]) for r in got] == [
        (1, "GFT", 235, True, 4.96802), (1, "GFT", None, False, None), (2, "Rest", 235, True, 4.96802)]
    assert rows(pg.weigh_page_errors(raw), "id", "missing") == [(3, "CustId")]
    counted = checks.load_errors(shape.weighings(raw, keep_undated=True)).first()
    assert (counted["rows"], counted["errors"], counted["ok"]) == (4, 2, True)


def test_marks_per_system(spark):
    raw = spark.createDataFrame([(1, 5, "2020-01-01 00:00:00"), (2, 5, "2020-01-02 00:00:00"), (3, 5, "2020-01-02 00:00:00"),
                                 (4, 6, "2019-01-01 00:00:00")], "id int, system_id int, weigh_at string")
    raw = raw.withColumn("weigh_at", F.col("weigh_at").cast("timestamp"))
    done = raw.filter("id = 1")
    assert rows(incremental.new_weigh_pages(raw, done), "id") == [(2,), (4,)]
    assert rows(incremental.new_weigh_pages(raw, done, inclusive=True), "id") == [(1,), (2,), (4,)]


def test_known_ids_last_one_counts(spark):
    page = lambda *items: json.dumps({"results": list(items)})
    item = lambda name, site: {"id_number": name, "well": {"id": 1, "site": site}}
    raw = spark.createDataFrame([
        (1, page(item("RE K 1", {"short_id": 7}), item("RE K 2", None), {"id_number": "RE K 3", "well": None}, {"well": None})),
        (2, page(item("REK1", {"short_id": 9}), item("RE K 4", {"short_id": None})))], "id int, data string")
    assert rows(pg.known_container_ids(raw), "id_number", "short_id") == [("REK1", 9), ("REK4", None)]


def test_sensor_states(spark):
    state = {"Id": 1, "ContainerId": 5, "Description": "RE K 1", "HouseNumber": "12a", "Lat": "52.1", "Lon": "4.1"}
    data = json.dumps([{"result": {}}, {"result": {"data": [state, {**state, "ContainerId": 0}, {**state, "Lon": "x"}]}}])
    raw = spark.createDataFrame([(data,)], "data string").withColumn("scraped_at", F.lit("2018-01-01").cast("timestamp"))
    known = spark.createDataFrame([("REK1", 77)], "id_number string, short_id int")
    got = shape.sensor_states(raw, known).collect()
    assert [(r["_id"], r["description"], r["valid"], r["short_id"], r["house_number"]) for r in got] == [(1, "REK1", True, 77, None)] * 2
    assert sorted(r["geo_lon"] is None for r in got) == [False, True]


def test_not_in_register_with_null(spark):
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, customer_key string")
    register = spark.createDataFrame([("a",), (None,)], "id_number string")
    assert rows(links.register_validity(keys, register), "id", "valid") == [(1, True), (2, None), (3, None)]
    assert rows(links.register_validity(keys, register.filter("id_number is not null")), "id", "valid") == [
        (1, True), (2, False), (3, None)]


def test_update_takes_the_lowest_match(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    source = spark.createDataFrame([(1, "q"), (1, "p")], "id int, v string")
    assert rows(merge.update_from(target, source, ["id"], ["v"]), "id", "v") == [(1, "p"), (2, "y")]


def test_single_weighing_has_no_deviation(spark):
    facts = spark.createDataFrame([(1, "Rest", "2018-01-05", 10, True), (1, "Rest", "2018-01-05", 99, False)],
                                  "site_id int, fractie string, weigh_at string, net_weight int, valid boolean")
    facts = facts.withColumn("weigh_at", F.col("weigh_at").cast("timestamp"))
    sites = spark.createDataFrame([("s", 1)], "id string, short_id int")
    got = stats.site_stats(facts, sites, "week").first()
    assert (got["measurements"], got["sum"], got["avg"], got["stddev"]) == (1, 10, 10, None)


def test_malformed_ids_bind_and_before_or(spark):
    df = spark.createDataFrame([(1, "RE", 0), (2, None, 1), (3, None, 0), (4, "RE 12345678", 0), (5, "RE 123", 1)],
                               "id int, id_number string, active int")
    assert rows(fl.malformed_ids(df), "id") == [(1,), (2,), (4,)]


def test_unknown_filters_and_choices_are_errors(spark):
    df = spark.createDataFrame([("Rest", 1)], "waste_name string, active int")
    with pytest.raises(ValueError):
        fl.apply_filters(df, {"owner": 1}, fl.FILTERS["containers"])
    with pytest.raises(ValueError):
        fl.choice(df, "waste_name", "Hout", fl.WASTE_CHOICES)
    with pytest.raises(SparkRuntimeException):
        fl.choice_in(df, "waste_name", "Hout", df, "waste_name").collect()


def test_sparse_fields(spark):
    df = spark.createDataFrame([(1, 2, (3,))], "a int, b int, c struct<d:int>")
    assert shape.sparse(df, "b,a,x").columns == ["a", "b"]
    assert shape.sparse(df, "", None).columns == []
    assert shape.sparse(df, None, "b").columns == ["a", "c"]
    assert shape.sparse(df, "c.d,c.e").columns == ["c.d"]


def test_range_checks_fail_outside(spark):
    report = checks.range_checks(spark.range(10), {"few": (F.col("id") < 3, 0, 2), "all": (F.col("id") >= 0, 10, 10)})
    assert rows(report, "check", "n", "ok") == [("all", 10, True), ("few", 3, False)]
    with pytest.raises(SparkRuntimeException):
        checks.fail_on(report).collect()


def test_cursor_pages_cover_everything(spark):
    """Ties and missing keys on the border of two pages are neither lost nor met twice."""
    df = spark.range(25).withColumn("at", F.when(F.col("id") % 5 > 0, F.floor(F.col("id") / 9)))
    seen, cursor = [], None
    while True:
        part = paging.cursor_page(df, "at", 4, cursor).collect()
        if not part:
            break
        seen, cursor = seen + [r["id"] for r in part], (part[-1]["at"], part[-1]["id"])
    assert sorted(seen) == list(range(25)) and len(seen) == 25
    with pytest.raises(ValueError):
        paging.cursor_page(df, "at", 10_000)


def test_report_names_every_rule(spark):
    wells = spark.createDataFrame([(1, None)], "id int, site_id string")
    sites = spark.createDataFrame([(True, 2 ** 40)], "bgt_based boolean, short_id bigint")
    assert {r["check"]: r["ok"] for r in feeds.site_report(wells, sites).collect()} == {
        "well_without_site": True, "map_based": False, "no_short_id": True, "long_short_id": False}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_weigh_stream_skips_what_is_stored(spark):
    from wastelake.session import work_path
    from wastelake.streaming import live
    names = list(pg.REQUIRED_WEIGH_FIELDS)
    record = lambda seq, day: ["4", seq, day, "10:00:00", "1", "O", "7", "1", "4", "B", "1070", "835", "235", "52.1", "4.9"]
    source, out, marks = (work_path(spark, n) for n in ("in", "out", "marks"))
    none = spark.createDataFrame([], "code string, vollcode string, rings array<array<struct<x:double,y:double>>>")
    def land(number, *records):
        spark.createDataFrame([(number, weigh_page(names, list(records)))], "id int, data string").withColumn(
            "scraped_at", F.lit("2018-01-01").cast("timestamp")).write.mode("append").json(source)
        live.weighings(live.page_stream(spark, source), none, none, out, marks).awaitTermination()
    land(1, record("1", "2018-01-01"), record("2", "2018-01-02"))
    land(2, record("3", "2018-01-02"))
    land(3, record("4", "2018-01-03"))
    assert rows(spark.read.parquet(out), "seq_id") == [(1,), (2,), (4,)]


def test_sites_by_type_repeats_in_portions(spark, monkeypatch):
    monkeypatch.setattr(fl, "PORTION", 7)
    sites = spark.createDataFrame([("a",), ("b",)], "id string")
    wells = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, site_id string")
    containers = spark.range(40).select("id", F.when(F.col("id") < 30, 1).when(F.col("id") < 39, 2).otherwise(3).alias("well_id"),
                                        F.lit(5).alias("container_type_id"))
    types = spark.createDataFrame([(5, 3)], "id int, weight int")
    got = fl.sites_by_type(sites, wells, containers, types, "weight", "gt", 2).groupBy("id").count()
    assert rows(got, "id", "count") == [("a", 39), ("b", 1)]


def test_missing_kind_of_map_object_fails(spark):
    from wastelake.operators.spatial import well_objects
    schema = "well_id int, object_id int, layer string, distance double, kind string"
    both = [(1, 2, "bins", 0.0, "POINT"), (1, 3, "road", 0.0, "POLYGON")]
    assert rows(well_objects(spark.createDataFrame(both, schema)), "polygon_id", "point_id") == [(3, None), (None, 2)]
    for part in ([], both[:1], both[1:]):
        with pytest.raises(SparkRuntimeException):
            well_objects(spark.createDataFrame(part, schema)).collect()


def test_a_load_with_failed_checks_stops(spark):
    good = checks.minimum_counts({"few": (spark.range(3), 2)})
    checks.stop_unless_ok(good)
    with pytest.raises(ValueError, match="few"):
        checks.stop_unless_ok(checks.minimum_counts({"few": (spark.range(3), 4)}))
    rows_ = spark.createDataFrame([(None, 5), (None, None)], "weigh_at timestamp, net_weight int")
    checks.stop_unless_ok(checks.load_errors(rows_, 2))
    with pytest.raises(ValueError):
        checks.stop_unless_ok(checks.load_errors(rows_, 1))
