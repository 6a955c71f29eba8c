"""Lists with filters through relations."""

import pytest

from wastelake.operators import lists


@pytest.fixture(scope="module")
def register(spark):
    flags = [("in_pand", "true")]
    wells = spark.createDataFrame(
        [(1, "A", "x", 0.0, 0.0, "a", dict(flags)), (2, "A", "y", 5.0, 5.0, None, {}), (3, "K", "x", 9.0, 9.0, "b", None)],
        "id int, stadsdeel string, buurt_code string, x double, y double, site_id string, extra_attributes map<string,string>")
    containers = spark.createDataFrame(
        [(1, "RE 1", 1, 10, "Glas", 1), (2, "REK22", 1, 10, "Rest", 1), (3, "REK33", 2, 11, "Glas", 0), (4, None, None, 11, "Rest", 1)],
        "id int, id_number string, well_id int, container_type_id int, waste_name string, active int")
    types = spark.createDataFrame([(10, "big", 5.0), (11, "small", 1.0)], "id int, name string, volume double")
    sites = spark.createDataFrame([("a", 1, "A"), ("b", None, "K"), ("c", 3, "K")], "id string, short_id int, stadsdeel string")
    return lists.Register(containers, wells, types, sites)


def got(register, entity, **params):
    return sorted(r["id"] for r in lists.related(entity, register, params).select("id").collect())


def test_containers(register):
    assert got(register, "containers") == [1, 2, 3, 4]
    assert got(register, "containers", no_well=True) == [4]
    assert got(register, "containers", no_site=True) == [3, 4]
    assert got(register, "containers", invalid_id=True) == [4]
    assert got(register, "containers", like_id_number="K3") == [3] and got(register, "containers", id_number="R E K22") == [2]
    assert got(register, "containers", in_bbox="0,0,6,6", container_type__volume__lt=2) == [3]
    assert got(register, "containers", location="0,0,1", detailed=True, active__gt=0) == [1, 2]
    assert got(register, "containers", well__stadsdeel="A", well__buurt_code="y") == [3]


def test_wells_and_sites(register):
    assert got(register, "wells", no_container=True) == [3] and got(register, "wells", containers=3) == [2]
    assert got(register, "wells", in_pand=True) == [1] and got(register, "wells", site="b") == [3]
    assert got(register, "sites", fractie="Glas") == ["a"] and got(register, "sites", container_type="big") == ["a"]
    assert got(register, "sites", no_short_id=True) == ["b"] and got(register, "sites", wells=3, stadsdeel="K") == ["b"]
    assert got(register, "sites", no_container=True) == ["b", "c"]
    assert got(register, "sites", wells__containers__container_type__volume__gt=2) == ["a", "a"]
    assert got(register, "sites", wells__containers__container_type__volume__gt=2, fractie="Glas") == ["a"]


def test_filters_that_do_not_exist_are_errors(register):
    for entity, name, value in (("sites", "volume", 1), ("wells", "fractie", "Glas"), ("containers", "waste_name", "?"),
                                ("containers", "container_type__volume__ne", 1), ("sites", "fractie", "?")):
        with pytest.raises(ValueError):
            lists.related(entity, register, {name: value})
    with pytest.raises(Exception, match="no choice"):
        got(register, "sites", container_type="huge")


def test_pages(register):
    page = lists.related_page("containers", register, {"active": 1}, "id,waste_name", None, "-id", 2, 2)
    assert [tuple(r) for r in page.collect()] == [(1, "Glas")]
