"""Input binding: names, declared columns, the guide's key."""

import uuid

import pytest

from martcraft.plans import marts as M
from martcraft.rules import FIXTURE
from martcraft.session import shared_dir
from martcraft.sources import fixture_inputs, inputs_from_paths, inputs_from_tables
from martcraft.sources.inputs import SCHEMAS, check_unique_guide, checked
from tests.conftest import SF_SMALL
from tests.helpers import spark_bag


@pytest.fixture(scope="module")
def paths(spark):
    base, inp = shared_dir(spark, "tests", uuid.uuid4().hex), fixture_inputs(spark, SF_SMALL)
    for name in SCHEMAS:
        getattr(inp, name).write.parquet(f"{base}/{name}")
    return {name: f"{base}/{name}" for name in SCHEMAS}


def test_marts_from_paths_and_tables(spark, paths):
    want = spark_bag(M.balance_v1(fixture_inputs(spark, SF_SMALL), FIXTURE))
    assert spark_bag(M.balance_v1(inputs_from_paths(spark, paths), FIXTURE)) == want
    names = {}
    for name, path in paths.items():
        names[name] = f"t_{uuid.uuid4().hex[:8]}"
        spark.read.parquet(path).createOrReplaceTempView(names[name])
    assert spark_bag(M.balance_v1(inputs_from_tables(spark, names), FIXTURE)) == want
    del names["retail_peer"]
    assert inputs_from_tables(spark, names).retail_peer is None


def test_bad_inputs_are_named(spark, paths):
    with pytest.raises(ValueError, match="missing .'guide'"):
        inputs_from_paths(spark, {k: v for k, v in paths.items() if k != "guide"})
    with pytest.raises(ValueError, match="unknown"):
        inputs_from_paths(spark, {**paths, "other": "x"})
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    with pytest.raises(ValueError, match="no column division"):
        checked("dealer", df)
    with pytest.raises(ValueError, match="id is string"):
        checked("division", df.withColumn("id", df["id"].cast("string")))
    assert checked("division", df.withColumn("more", df["id"])).columns == ["id", "name"]


def test_guide_key(spark):
    guide = spark.createDataFrame([(1,), (2,)], "guide_id long")
    check_unique_guide(guide)
    with pytest.raises(ValueError, match="guide_id"):
        check_unique_guide(guide.union(guide))
    with pytest.raises(ValueError, match="guide_id"):
        check_unique_guide(guide.union(spark.createDataFrame([(None,)], "guide_id long")))
