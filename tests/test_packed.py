"""Packed weights: equal to the broadcast join, and joined by layout without an exchange of the field."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import packed as pk
from gridloom.operators import regrid as rg
from gridloom.plans import prepare as pp
from gridloom.session import SETTINGS

CELLS = 300


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    weights = [(m, s, rng.randrange(40), rng.choice([0.25, 0.5, 1.0])) for m in ("a", "b") for s in range(CELLS) for _ in range(rng.randint(0, 4))]
    field = [(v, t, k, c, None if rng.random() < 0.2 else float(rng.randrange(100))) for v in ("T", "U") for t in range(3) for k in range(2) for c in range(CELLS + 20)]
    w = spark.createDataFrame(weights, "map_id string, src_cell bigint, dst_cell bigint, w double")
    return spark.createDataFrame(field, "var string, time_idx int, lev int, cell bigint, value double"), w


def rows(df):
    return sorted((r["var"], r["time_idx"], r["lev"], r["cell"], r["value"] is not None, round(r["value"] or 0, 9)) for r in df.collect())


def with_map(field):
    return field.withColumn("map_id", F.when(F.col("var") == "T", "a").otherwise("b"))


@pytest.fixture
def colocated(spark, tmp_path, tables):
    """Field and packed weights as tables in buckets, and the session's setting for joins by block and cell."""
    field, weights = tables
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", SETTINGS["spark.sql.requireAllClusterKeysForCoPartition"])
    packed = pk.pack_weights(weights, size=16)
    pk.write_by_block(field, "field_by_block", 4, ["var"], str(tmp_path / "field"), size=16)
    pk.write_by_block(packed, "weights_by_block", 4, path=str(tmp_path / "weights"))
    yield spark.table("field_by_block"), spark.table("weights_by_block")
    spark.sql("DROP TABLE field_by_block")
    spark.sql("DROP TABLE weights_by_block")
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_packed_equals_the_join_by_cell(tables):
    field, weights = tables
    want = rows(rg.regrid_by_map(with_map(field), weights))
    for limit in (0, 1 << 30):
        assert rows(pk.regrid_packed(with_map(field), pk.pack_weights(weights, size=16), limit=limit)) == want


def test_a_field_stored_by_block_is_not_exchanged(spark, tables, colocated):
    field, packed = colocated
    made = pk.regrid_packed(with_map(field), packed, limit=0)
    assert rows(made) == rows(rg.regrid_by_map(with_map(tables[0]), tables[1]))
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "time_idx" in exchanges[0]  # the partial sums
    assert "ShuffledHashJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan


def test_prepared_targets_use_the_layout(spark, tables, colocated, monkeypatch):
    field, packed = colocated
    monkeypatch.setattr(pk.regrid_packed, "__defaults__", (rg.KEYS, 0))
    targets = [pp.Target("t", "general", "T", {}, None, None, None, "a"), pp.Target("u", "general", "U", {}, None, None, None, "b")]
    static = spark.createDataFrame([(0, 1.0)], "cell bigint, landfrac double")
    kw = {"weights": tables[1], "static": static, "available": {"T": True, "U": True}}
    outputs, status = pp.prepare(spark, field, targets, packed=packed, **kw)
    plain, _ = pp.prepare(spark, tables[0], targets, **kw)
    assert dict(status) == {"t": "ok", "u": "ok"} and rows(outputs["general"]) == rows(plain["general"])
    plan = outputs["general"]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert not [line for line in plan.splitlines() if "Exchange" in line and "block" in line]
    # Derived rows have no layout and are joined all the same.
    targets.append(pp.Target("s", "general", None, {"T": "T", "U": "U"}, "T + U", None, None, "a"))
    outputs, _ = pp.prepare(spark, field, targets, packed=packed, **kw)
    plain, _ = pp.prepare(spark, tables[0], targets, **kw)
    assert rows(outputs["general"]) == rows(plain["general"])


def test_buckets_follow_the_measured_size(tables):
    packed = pk.pack_weights(tables[1])
    assert pk.buckets_for(packed) == 1
    assert pk.buckets_for(packed, 1000) >= 2 and pk.buckets_for(packed, 1000).bit_count() == 1


def test_a_cell_without_entries_gives_nothing(spark):
    field = spark.createDataFrame([("T", 0, 0, 0, 1.0), ("T", 0, 0, 1, 2.0)], "var string, time_idx int, lev int, cell bigint, value double").withColumn("map_id", F.lit("a"))
    weights = spark.createDataFrame([("b", 0, 0, 1.0), ("a", 1, 5, 1.0)], "map_id string, src_cell bigint, dst_cell bigint, w double")
    assert rows(pk.regrid_packed(field, pk.pack_weights(weights))) == [("T", 0, 0, 5, True, 2.0)]
