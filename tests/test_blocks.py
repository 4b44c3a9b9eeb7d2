"""Series of every stream and frequency, their manifest, and dates of every calendar."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import calendar as cal
from gridloom.plans import chains
from gridloom.sources import blocks

PATTERNS = {"m": {"ocean": {"mon": ["mom6.h.z", "mom6.h.native."], "day": ["mom6.h.sfc"], "6hr": ["mom6.h.inst"]}}}


def put(spark, root, name, rows, schema):
    root.mkdir(exist_ok=True)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(root / "tmp"))
    for part in (root / "tmp").glob("part-*.parquet"):
        part.rename(root / f"run.{name}.nc")


@pytest.fixture
def ocean(spark, tmp_path):
    raw, out = tmp_path / "hist", str(tmp_path / "series")
    put(spark, raw, "mom6.h.z", [(t, k, c, 1.0 + k) for t in range(36) for k in range(3) for c in range(2)], "time_idx int, lev int, cell bigint, so double")
    put(spark, raw, "mom6.h.native.", [(t, c, 10.0, 5.0) for t in range(36) for c in range(2)], "time_idx int, cell bigint, so double, tos double")
    put(spark, raw, "mom6.h.sfc", [(t, c, 7.0) for t in range(3 * 365) for c in range(2)], "time_idx int, cell bigint, tos double")
    put(spark, raw, "mom6.h.inst", [(t, c, t / 4 + 0.25, t / 4, 8.0) for t in range(3 * 4 * 365) for c in range(1)], "time_idx int, cell bigint, time double, time_b0 double, so double")
    return lambda **kw: chains.generate_series(spark, str(raw), out, "m", "ocean", patterns=PATTERNS, units="days since 0000-01-01", **kw), out, raw


def counts(spark, out, *keys):
    return {tuple(r)[:-1]: r["count"] for r in blocks.read_blocks(spark, out).groupBy("var", "freq", "stream", *keys).count().collect()}


def test_streams_of_one_frequency_do_not_replace_each_other(spark, ocean):
    run, out, _ = ocean
    assert run() == ["mom6.h.z", "mom6.h.native.", "mom6.h.sfc", "mom6.h.inst"]
    want = {("so", "mon", "mom6.h.z"): 216, ("so", "mon", "mom6.h.native."): 72, ("tos", "mon", "mom6.h.native."): 72, ("tos", "day", "mom6.h.sfc"): 2190, ("so", "6hr", "mom6.h.inst"): 4380}
    assert counts(spark, out) == want
    values = {r["value"] for r in blocks.read_blocks(spark, out, ["so"], "mon").select("value").distinct().collect()}
    assert values == {1.0, 2.0, 3.0, 10.0}
    run()
    assert counts(spark, out) == want


def test_every_frequency_keeps_all_rows_of_the_years(spark, ocean):
    run, out, _ = ocean
    run(years=(0, 1, 2))
    got = counts(spark, out, "block")
    assert got == {("so", "mon", "mom6.h.z", 0): 144, ("so", "mon", "mom6.h.native.", 0): 48, ("tos", "mon", "mom6.h.native.", 0): 48, ("tos", "day", "mom6.h.sfc", 0): 1460, ("so", "6hr", "mom6.h.inst", 0): 2920}
    listed = {(r["var"], r["stream"]): r for r in blocks.manifest(spark, out).collect()}
    assert (listed["so", "mom6.h.z"]["rows"], listed["so", "mom6.h.z"]["levels"], listed["so", "mom6.h.z"]["last_time"]) == (144, [0, 1, 2], 23)
    assert listed["so", "mom6.h.inst"]["levels"] is None
    run(years=(0, 2, 1))  # another cut of the years is another set of blocks; block 0 is listed and stays
    assert sorted({r["block"] for r in blocks.manifest(spark, out).collect()}) == [0, 1, 2]


def test_listed_blocks_are_not_read_again(spark, ocean, monkeypatch):
    run, out, raw = ocean
    run(years=(0, 1, 2))
    before = counts(spark, out, "block")
    stored = []
    monkeypatch.setattr(blocks, "store", lambda *a, **kw: stored.append(a))
    run(years=(0, 1, 2))
    assert stored == [] and counts(spark, out, "block") == before


def test_what_a_stopped_job_left_is_not_seen_and_is_replaced(spark, ocean, monkeypatch):
    run, out, _ = ocean

    def stop(*args, **kw):
        raise RuntimeError("lost")

    # Stopped after the data and before the manifest.
    with monkeypatch.context() as m:
        m.setattr(blocks.F, "max_by", stop)
        m.setattr(blocks, "manifest", lambda spark, path: spark.createDataFrame([], blocks.ENTRY))
        m.setattr(blocks.F, "sort_array", stop)
        with pytest.raises(RuntimeError):
            run(years=(0, 0, 1))
    assert spark.read.parquet(out).count() > 0 and counts(spark, out, "block") == {}
    run(years=(0, 0, 1))
    want = counts(spark, out, "block")
    assert want["tos", "day", "mom6.h.sfc", 0] == 730 and spark.read.parquet(out).count() == sum(want.values())
    # Stopped while replacing: the blocks are open until a run without overwriting fills them.
    with monkeypatch.context() as m:
        m.setattr(blocks.F, "sort_array", stop)
        with pytest.raises(RuntimeError):
            run(years=(0, 0, 1), overwrite=True)
    assert counts(spark, out, "block") == {}
    run(years=(0, 0, 1))
    assert counts(spark, out, "block") == want


def test_shapes_come_from_the_manifest(spark, ocean):
    run, out, _ = ocean
    run(years=(0, 2, 1))
    got = {r["var"]: r for r in blocks.shapes(spark, out, "mon").collect()}
    assert (got["so"]["has_levels"], got["so"]["levels"], got["so"]["last_time"], got["so"]["last_cell"]) == (True, [0, 1, 2], 35, 1)
    assert (got["tos"]["has_levels"], got["tos"]["levels"], got["tos"]["rows"]) == (False, None, 72)


def test_empty_series_list_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "time_idx int, cell bigint, var string, value double, freq string, stream string, block int")
    assert blocks.store(spark, empty, str(tmp_path / "s")).count() == 0
    assert blocks.manifest(spark, str(tmp_path / "s")).count() == 0


def test_reading_prunes_folders(spark, ocean):
    run, out, _ = ocean
    run(years=(0, 2, 1))
    plan = blocks.read_blocks(spark, out, ["tos"])._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "/series]" in line).split("PartitionFilters: [")[1].split("], Push")[0]
    assert "var#" in filters and "BroadcastHashJoin" in plan


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(datetime.datetime(1, 1, 1), datetime.datetime(3000, 1, 1)), min_size=1, max_size=30), st.sampled_from(["noleap", "360_day", "standard"]), st.sampled_from(["days", "hours", "minutes", "seconds"]), st.sampled_from(["0000-01-01", "1850-01-01", "2000-12-30"]))
def test_dates_and_numbers_are_inverse(spark, dates, calendar, unit, origin):
    dates = [d.replace(microsecond=0) for d in dates]
    rows = spark.createDataFrame([(str(d),) for d in dates], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    units = f"{unit} since {origin}"
    number = cal.cf_time(F.col("t"), units, calendar)
    for r in rows.select("t", number.alias("n"), cal.cf_date(number, units, calendar).alias("d")).collect():
        if r["n"] is None:
            assert r["d"] is None and (r["t"].month, r["t"].day) in {(2, 29), *((m, 31) for m in range(1, 13))}
            continue
        got = datetime.datetime(r["d"]["year"], r["d"]["month"], r["d"]["day"]) + datetime.timedelta(microseconds=r["d"]["micros"]) if (calendar != "360_day" or r["d"]["day"] <= 28) else None
        assert got is None or abs(got - r["t"]) <= datetime.timedelta(microseconds=20)


def test_steps_have_years(spark):
    row = spark.range(1).select(
        cal.step_year(F.lit(364), "day").alias("a"), cal.step_year(F.lit(365), "day").alias("b"), cal.step_year(F.lit(365), "day", "standard").alias("c"),
        cal.step_year(F.lit(366 * 8), "3hr", "standard").alias("d"), cal.step_year(F.lit(-1), "6hr").alias("e"), cal.step_year(F.lit(23), "mon").alias("f"), cal.step_year(F.lit(7), "yr").alias("g"),
    ).first()
    assert tuple(row) == (0, 1, 0, 1, -1, 1, 7)
    with pytest.raises(ValueError, match="unknown frequency"):
        cal.step_year(F.lit(1), "week")
