import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.functions import calendar as cal
from gridloom.functions import text as tx
from gridloom.functions import values as vals
from gridloom.functions.sizing import measured_bytes, small
from gridloom.operators import derive as dv


def one(spark, column, **row):
    df = spark.createDataFrame([tuple(row.values())], list(row)) if row else spark.range(1)
    return df.select(column.alias("r")).first()["r"]


def column(spark, values, expr, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r["r"] for r in df.select(expr(F.col("v")).alias("r")).collect()]


def test_fill_missing(spark):
    got = column(spark, [1.0, math.nan, None, math.inf, -math.inf, 3.0], vals.fill_missing)
    big = got[1]
    assert got == [1.0, big, big, big, big, 3.0] and big == pytest.approx(1e20)
    assert column(spark, [1.0, math.nan], lambda v: vals.fill_missing(v, -999.0)) == [1.0, -999.0]
    assert column(spark, [1, 2], lambda v: vals.fill_missing(v, floating=False), "int") == [1, 2]
    assert dict(spark.range(1).select(vals.fill_missing(F.lit(1.0)).alias("x")).dtypes)["x"] == "float"


def test_nan_is_null_at_ingest_and_masks_take_the_other_side(spark):
    assert column(spark, [math.nan, 20.0, 10.0], lambda v: vals.mask_where(F.lit(5.0), vals.null_if_nan(v) > 15, 0.0)) == [0.0, 5.0, 0.0]


def test_units(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "value double")
    values = lambda d: [r["value"] for r in d.collect()]
    assert values(dv.convert_units(df, {"scale": 2.0})) == [2.0, 4.0, 6.0]
    assert values(dv.convert_units(df, {"scale": 1.0, "offset": 273.15})) == pytest.approx([274.15, 275.15, 276.15])
    assert values(dv.convert_units(df, "x * 1000.0")) == [1000.0, 2000.0, 3000.0]
    with pytest.raises(TypeError):
        dv.convert_units(df, 3)


def test_percent(spark):
    assert column(spark, [0.0, 0.5, 1.0, None], lambda v: vals.to_percent(v, 1.0)) == [0.0, 50.0, 100.0, None]
    assert column(spark, [0.5, 120.0, -3.0], lambda v: vals.to_percent(v, 120.0)) == [0.5, 100.0, 0.0]


def test_pressure_units(spark):
    pa = lambda u, m: column(spark, [500.0], lambda v: vals.pressure_to_pa(v, F.lit(u), F.lit(m)))[0]
    assert [pa("hPa", 1e9), pa("MBAR", 1.0), pa("", 2000.0), pa("", 2000.1), pa("Pa", 1.0)] == [50000.0, 50000.0, 50000.0, 500.0, 500.0]


def test_reference_pressure(spark):
    assert one(spark, vals.reference_pressure(F.lit(95000.0), F.lit(98000.0))) == 95000.0
    assert one(spark, vals.reference_pressure(F.lit(None), F.lit("98000"))) == 98000.0
    assert one(spark, vals.reference_pressure(F.lit("bad"), F.lit("worse"))) == 100000.0


def test_cf_time(spark):
    def t(text, units, calendar):
        return one(spark, cal.cf_time(F.lit(text).cast("timestamp_ntz"), units, calendar))

    assert t("2000-01-01", "days since 2000-01-01", "noleap") == 0.0
    assert t("2000-01-02", "days since 2000-01-01", "noleap") == 1.0
    assert t("2000-03-01", "days since 2000-02-28", "noleap") == 1.0
    assert t("2000-03-01", "days since 2000-02-28", "standard") == 2.0
    assert t("2000-02-29", "days since 2000-01-01", "noleap") is None
    assert t("2000-01-01 06:00:00", "hours since 2000-01-01", "standard") == 6.0
    assert t("2001-01-30", "days since 2000-01-01", "360_day") == 389.0
    assert t("2001-01-31", "days since 2000-01-01", "360_day") is None
    with pytest.raises(ValueError):
        t("2000-01-01", "fortnights since 2000-01-01", "noleap")
    with pytest.raises(ValueError):
        t("2000-01-01", "days since 2000-01-01", "lunar")


def test_encode_time_by_type(spark):
    assert one(spark, cal.encode_time("int", F.lit(7), "days since 2000-01-01", "noleap")) == 7.0
    with pytest.raises(TypeError):
        cal.encode_time("string", F.lit("x"), "days since 2000-01-01", "noleap")


def test_year_fraction_counts_elapsed_months(spark):
    day = spark.createDataFrame([(datetime(1850, 1, 1),), (datetime(1850, 3, 1),)], "t timestamp_ntz")
    got = [r[0] for r in day.select(cal.noleap_year_fraction(F.col("t"))).collect()]
    assert got == pytest.approx([1850 + 1 / 365, 1850 + 60 / 365])


@pytest.mark.parametrize(
    "text, expected",
    [("PRECC + PRECL", True), ("PRECC * 0.001", True), ("verticalsum(SOILWATER)", True), ("PRECC", False), ("T2M", False), ("A B", True), ("FATES_X", True)],
)
def test_is_expression(spark, text, expected):
    assert one(spark, tx.is_expression(F.lit(text))) is expected


def test_expression_variables(spark):
    names = lambda t: one(spark, tx.expression_variables(F.lit(t)))
    assert names("PRECC + PRECL") == ["PRECC", "PRECL"]
    assert names("verticalsum(SOILWATER, capped_at=1000)") == ["SOILWATER"]
    assert names("np.sqrt(U**2 + V**2)") == ["U", "V"]
    assert names("FATES_GPP_PF") == ["FATES_GPP_PF", "FATES_FRAC"]


def test_sheet_cells(spark):
    assert one(spark, tx.identifier_list(F.lit("siconc, tarea"))) == ["siconc", "tarea"]
    assert one(spark, tx.identifier_list(F.lit("CLDTOT * 100"))) is None
    assert one(spark, tx.identifier_list(F.lit(" , "))) is None
    assert one(spark, tx.positional_split(F.lit("day, mon, "), F.lit(3))) == ["day", "mon", ""]
    assert one(spark, tx.positional_split(F.lit("a, b"), F.lit(3))) == ["a", "b", ""]
    assert one(spark, tx.positional_split(F.lit(""), F.lit(2))) == ["", ""]
    assert one(spark, tx.positional_split(F.lit("-1.0, 2"), F.lit(1))) == ["-1.0"]
    assert one(spark, tx.plain_number(F.lit("1,5"))) == "1.5"
    assert one(spark, tx.plain_number(F.lit("1.000,5"))) == "1000.5"
    assert one(spark, tx.plain_number(F.lit("kg m−2"))) == "kg m-2"
    clean = lambda t, r=False: one(spark, tx.clean_cell(F.lit(t), rename_dimensions=r))
    assert [clean("longitude", True), clean("longitude"), clean("  lev  "), clean("'time'"), clean("time4", True)] == ["lon", "longitude", "lev", "time", "time"]


def test_index_sums(spark):
    rows = one(spark, tx.index_sums(F.lit("FATES_VEGC_PF(1:3) + PCT_LANDUNIT(4) - FATES_AREA_LU(1,5)")))
    assert [(r["var"], r["idx"], r["dim"]) for r in rows] == [
        ("FATES_VEGC_PF", [1, 2, 3], "fates_levpft"),
        ("PCT_LANDUNIT", [4], "ltype"),
        ("FATES_AREA_LU", [1, 5], "fates_levlanduse"),
    ]


def test_dimensions_and_levels(spark):
    dims = lambda t: one(spark, tx.parse_dimensions(F.lit(t)))
    assert dims('["time", "pft", "lat"]') == ["time", "vegtype", "lat"]
    assert dims("lon,lat,plev19,time") == ["time", "plev", "lat", "lon"]
    assert dims("time, depth") == ["time", "depth"]
    level = lambda d, *a: one(spark, tx.infer_levels(F.array(*[F.lit(x) for x in d]), *a))
    assert level(["time", "plev19"])["name"] == "plev19"
    assert level(["time", "lev"])["src_axis_bnds"] == "ilev"
    assert level(["time", "lev"], F.lit("own"), F.lit("m"))["units"] == "m"
    assert level(["time", "lat"]) is None


def test_log_names(spark):
    assert one(spark, tx.log_variable(F.lit("cmor_20250101T010203Z_tas.log"))) == "tas"
    assert one(spark, tx.log_variable(F.lit("other.log"))) is None
    assert one(spark, tx.names_variable(F.lit("run.cam.h1.TS.ne30.nc"), F.lit("TS"))) is True
    assert one(spark, tx.names_variable(F.lit("run.cam.h1.PS.ne30.nc"), F.lit("TS"))) is False


def test_only_small_tables_are_broadcast(spark):
    df = spark.range(1000).withColumn("t", F.lit("x" * 100))
    assert measured_bytes(df) >= 1000 * 100
    plan = lambda d: spark.range(10).join(d, "id")._jdf.queryExecution().toString()
    assert "broadcast" in plan(small(df)).lower().split("== physical plan ==")[0]
    assert "broadcast" not in plan(small(df, limit=1000)).lower().split("== physical plan ==")[0]


def test_index_sums_are_written_as_calls(spark):
    write = lambda t: one(spark, tx.write_index_sums(F.lit(t)))
    assert write("A(1:3)") == "sumoverpft(A, pftlist=[1, 2, 3], dimname='lev')"
    assert write("NPP(1) + FATES_NPP(1)") == "sumoverpft(NPP, pftlist=[1], dimname='lev') + sumoverpft(FATES_NPP, pftlist=[1], dimname='lev')"
    assert write("2 * PCT_LANDUNIT(4,6) / B") == "2 * sumoverpft(PCT_LANDUNIT, pftlist=[4, 6], dimname='ltype') / B"
    assert write("sqrt(4) * A + verticalsum(B, capped_at=5)") == "sqrt(4) * A + verticalsum(B, capped_at=5)"
    assert write("A(3:1)") == "sumoverpft(A, pftlist=[], dimname='lev')" and write("A(1:)") == "A(1:)" and write("") == "" and write(None) is None
    assert one(spark, tx.index_sums(F.lit("max(3) + A(2)"))) == [("A", [2], "lev")]


@pytest.mark.parametrize("calendar", ["noleap", "360_day", "standard"])
def test_date_of_a_number_names_its_input_once(spark, calendar):
    """A Column that is named again is copied with all below it: copies nested in each other made a row of events cost milliseconds."""
    plan = spark.range(3).select((F.col("id") * 0.25).alias("v")).select(cal.cf_date(F.col("v"), "hours since 1850-03-01", calendar).alias("d"))
    assert str(plan._jdf.queryExecution().analyzed().expressions().head()).count("v#") == 1


def test_dates_at_the_ends_of_days_and_years(spark):
    got = column(spark, [-1e-6, 0.0, 58.999999, 59.0, 364.0, 365.0, -365.0, None], lambda v: cal.cf_date(v, "days since 2001-01-01"))
    day = 86400000000
    assert [tuple(r) if r else r for r in got] == [
        (2000, 12, 31, day - 86400), (2001, 1, 1, 0), (2001, 2, 28, day - 86400), (2001, 3, 1, 0), (2001, 12, 31, 0), (2002, 1, 1, 0), (2000, 1, 1, 0), None,
    ]
    # Far from the origin, where whole microseconds are more than a double holds.
    got = column(spark, [float(86400 * 365 * 9000 - 1), float(86400 * 365 * 9000)], lambda v: cal.cf_date(v, "seconds since 0001-01-01"))
    assert [tuple(r) for r in got] == [(9000, 12, 31, day - 1000000), (9001, 1, 1, 0)]
