"""Regridding, fractions, areas and what is attached to a regridded field."""

from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.values import wrap_longitude
from gridloom.operators import packed as pk
from gridloom.operators import regrid as rg
from gridloom.plans.bindings import CELLS, field, read, static, weights
from gridloom.plans.registry import query, view

view("conc_all", "SELECT time_idx, lev, cell, QTY AS value FROM native", ("native",))
view(
    "regridded",
    """SELECT var, time_idx, lev, dst_cell AS cell,
       sum(w * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value
       FROM price JOIN cons ON src_cell = cell GROUP BY 1, 2, 3, 4""",
    ("price", "cons"),
)


def cons(spark, d):
    return rg.weights_of(weights(spark, d), "cons")


@query("regrid_renorm", "SELECT * FROM regridded", ["regridded"])
def regrid_renorm(spark, d):
    return rg.regrid(field(spark, d, "PRICE"), cons(spark, d))


@query(
    "regrid_all_variables",
    """SELECT var, time_idx, lev, dst_cell AS cell,
       sum(w * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value
       FROM field JOIN cons ON src_cell = cell GROUP BY 1, 2, 3, 4""",
    ["field", "cons"],
)
def regrid_all_variables(spark, d):
    return rg.regrid(field(spark, d), cons(spark, d))


@query(
    "regrid_packed",
    """SELECT var, time_idx, lev, dst_cell AS cell,
       sum(w * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value
       FROM field JOIN weights ON src_cell = cell AND map_id = CASE WHEN var IN ('PRICE', 'QTY') THEN 'cons' ELSE 'bilin' END GROUP BY 1, 2, 3, 4""",
    ["field", "weights"],
)
def regrid_packed(spark, d):
    """Weights of two maps packed by cell, each variable by its own map, without broadcasting any."""
    rows = field(spark, d).withColumn("map_id", F.when(F.col("var").isin("PRICE", "QTY"), "cons").otherwise("bilin"))
    return pk.regrid_packed(rows, pk.pack_weights(weights(spark, d), size=16), limit=0)


@query(
    "regrid_dense_grid",
    f"""SELECT s.var, s.time_idx, s.lev, c.c AS cell, r.value
        FROM (SELECT DISTINCT var, time_idx, lev FROM regridded) s CROSS JOIN generate_series(0, {CELLS - 1}) c(c)
        LEFT JOIN regridded r ON r.var = s.var AND r.time_idx = s.time_idx AND r.lev = s.lev AND r.cell = c.c""",
    ["regridded"],
)
def regrid_dense_grid(spark, d):
    return rg.regrid_dense(regrid_renorm(spark, d), CELLS)


view(
    "fx",
    """SELECT dst_cell AS cell, sum(w * coalesce(landfrac * 100e0, 0e0)) / sum(w) AS sftlf
       FROM static JOIN cons ON src_cell = cell GROUP BY 1""",
    ("static", "cons"),
)


@query("fx_fractions", "SELECT cell, sftlf, greatest(0e0, least(100e0, (1e0 - sftlf / 100e0) * 100e0)) AS sftof FROM fx", ["fx"])
def fx_fractions(spark, d):
    return rg.fx_fractions(static(spark, d), cons(spark, d))


@query(
    "fx_by_map",
    """SELECT map_id, cell, sftlf, greatest(0e0, least(100e0, (1e0 - sftlf / 100e0) * 100e0)) AS sftof FROM (
       SELECT map_id, dst_cell AS cell, sum(w * coalesce(landfrac * 100e0, 0e0)) / sum(w) AS sftlf
       FROM static JOIN weights ON src_cell = cell GROUP BY 1, 2)""",
    ["static", "weights"],
)
def fx_by_map(spark, d):
    return rg.fx_table(static(spark, d), weights(spark, d))


@query(
    "fx_to_compute",
    """SELECT DISTINCT 'map' || s_nationkey AS map_id, 'run' || (s_suppkey % 7) AS source_id FROM supplier
       EXCEPT SELECT DISTINCT 'map' || c_nationkey, 'run' || (c_custkey % 5) FROM customer WHERE c_acctbal > 5000""",
)
def fx_to_compute(spark, d):
    key = lambda nation, number, n: [F.concat(F.lit("map"), F.col(nation)).alias("map_id"), F.concat(F.lit("run"), F.col(number) % n).alias("source_id")]
    wanted = read(spark, d, "supplier").select(*key("s_nationkey", "s_suppkey", 7))
    stored = read(spark, d, "customer").filter("c_acctbal > 5000").select(*key("c_nationkey", "c_custkey", 5))
    return rg.fx_missing(wanted, stored)


@query(
    "regrid_land_fraction",
    """SELECT n.var, n.time_idx, n.lev, n.cell,
       CASE WHEN fx.sftlf / 100e0 > 0 THEN n.value / (fx.sftlf / 100e0) END AS value FROM (
         SELECT var, time_idx, lev, dst_cell AS cell,
                sum(w * (coalesce(value, 0e0) * coalesce(landfrac, 0e0))) / sum(w) AS value
         FROM price JOIN cons ON src_cell = cell JOIN static USING (cell) GROUP BY 1, 2, 3, 4) n LEFT JOIN fx USING (cell)""",
    ["price", "cons", "static", "fx"],
)
def regrid_land_fraction(spark, d):
    cells, entries = static(spark, d), cons(spark, d)
    land = cells.select("cell", F.col("landfrac").alias("fraction"))
    on_target = rg.fx_fractions(cells, entries).select("cell", (F.col("sftlf") / 100.0).alias("fraction"))
    return rg.regrid_masked(field(spark, d, "PRICE"), entries, land, destination_fraction=on_target)


@query(
    "regrid_ocean_fraction",
    """SELECT var, time_idx, lev, dst_cell AS cell, sum(w * (coalesce(value, 0e0) * (greatest(0e0, least(100e0, wet * 100e0)) / 100e0))) / sum(w) AS value
       FROM price JOIN cons ON src_cell = cell JOIN static USING (cell) GROUP BY 1, 2, 3, 4""",
    ["price", "cons", "static"],
)
def regrid_ocean_fraction(spark, d):
    sea = rg.sea_percent(static(spark, d)).select("cell", (F.col("value") / 100.0).alias("fraction"))
    return rg.regrid_masked(field(spark, d, "PRICE"), cons(spark, d), sea)


@query(
    "land_sea_percent",
    """SELECT cell, greatest(0e0, least(100e0, landfrac * 100e0)) AS land, greatest(0e0, least(100e0, wet * 100e0)) AS sea
       FROM (SELECT cell, CASE WHEN landfrac IS NOT NULL THEN landfrac END AS landfrac, wet FROM static) WHERE landfrac IS NOT NULL
       UNION ALL SELECT cell, NULL, greatest(0e0, least(100e0, wet * 100e0)) FROM static WHERE landfrac IS NULL""",
    ["static"],
)
def land_sea_percent(spark, d):
    cells = static(spark, d)
    land = rg.land_percent(cells).withColumnRenamed("value", "land")
    return land.join(rg.sea_percent(cells).withColumnRenamed("value", "sea"), "cell")


@query(
    "cell_area",
    """SELECT cell, (lat0 + lat1) * 0.5e0 AS lat, (lon0 + lon1) * 0.5e0 AS lon,
       round(40589641e6 * abs(radians(lon1) - radians(lon0)) * abs(sin(radians(lat1)) - sin(radians(lat0))) / 1e6, 2) AS area_km2
       FROM (SELECT cell, greatest(lat - 0.5e0, -90e0) AS lat0, least(lat + 0.5e0, 90e0) AS lat1, lon - 1e0 AS lon0, lon + 1e0 AS lon1 FROM static)""",
    ["static"],
)
def cell_area(spark, d):
    bounds = static(spark, d).select(
        "cell",
        F.greatest(F.col("lat") - 0.5, F.lit(-90.0)).alias("lat_b0"),
        F.least(F.col("lat") + 0.5, F.lit(90.0)).alias("lat_b1"),
        (F.col("lon") - 1.0).alias("lon_b0"),
        (F.col("lon") + 1.0).alias("lon_b1"),
    )
    return rg.cell_area(bounds).select("cell", "lat", "lon", F.round(F.col("areacella") / 1e6, 2).alias("area_km2"))


@query("source_land_area", "SELECT coalesce(sum(landfrac * area * 1e6), 0e0) AS land_area FROM static", ["static"])
def source_land_area(spark, d):
    return rg.source_land_area(static(spark, d))


@query(
    "grid_extent",
    """SELECT min(lat) AS lat_min, max(lat) AS lat_max, min(((lon % 360) + 360) % 360) AS lon_min, max(((lon % 360) + 360) % 360) AS lon_max FROM static""",
    ["static"],
)
def grid_extent(spark, d):
    return rg.grid_extent(static(spark, d))


@query("wrap_longitude", "SELECT cell, ((lon % 360) + 360) % 360 AS lon FROM static", ["static"])
def wrap(spark, d):
    return static(spark, d).select("cell", wrap_longitude(F.col("lon")).alias("lon"))


@query(
    "attach_static",
    "SELECT var, time_idx, lev, cell, value, landfrac, area, wet FROM price LEFT JOIN static USING (cell)",
    ["price", "static"],
)
def attach_static(spark, d):
    out = rg.attach_missing(field(spark, d, "PRICE"), static(spark, d), fixed.STATIC_CARRIED)
    return out.select("var", "time_idx", "lev", "cell", "value", "landfrac", "area", "wet")


@query(
    "attach_ice_grid",
    "SELECT time_idx, lev, cell, value, tlat AS TLAT, lon AS TLON, lon - 1e0 AS lont_bounds FROM conc_all JOIN static USING (cell)",
    ["conc_all", "static"],
)
def attach_ice_grid(spark, d):
    """A field kept on its native ice grid carries the cell centres and bounds of that grid."""
    conc = field(spark, d, "QTY").select("time_idx", "lev", "cell", "value")
    grid = static(spark, d).select("cell", F.col("tlat").alias("TLAT"), F.col("lon").alias("TLON"), (F.col("lon") - 1.0).alias("lont_bounds"))
    return rg.attach_missing(conc, grid, fixed.ICE_GRID_CARRIED)


@query(
    "attach_fixed_fields",
    """SELECT cell, coalesce(CASE WHEN cell % 4 = 0 THEN -1e0 END, sftlf) AS sftlf,
       greatest(0e0, least(100e0, (1e0 - sftlf / 100e0) * 100e0)) AS sftof, n
       FROM (SELECT cell, count(*) AS n FROM regridded GROUP BY 1) LEFT JOIN fx USING (cell)""",
    ["regridded", "fx"],
)
def attach_fixed_fields(spark, d):
    out = regrid_renorm(spark, d).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    own = out.withColumn("sftlf", F.when(F.col("cell") % 4 == 0, F.lit(-1.0)))
    return rg.attach_fixed_fields(own, fx_fractions(spark, d), ("sftlf", "sftof"))


@query(
    "attach_time_bounds",
    """SELECT var, time_idx, lev, cell, value, time_idx::DOUBLE AS time_b0, (time_idx + 1)::DOUBLE AS time_b1 FROM regridded""",
    ["regridded"],
)
def attach_time_bounds(spark, d):
    out = regrid_renorm(spark, d)
    months = field(spark, d, "PRICE").select("time_idx").distinct()
    axis = months.select("time_idx", F.col("time_idx").cast("double").alias("time_b0"), (F.col("time_idx") + 1).cast("double").alias("time_b1"))
    return rg.attach_time_bounds(out, axis, out_times=months)


@query(
    "pass_through_regular",
    "SELECT cell // 6 AS lat, cell % 6 AS lon, time_idx, lev, value FROM regridded",
    ["regridded"],
)
def pass_through_regular(spark, d):
    out = regrid_renorm(spark, d)
    regular = out.select(F.floor(F.col("cell") / 6).cast("long").alias("lat"), (F.col("cell") % 6).alias("lon"), "time_idx", "lev", "value")
    return rg.pass_through_regular(regular)


@query(
    "pick_map",
    """SELECT name, method, CASE method WHEN 'bilinear' THEN 'b30' ELSE 'c30' END AS map_id FROM (
       SELECT name, coalesce(own, CASE WHEN split_part(name, '_', 1) IN ('tas','psl','ps','ts','ta','ua','va','zg','hus') THEN 'bilinear' ELSE 'conservative' END) AS method
       FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'tas' WHEN 1 THEN 'pr' WHEN 2 THEN 'ua' ELSE 'hfls' END || '_' || p_partkey AS name,
                    CASE WHEN p_size % 10 = 0 THEN 'conservative' WHEN p_size % 10 = 1 THEN 'bilinear' END AS own FROM part))""",
)
def pick_map(spark, d):
    kind = F.col("p_partkey") % 4
    short = F.when(kind == 0, "tas").when(kind == 1, "pr").when(kind == 2, "ua").otherwise("hfls")
    own = F.when(F.col("p_size") % 10 == 0, "conservative").when(F.col("p_size") % 10 == 1, "bilinear")
    entries = read(spark, d, "part").select(F.concat(short, F.lit("_"), F.col("p_partkey")).alias("name"), own.alias("regrid_method"))
    maps = spark.createDataFrame(
        [("m", "ne30", "conservative", "c30"), ("m", "ne30", "bilinear", "b30"), ("m", "ne16", "conservative", "c16")],
        "model string, resolution string, method string, map_id string",
    )
    return rg.pick_map(entries, maps, "m", "ne30").select("name", "method", "map_id")
