"""The assembled plan, from native fields to output rows, over the given tables."""

from functools import reduce

from pyspark.sql import functions as F

from gridloom.functions.calendar import month_index
from gridloom.plans import prepare as pp
from gridloom.plans.bindings import NLON, coefficients, field, native, read, static, weights
from gridloom.plans.registry import query, view
from gridloom.plans.vertical_queries import PLEVS, with_interp

# S and PS have no levels: one value per time and cell.
view("col_s", "SELECT time_idx, cell, sum(DISC) AS S FROM native GROUP BY 1, 2", ("native",))
view("col_ps", "SELECT DISTINCT time_idx, cell, floor(ps) AS ps FROM native JOIN static USING (cell)", ("native", "static"))
view(
    "ps_on_grid",
    "SELECT time_idx, dst_cell AS cell, sum(w * ps) / sum(w) AS ps FROM col_ps JOIN cons ON src_cell = cell GROUP BY 1, 2",
    ("col_ps", "cons"),
)
view(
    "qty_on_grid",
    "SELECT 'ta_x' AS var, time_idx, lev, dst_cell AS cell, sum(w * QTY) / sum(w) AS value FROM native JOIN cons ON src_cell = cell GROUP BY 1, 2, 3, 4",
    ("native", "cons"),
)


def whole_field(spark, d):
    """QTY, DISC and TAX on levels; S and PS without."""
    columns = native(spark, d).groupBy("time_idx", "cell").agg(F.sum("DISC").alias("S"))
    pressure = columns.join(static(spark, d).select("cell", F.floor("ps").cast("double").alias("PS")), "cell")
    flat = lambda df, name: df.select(F.lit(name).alias("var"), "time_idx", F.lit(None).cast("int").alias("lev"), "cell", F.col(name).alias("value"))
    return reduce(lambda a, b: a.unionByName(b), [field(spark, d, "QTY", "DISC", "TAX"), flat(columns, "S"), flat(pressure, "PS")])


def months(spark, d):
    """The field's time axis: every month that has a line, without the sums by level and cell."""
    return read(spark, d, "lineitem").select(month_index(F.col("l_shipdate")).alias("time_idx")).distinct()


SHAPES = {"QTY": True, "DISC": True, "TAX": True, "S": False, "PS": False}


def target(name, route="general", source=None, formula=None, region=None, level=None, map_id="cons", surface="all", **aliases):
    return pp.Target(name, route, source, aliases, formula, region, level, map_id, surface)


def prepared(spark, d, targets):
    return pp.prepare(
        spark,
        whole_field(spark, d),
        targets,
        weights=weights(spark, d),
        static=static(spark, d),
        coefficients=coefficients(spark),
        levels={"plev39": PLEVS},
        lon_cells=NLON,
        available=SHAPES,
        dim_first=1,
    )


GENERAL = (
    target("direct_x", source="QTY"),
    target("mixed_x", formula="a * s", a="QTY", s="S"),
    target("static_x", formula="a + r", a="QTY", r="area"),
    target("guarded_x", formula="a + b / (a - a)", a="QTY", b="TAX"),
    target("variant_x", formula="a + b", region="north", a="QTY", b="TAX"),
    target("variant_x", formula="a - b", region="south", a="QTY", b="TAX"),
    target("summed_x", formula="verticalsum(a) + s", a="QTY", s="S"),
    target("capped_x", formula="verticalsum(a + b, capped_at=900) * s", a="QTY", b="TAX", s="S"),
    target("beside_x", formula="verticalsum(a) - b", a="QTY", b="TAX"),
    target("fixed_x", source="area"),
)
BAD = (
    target("unbound_x", formula="a + q", a="QTY"),
    target("absent_x", source="NOPE"),
    target("helper_x", formula="mystery(a)", a="QTY"),
    target("unread_x", formula="a + * b", a="QTY", b="TAX"),
    target("several_x", a="QTY", b="TAX"),
    target("nomap_x", source="QTY", map_id=None),
    target("nolevels_x", source="QTY", level="plev19"),
    target("flat_x", route="zonal_pressure", source="S", level="plev39"),
)
NATIVE = (
    target("sos_x", "ocean_native", "QTY", map_id=None, surface="ocean"),
    *[
        target("siarea_x", "seaice_native", None, f"(s * tarea / 100.).where(s.coords['TLAT'] {sign} 0).sum(dim=['nj', 'ni'])", region, None, None, "ocean", s="S", tarea="tarea")
        for region, sign in (("nh", ">"), ("sh", "<"))
    ],
)
ZONAL = (target("ta_x", "zonal_pressure", "QTY", level="plev39"),)
HYBRID = (target("ta_x", "general", "QTY", level="standard_hybrid_sigma"),)

view(
    "general_values",
    """SELECT 'direct_x' AS var, NULL::VARCHAR AS region, time_idx, lev, cell, QTY AS value FROM native
       UNION ALL SELECT 'mixed_x', NULL, time_idx, lev, cell, QTY * S FROM native JOIN col_s USING (time_idx, cell)
       UNION ALL SELECT 'static_x', NULL, time_idx, lev, cell, QTY + area FROM native JOIN static USING (cell)
       UNION ALL SELECT 'guarded_x', NULL, time_idx, lev, cell, NULL FROM native
       UNION ALL SELECT 'variant_x', 'north', time_idx, lev, cell, QTY + TAX FROM native
       UNION ALL SELECT 'variant_x', 'south', time_idx, lev, cell, QTY - TAX FROM native
       UNION ALL SELECT 'summed_x', NULL, time_idx, NULL, cell, sum(QTY) + sum(DISC) FROM native GROUP BY time_idx, cell
       UNION ALL SELECT 'capped_x', NULL, time_idx, NULL, cell, least(900, sum(QTY + TAX)) * sum(DISC) FROM native GROUP BY time_idx, cell
       UNION ALL SELECT 'beside_x', NULL, time_idx, lev, cell, sum(QTY) OVER (PARTITION BY time_idx, cell) - TAX FROM native
       UNION ALL SELECT 'fixed_x', NULL, NULL, NULL, cell, area FROM static""",
    ("native", "col_s", "static"),
)
view(
    "general_rows",
    """SELECT var, region, time_idx, lev, dst_cell AS cell, sum(w * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value
       FROM general_values JOIN cons ON src_cell = cell GROUP BY 1, 2, 3, 4, 5""",
    ("general_values", "cons"),
)


@query("prepare_general", "SELECT * FROM general_rows", ["general_rows"])
def prepare_general(spark, d):
    return prepared(spark, d, GENERAL)[0]["general"].select("var", "region", "time_idx", "lev", "cell", "value")


@query(
    "prepare_zonal",
    with_interp(
        "(SELECT * FROM qty_on_grid JOIN ps_on_grid USING (time_idx, cell) JOIN coeff USING (lev))",
        "var, time_idx, cell",
        f"SELECT var, time_idx, plev, (cell // {NLON})::INTEGER AS ilat, round(avg(value), 6) AS value FROM interp GROUP BY 1, 2, 3, 4",
        ["qty_on_grid", "ps_on_grid", "coeff"],
    ),
)
def prepare_zonal(spark, d):
    return prepared(spark, d, ZONAL)[0]["zonal_pressure"].withColumn("value", F.round("value", 6))  # a mean depends on its order


@query(
    "prepare_hybrid",
    "SELECT var, time_idx, lev, cell, value, ps, hyam AS a, hybm AS b, 100000e0 AS p0 FROM qty_on_grid JOIN ps_on_grid USING (time_idx, cell) JOIN coeff USING (lev)",
    ["qty_on_grid", "ps_on_grid", "coeff"],
)
def prepare_hybrid(spark, d):
    """The three tables that are stored, put together again."""
    outputs = prepared(spark, d, HYBRID)[0]
    surface = outputs["hybrid_ps"].select("time_idx", "cell", F.col("value").alias("ps"))
    rows = outputs["hybrid"].join(surface, ["time_idx", "cell"]).join(outputs["hybrid_levels"], "lev")
    return rows.select("var", "time_idx", "lev", "cell", "value", "ps", "a", "b", "p0")


NAMES = list(dict.fromkeys(t.name for t in GENERAL))
view(
    "described_catalog",
    f"""SELECT {NAMES}[p_partkey::INTEGER] AS var, p_brand AS units, p_name AS long_name, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS standard_name
        FROM part WHERE p_partkey <= {len(NAMES)}""",
)


@query(
    "prepare_described",
    """SELECT var, region, time_idx, lev, cell, value, units, long_name, standard_name, time_idx * 30e0 + 15e0 AS time, time_idx * 30e0 AS time_b0, time_idx * 30e0 + 30e0 AS time_b1
       FROM general_rows LEFT JOIN described_catalog USING (var)""",
    ["general_rows", "described_catalog"],
)
def prepare_described(spark, d):
    """General outputs with attributes and time; one catalog entry per target comes from a part."""
    k = F.col("p_partkey")
    name = F.get(F.array(*[F.lit(n) for n in NAMES]), (k - 1).cast("int"))
    entries = read(spark, d, "part").select(
        name.alias("name"), F.col("p_brand").alias("units"), F.col("p_name").alias("long_name"), F.when(k % 2 == 0, F.col("p_type")).alias("standard_name")
    )
    start = F.col("time_idx") * 30.0
    axis = months(spark, d).select("time_idx", (start + 15.0).alias("time"), start.alias("time_b0"), (start + 30.0).alias("time_b1"))
    rows = pp.described({"general": prepared(spark, d, GENERAL)[0]["general"]}, entries.filter("name IS NOT NULL"), axis)["general"]
    return rows.select("var", "region", "time_idx", "lev", "cell", "value", "units", "long_name", "standard_name", "time", "time_b0", "time_b1")


@query(
    "prepare_native",
    """SELECT 'sos_x' AS var, NULL::VARCHAR AS region, time_idx, lev, cell, QTY AS value FROM native
       UNION ALL SELECT 'siarea_x', r, time_idx, NULL, NULL, coalesce(sum(CASE WHEN (r = 'nh' AND tlat > 0) OR (r = 'sh' AND tlat < 0) THEN S * tarea / 100e0 END), 0e0)
       FROM col_s JOIN static USING (cell), (VALUES ('nh'), ('sh')) g(r) GROUP BY 2, 3""",
    ["native", "col_s", "static"],
)
def prepare_native(spark, d):
    outputs = prepared(spark, d, NATIVE)[0]
    both = outputs["ocean_native"].unionByName(outputs["seaice_native"], allowMissingColumns=True)
    return both.select("var", "region", "time_idx", "lev", "cell", "value")


KEPT = (*NATIVE, target("siconc_x", "seaice_native", "S", map_id=None, surface="ocean"))
KEPT_ENTRIES = """CASE p_partkey WHEN 1 THEN 'sos_x' WHEN 2 THEN 'siconc_x' ELSE 'siarea_x' END"""
view("depth", "SELECT p_partkey::INTEGER AS lev, p_size::DOUBLE AS level, p_size - 0.5e0 AS level_b0, p_size + 0.5e0 AS level_b1 FROM part WHERE p_partkey <= 7")
view(
    "kept_rows",
    """SELECT 'sos_x' AS var, NULL::VARCHAR AS region, time_idx, lev, cell, QTY AS value FROM native
       UNION ALL SELECT 'siconc_x', NULL, time_idx, NULL, cell, S FROM col_s
       UNION ALL SELECT 'siarea_x', r, time_idx, NULL, NULL, coalesce(sum(CASE WHEN (r = 'nh' AND tlat > 0) OR (r = 'sh' AND tlat < 0) THEN S * tarea / 100e0 END), 0e0)
       FROM col_s JOIN static USING (cell), (VALUES ('nh'), ('sh')) g(r) GROUP BY 2, 3""",
    ("native", "col_s", "static"),
)
NOLEAP = "(({y}) - 1850) * 365e0 + [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334][({m}) + 1]"
THIS = NOLEAP.format(y="time_idx // 12", m="time_idx % 12")
NEXT = NOLEAP.format(y="(time_idx + 1) // 12", m="(time_idx + 1) % 12")


@query(
    "prepare_native_described",
    f"""SELECT var, region, time_idx, lev, k.cell, value, p_brand AS units, CASE var WHEN 'sos_x' THEN 'olevel' ELSE 'none' END AS level_kind, level, level_b0, level_b1,
        CASE var WHEN 'siconc_x' THEN tlat END AS "TLAT", CASE var WHEN 'siconc_x' THEN lon END AS "TLON", CASE var WHEN 'siconc_x' THEN lon - 1e0 END AS lont_west,
        {THIS} + 14e0 AS time, {THIS} AS time_b0, {NEXT} AS time_b1
        FROM kept_rows k JOIN (SELECT {KEPT_ENTRIES} AS var, p_brand FROM part WHERE p_partkey <= 3) USING (var) LEFT JOIN depth USING (lev) LEFT JOIN static s ON s.cell = k.cell""",
    ["kept_rows", "depth", "static"],
)
def prepare_native_described(spark, d):
    """Outputs on native grids as they are stored: ice rows with centres and vertices, ocean levels with depths, dates as noleap days."""
    parts = read(spark, d, "part")
    k = F.col("p_partkey")
    null = F.lit(None).cast("string")
    names = lambda *n: F.array(F.array(*[F.lit(x) for x in n]))
    entries = parts.filter(k <= 3).select(
        F.expr(KEPT_ENTRIES).alias("name"), F.col("p_brand").alias("units"), null.alias("long_name"), null.alias("standard_name"),
        F.when(k == 1, "ocean").otherwise("seaIce").alias("table"), F.struct(null.alias("name")).alias("levels"),
        F.when(k == 1, names("time", "olevel", "latitude", "longitude")).when(k == 2, names("time", "latitude", "longitude")).otherwise(names("time")).alias("dims"),
    )
    size = F.col("p_size").cast("double")
    depths = parts.filter(k <= 7).select(k.cast("int").alias("lev"), size.alias("level"), (size - 0.5).alias("level_b0"), (size + 0.5).alias("level_b1"))
    ice = static(spark, d).select(
        "cell", F.col("tlat").alias("TLAT"), F.col("lon").alias("TLON"), F.array(F.col("lon") - 1.0, F.col("lon") + 1.0).alias("lont_bounds")
    )
    first = lambda n: F.make_date(F.floor(n / 12).cast("int"), (n % 12 + 1).cast("int"), F.lit(1))
    month = F.col("time_idx")
    axis = months(spark, d).select("time_idx", F.date_add(first(month), 14).alias("time"), first(month).alias("time_b0"), first(month + 1).alias("time_b1"))
    outputs = pp.described(prepared(spark, d, KEPT)[0], entries, axis, ice_grid=ice, levels={"olevel": depths})
    both = outputs["ocean_native"].unionByName(outputs["seaice_native"], allowMissingColumns=True)
    kept = [c for c in both.columns if c not in ("long_name", "standard_name", "lont_bounds")]
    return both.select(*kept, F.col("lont_bounds")[0].alias("lont_west"))


REPORTED = (
    ("unbound_x", "formula names what no source gives: q"),
    ("absent_x", "missing inputs: NOPE"),
    ("helper_x", "formula calls unknown helper mystery"),
    ("unread_x", "formula is not readable"),
    ("several_x", "incomplete mapping: several sources without a formula"),
    ("nomap_x", "no weight map"),
    ("nolevels_x", "no levels given for plev19"),
    ("flat_x", "levels are asked of variables without levels"),
)


@query(
    "prepare_status",
    f"""SELECT name, status, coalesce(n, 0) AS n_rows FROM (
        SELECT DISTINCT var AS name, 'ok' AS status FROM general_rows
        UNION ALL SELECT * FROM (VALUES {", ".join(str(r) for r in REPORTED)}) b(name, status)) s
        LEFT JOIN (SELECT var AS name, count(*) AS n FROM general_rows GROUP BY 1) c USING (name)""",
    ["general_rows"],
)
def prepare_status(spark, d):
    """Status and number of rows of every target; bad targets stop no others."""
    outputs, status = prepared(spark, d, GENERAL + BAD)
    counts = reduce(lambda a, b: a.unionByName(b), [df.groupBy(F.col("var").alias("name")).count() for df in outputs.values()])
    told = spark.createDataFrame(sorted(set(status)), "name string, status string")
    return told.join(counts, "name", "left").select("name", "status", F.coalesce("count", F.lit(0)).cast("long").alias("n_rows"))
