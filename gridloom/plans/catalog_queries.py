"""Catalog, request and sheet jobs over entries derived from the given tables."""

from pyspark.sql import functions as F

from gridloom.functions import text as tx
from gridloom.operators import catalog as ct
from gridloom.plans import prepare as pp
from gridloom.plans.bindings import read
from gridloom.plans.registry import query, view
from gridloom.sources.tables import flatten_tables

# Plain columns of an entry; both engines read the same text.
ENTRY = {
    "name": "'v' || p_partkey || '_tavg-u-hxy-u'",
    "ord": "p_partkey",
    "table": "CASE p_partkey % 5 WHEN 0 THEN 'CMIP7_atmos' WHEN 1 THEN 'land' WHEN 2 THEN 'seaIce' WHEN 3 THEN 'ocean' ELSE 'aerosol' END",
    "units": "'K'",
    "formula": "CASE WHEN p_partkey % 6 = 0 THEN 'X0 + X1' END",
    "long_name": "p_name",
    "region": "CASE WHEN p_partkey % 4 = 0 THEN 'glb' END",
}
LEVEL = "CASE p_size % 5 WHEN 0 THEN 'plev19' WHEN 1 THEN 'standard_hybrid_sigma' WHEN 2 THEN 'plev39' END"
MODEL_VAR = "upper(split_part(p_name, ' ', 1)) || '_' || j"
ALIAS = "CASE WHEN j = 1 THEN 'a' || (p_partkey % 2) END"
FREQ = "CASE (p_partkey + j) % 4 WHEN 0 THEN 'mon' WHEN 1 THEN 'day' WHEN 2 THEN NULL ELSE 'mon' END"

view("entry", "SELECT " + ", ".join(f'{sql} AS "{c}"' for c, sql in ENTRY.items()) + f", {LEVEL} AS level, p_partkey, p_size, p_name FROM part")
view(
    "source",
    f"SELECT name, p_partkey, j, {MODEL_VAR} AS model_var, {ALIAS} AS alias, {FREQ} AS freq FROM entry, generate_series(0, 2) g(j) WHERE j <= p_size % 3",
    ("entry",),
)
view(
    "variant",
    """SELECT name, ord, 0::INTEGER AS variant, long_name, formula, region FROM entry WHERE p_partkey % 10 <> 0
       UNION ALL SELECT name, ord, v::INTEGER, CASE v WHEN 0 THEN 'north' ELSE 'south' END, CASE WHEN v = 0 THEN 'N' ELSE formula END, CASE v WHEN 0 THEN 'nh' ELSE 'sh' END
       FROM entry, generate_series(0, 1) g(v) WHERE p_partkey % 10 = 0""",
    ("entry",),
)


def catalog(spark, d):
    part = read(spark, d, "part")
    j = lambda text: F.expr(f"transform(sequence(0, p_size % 3), j -> {text})")
    zipped = F.arrays_zip(j(MODEL_VAR).alias("m"), j(ALIAS).alias("a"), j(FREQ).alias("f"))
    sources = F.transform(zipped, lambda s: F.struct(s["m"].alias("model_var"), s["a"].alias("alias"), s["f"].alias("freq")))
    level = F.expr(LEVEL)
    variant = lambda name, formula, region: F.struct(F.lit(name).alias("long_name"), F.lit(formula).cast("string").alias("formula"), F.lit(region).alias("region"))
    two = F.array(variant("north", "N", "nh"), variant("south", None, "sh"))
    dims = F.when(
        F.col("p_partkey") % 7 == 0, F.array(ct.strings(["time", "latitude", "longitude"]), ct.strings(["time", "lat", "lon"]))
    ).when(F.col("p_partkey") % 7 == 1, F.array(ct.strings(["time"]))).otherwise(F.array(ct.strings(["time", "lat", "lon"])))
    null = F.lit(None).cast("string")
    return part.select(
        *[F.expr(sql).alias(c) for c, sql in ENTRY.items()],
        null.alias("positive"), null.alias("cell_methods"), null.alias("regrid_method"), null.alias("standard_name"),
        dims.alias("dims"),
        sources.alias("sources"),
        F.when(level.isNotNull(), F.struct(level.alias("name"), F.lit("Pa").alias("units"), null.alias("src_axis_name"), null.alias("src_axis_bnds"))).alias("levels"),
        F.when(F.col("p_partkey") % 10 == 0, two).alias("variants"),
        "p_partkey",
    )


def joined(column, field="model_var"):
    return F.array_join(F.transform(column, lambda s: s[field]), ",")


REQUEST = {
    "name": "'v' || (o_custkey % 3000) || '_tavg-u-hxy-u'",
    "ord": "o_orderkey",
    "parameter": "o_orderpriority",
    "realm": "CASE o_orderkey % 3 WHEN 0 THEN 'atmos' WHEN 1 THEN 'land' ELSE 'ocean' END",
    "frequency": "CASE WHEN o_orderkey % 2 = 0 THEN 'mon' ELSE 'day' END",
    "experiment": "'exp' || o_orderstatus",
    "region": "CASE o_orderkey % 7 WHEN 0 THEN '30S-90S' WHEN 1 THEN 'glb' END",
    "priority": "o_orderkey % 4",
}
view("request", "SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in REQUEST.items()) + " FROM orders")


def request(spark, d):
    return read(spark, d, "orders").select(*[F.expr(sql).alias(c) for c, sql in REQUEST.items()])


@query(
    "required_inputs",
    """SELECT DISTINCT name, var FROM (
       SELECT name, model_var AS var FROM source
       UNION ALL SELECT name, unnest(['PS', 'hyam', 'hybm', 'P0']) FROM entry WHERE level LIKE 'plev%'
       UNION ALL SELECT name, unnest(['PS', 'hyam', 'hybm', 'hyai', 'hybi', 'P0', 'ilev']) FROM entry WHERE level = 'standard_hybrid_sigma'
       UNION ALL SELECT name, unnest(['area', 'landmask', 'landfrac', 'TLAT']) FROM entry)""",
    ["entry", "source"],
)
def required_inputs(spark, d):
    return ct.required_inputs(catalog(spark, d))


@query(
    "required_variables",
    """SELECT DISTINCT var FROM (SELECT model_var AS var FROM source WHERE name IN (SELECT name FROM request)
       UNION ALL SELECT unnest(['PS', 'hyam', 'hybm', 'hyai', 'hybi', 'P0', 'ilev', 'area', 'landmask', 'landfrac', 'TLAT'])) ORDER BY var""",
    ["source", "request"],
)
def required_variables(spark, d):
    return ct.required_variables(catalog(spark, d), request(spark, d))


PATH = "'/data/run.cam.h' || (o_orderkey % 3) || 'a.V' || (o_custkey % 50) || '.' || o_orderkey || '.nc'"


@query(
    "select_files",
    f"""SELECT path FROM (SELECT {PATH} AS path, 'V' || (o_custkey % 50) AS var FROM orders) WHERE path LIKE '%cam.h0a%'
        AND var IN (SELECT 'V' || s_suppkey FROM supplier WHERE s_acctbal > 3000)""",
)
def select_files(spark, d):
    files = read(spark, d, "orders").select(F.expr(PATH).alias("path"))
    wanted = read(spark, d, "supplier").filter("s_acctbal > 3000").select(F.concat(F.lit("V"), "s_suppkey").alias("var"))
    return ct.select_files(files, wanted, "cam.h0a")


@query(
    "drop_targets_without_inputs",
    """SELECT name FROM entry WHERE name NOT IN (SELECT name FROM source WHERE model_var NOT IN
       (SELECT upper(split_part(p_name, ' ', 1)) || '_' || (p_size % 2) FROM part WHERE p_size > 2))""",
    ["entry", "source"],
)
def drop_targets_without_inputs(spark, d):
    have = read(spark, d, "part").filter("p_size > 2").select(F.expr("upper(split_part(p_name, ' ', 1)) || '_' || (p_size % 2)").alias("var"))
    return ct.drop_targets_without_inputs(catalog(spark, d), have).select("name")


SOURCES_FOR_DAY = """SELECT name, string_agg(model_var, ',' ORDER BY rank, j) AS vars FROM (
   SELECT *, CASE WHEN untagged = n THEN 0 WHEN matched > 0 THEN CASE WHEN freq = 'day' THEN 0 WHEN freq IS NULL THEN 1 END
          WHEN untagged > 0 THEN CASE WHEN freq IS NULL THEN 0 END ELSE 0 END AS rank FROM (
     SELECT *, count(*) OVER w AS n, count(CASE WHEN freq = 'day' THEN 1 END) OVER w AS matched, count(*) OVER w - count(freq) OVER w AS untagged
     FROM source WINDOW w AS (PARTITION BY name))) WHERE rank IS NOT NULL GROUP BY 1"""


@query("sources_for_freq", SOURCES_FOR_DAY, ["source"])
def sources_for_freq(spark, d):
    return catalog(spark, d).select("name", joined(ct.sources_for_freq(F.col("sources"), "day")).alias("vars"))


@query("supports_freq", "SELECT name FROM source GROUP BY 1 HAVING bool_or(freq IS NULL OR freq = 'day')", ["source"])
def supports_freq(spark, d):
    return catalog(spark, d).filter(ct.supports_freq(F.col("sources"), "day")).select("name")


@query("expand_variants", "SELECT name, variant, long_name, formula, region FROM variant", ["variant"])
def expand_variants(spark, d):
    return ct.expand_variants(catalog(spark, d)).select("name", "variant", "long_name", "formula", "region")


@query("alias_binding", "SELECT name, coalesce(alias, model_var) AS token, model_var FROM source", ["source"])
def alias_binding(spark, d):
    return catalog(spark, d).select("name", F.explode(ct.alias_binding(F.col("sources"))).alias("token", "model_var"))


@query(
    "normalize_catalog",
    f"""SELECT e.name, replace(e."table", 'CMIP7_', '') AS "table", CASE WHEN n = 1 AND formula IS NULL THEN vars END AS source,
        CASE WHEN NOT (n = 1 AND formula IS NULL) THEN vars END AS raw_variables
        FROM entry e JOIN (SELECT *, length(vars) - length(replace(vars, ',', '')) + 1 AS n FROM ({SOURCES_FOR_DAY})) s USING (name)""",
    ["entry", "source"],
)
def normalize_catalog(spark, d):
    out = ct.normalize_catalog(catalog(spark, d), "day")
    return out.select("name", "table", "source", F.array_join("raw_variables", ",").alias("raw_variables"))


@query(
    "request_filter",
    "SELECT name, ord FROM request WHERE realm = 'atmos' AND frequency = 'mon' AND experiment = 'expF' AND coalesce(region, '') <> '30S-90S'",
    ["request"],
)
def request_filter(spark, d):
    return ct.request_filter(request(spark, d), "atmos", "mon", "expF").select("name", "ord")


@query(
    "restrict_to_names",
    "SELECT name, min(ord) AS ord, arg_min(parameter, ord) AS parameter FROM request WHERE name IN ('v1_tavg-u-hxy-u', 'v20_tavg-u-hxy-u', 'v300_tavg-u-hxy-u') GROUP BY 1 ORDER BY 2",
    ["request"],
)
def restrict_to_names(spark, d):
    names = ["v1_tavg-u-hxy-u", "v20_tavg-u-hxy-u", "v300_tavg-u-hxy-u"]
    return ct.restrict_to_names(request(spark, d), names).select("name", "ord", "parameter")


view("monthly", "SELECT name, count(*) AS n, min(model_var) AS single FROM source WHERE freq IS NULL OR freq = 'mon' GROUP BY 1", ("source",))
view("asked", "SELECT name, arg_min(parameter, ord) AS parameter FROM request GROUP BY 1", ("request",))
view(
    "out_grid",
    """SELECT name, replace("table", 'CMIP7_', '') AS realm, level,
       unnest(CASE p_partkey % 7 WHEN 0 THEN ['native', 'latlon'] WHEN 1 THEN ['point'] ELSE ['latlon'] END) AS g FROM entry""",
    ("entry",),
)


@query(
    "plan_requested",
    """SELECT DISTINCT name, v.region, v.formula, CASE WHEN n = 1 AND coalesce(v.formula, '') = '' THEN single END AS source,
         CASE WHEN realm = 'ocean' AND g = 'native' THEN 'ocean_native' WHEN realm = 'seaIce' AND g = 'point' THEN 'seaice_native'
              WHEN level = 'plev39' THEN 'zonal_pressure' ELSE 'general' END AS route,
         CASE WHEN level <> 'standard_hybrid_sigma' OR level IS NULL THEN 'none' WHEN realm IN ('atmos', 'aerosol') THEN 'hybrid' ELSE 'misplaced' END AS kind,
         coalesce(parameter, name) AS parameter, parameter IS NULL AS synthetic
       FROM variant v JOIN monthly USING (name) JOIN out_grid USING (name) LEFT JOIN asked USING (name)""",
    ["variant", "monthly", "asked", "out_grid"],
)
def plan_requested(spark, d):
    """Every monthly target of the catalog by its way, with the request's parameter or as a synthetic one."""
    rows = pp.target_rows(catalog(spark, d), "cesm", "mon", request=request(spark, d))
    return rows.select("name", "region", "formula", "source", "route", "kind", "parameter", "synthetic")


@query(
    "assemble_targets",
    """SELECT e.name, e.ord, coalesce(r.parameter, e.name) AS parameter, r.name IS NULL AS is_synthetic FROM entry e
       LEFT JOIN (SELECT name, arg_min(parameter, ord) AS parameter FROM request GROUP BY 1) r USING (name)
       WHERE e.name IN (SELECT name FROM source GROUP BY 1 HAVING bool_or(freq IS NULL OR freq = 'mon'))""",
    ["entry", "request", "source"],
)
def assemble_targets(spark, d):
    return ct.assemble_targets(catalog(spark, d), request(spark, d), "mon").select("name", "ord", "parameter", "is_synthetic")


view(
    "target",
    """SELECT *, 'time,latitude,longitude' AS dims FROM entry WHERE p_partkey % 7 = 0
       UNION ALL SELECT *, CASE WHEN p_partkey % 7 = 1 THEN 'time' ELSE 'time,lat,lon' END FROM entry""",
    ("entry",),
)


@query("split_targets", "SELECT name, dims FROM target", ["target"])
def split_targets(spark, d):
    return ct.split_targets(catalog(spark, d)).select("name", F.array_join("dims", ",").alias("dims"))


@query(
    "route",
    """SELECT name, dims, CASE WHEN "table" = 'ocean' AND dims LIKE '%latitude%' THEN 'ocean_native'
       WHEN "table" = 'seaIce' AND dims = 'time' THEN 'seaice_native' WHEN level = 'plev39' THEN 'zonal_pressure' ELSE 'general' END AS route FROM target""",
    ["target"],
)
def route(spark, d):
    each = ct.split_targets(catalog(spark, d))
    way = ct.route(F.col("dims"), F.col("table"), "cesm", F.col("levels.name"))
    return each.select("name", F.array_join("dims", ",").alias("dims"), way.alias("route"))


@query(
    "level_kind",
    "SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'hybrid' WHEN 1 THEN 'plev39' WHEN 2 THEN 'plev' WHEN 3 THEN 'sdepth' WHEN 4 THEN 'olevel' ELSE 'pft' END AS kind FROM part",
)
def level_kind(spark, d):
    kind = F.col("p_size") % 6
    dims = F.array(
        F.lit("time"), F.when(kind == 0, "lev").when(kind.isin(1, 2), "plev").when(kind == 3, "sdepth").when(kind == 4, "zl").otherwise("fates_levpft")
    )
    level = F.when(kind == 1, "plev39").when(kind == 0, "standard_hybrid_sigma")
    return read(spark, d, "part").select("p_partkey", ct.level_kind(dims, level, F.lit("atmosChem")).alias("kind"))


@query(
    "canonical_realm",
    """SELECT name, CASE realm WHEN 'aerosol' THEN 'atmos' WHEN 'ocnBgchem' THEN 'ocean' ELSE realm END AS realm FROM
       (SELECT name, CASE "table" WHEN 'ocean' THEN 'ocnBgchem' ELSE "table" END AS realm FROM entry)""",
    ["entry"],
)
def canonical_realm(spark, d):
    realm = F.when(F.col("table") == "ocean", "ocnBgchem").otherwise(F.col("table"))
    return catalog(spark, d).select("name", tx.canonical_realm(realm).alias("realm"))


SHEET_ROW = {
    # Up to three rows of a name, as an entry has a row per region.
    "name": "'n' || cast(floor(o_orderkey / 3) AS bigint)",
    "ord": "o_orderkey",
    "table": "CASE cast(floor(o_orderkey / 3) AS bigint) % 2 WHEN 0 THEN 'seaIce' ELSE 'land' END",
    "long_name": "o_orderpriority",
    "formula": "'f' || o_orderkey",
    "region": "CASE o_orderkey % 2 WHEN 0 THEN 'nh' ELSE 'sh' END",
}
view("sheet_row", "SELECT " + ", ".join(f'{sql} AS "{c}"' for c, sql in SHEET_ROW.items()) + " FROM orders")


@query(
    "group_catalog_rows",
    """SELECT name, "table", CASE WHEN many THEN NULL ELSE f END AS formula, CASE WHEN many THEN all_f END AS variant_formulas FROM (
       SELECT name, arg_min("table", ord) AS "table", arg_min(formula, ord) AS f, count(*) > 1 AND arg_min("table", ord) = 'seaIce' AS many,
              string_agg(formula || ':' || region, ',' ORDER BY ord) AS all_f FROM sheet_row GROUP BY 1)""",
    ["sheet_row"],
)
def group_catalog_rows(spark, d):
    rows = read(spark, d, "orders").select(*[F.expr(sql).alias(c) for c, sql in SHEET_ROW.items()])
    listed = F.array_join(F.transform("variants", lambda v: F.concat_ws(":", v["formula"], v["region"])), ",")
    return ct.group_catalog_rows(rows).select("name", "table", "formula", listed.alias("variant_formulas"))


view("defined", "SELECT 'v' || p_partkey || '_tavg-u-hxy-u' AS name, p_brand AS \"table\" FROM part WHERE p_size > 10")
view("mapped", "SELECT name FROM entry WHERE p_partkey % 3 = 0", ("entry",))


def gap(spark, d):
    tables = read(spark, d, "part").filter("p_size > 10").select(F.expr(ENTRY["name"]).alias("name"), F.col("p_brand").alias("table"))
    return ct.catalog_gap(request(spark, d), tables, catalog(spark, d).filter("p_partkey % 3 = 0"))


view(
    "gap",
    """SELECT r.name, d."table", CASE WHEN d.name IS NULL THEN 'not_in_tables' ELSE 'stub' END AS kind FROM (SELECT DISTINCT name FROM request) r
       LEFT JOIN defined d USING (name) WHERE r.name NOT IN (SELECT name FROM mapped)""",
    ("request", "defined", "mapped"),
)


@query("catalog_gap", 'SELECT name, "table", kind FROM gap ORDER BY "table", name', ["gap"])
def catalog_gap(spark, d):
    return gap(spark, d).orderBy("table", "name")


view("rollup", "SELECT name, string_agg(DISTINCT experiment, ',' ORDER BY experiment) AS experiments, min(priority) AS priority FROM request GROUP BY 1", ("request",))


@query("request_rollup", "SELECT * FROM rollup", ["rollup"])
def request_rollup(spark, d):
    rolled = ct.request_rollup(request(spark, d))
    return rolled.withColumn("experiments", F.array_join("experiments", ","))


@query(
    "merge_catalog_rows",
    """SELECT m.name, NULL AS "table", false AS is_stub, p.parameter, r.priority, r.experiments FROM mapped m LEFT JOIN rollup r USING (name)
         LEFT JOIN (SELECT name, min(parameter) AS parameter FROM request GROUP BY 1) p USING (name)
       UNION ALL SELECT g.name, g."table", true, p.parameter, r.priority, r.experiments FROM gap g JOIN rollup r USING (name)
         JOIN (SELECT name, min(parameter) AS parameter FROM request GROUP BY 1) p USING (name) WHERE kind = 'stub'""",
    ["mapped", "rollup", "gap", "request"],
)
def merge_catalog_rows(spark, d):
    asked = request(spark, d)
    parameter = asked.groupBy("name").agg(F.min("parameter").alias("parameter"))
    meta = request_rollup(spark, d).join(parameter, "name")
    existing = catalog(spark, d).filter("p_partkey % 3 = 0").select("name")
    stubs = gap(spark, d).filter("kind = 'stub'").select("name", "table")
    return ct.merge_catalog_rows(existing, stubs, meta).select("name", "table", "is_stub", "parameter", "priority", "experiments")


# --- sheet cells ---------------------------------------------------------------------------------------------------

CELLS = {
    "dim": "'\"' || CASE p_partkey % 5 WHEN 0 THEN 'longitude' WHEN 1 THEN 'latitude' WHEN 2 THEN 'alevel' WHEN 3 THEN 'time4' ELSE p_name END || '\" '",
    "number": "CASE p_partkey % 3 WHEN 0 THEN '1.00' || p_size || ',5' WHEN 1 THEN 'kg m−' || p_size || ' s.1' ELSE '−' || p_size || ',25' END",
}


@query(
    "sheet_clean",
    f"""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'lon' WHEN 1 THEN 'lat' WHEN 2 THEN 'lev' WHEN 3 THEN 'time' ELSE p_name END AS dim,
        CASE p_partkey % 3 WHEN 0 THEN '100' || p_size || '.5' WHEN 1 THEN 'kg m-' || p_size || ' s.1' ELSE '-' || p_size || '.25' END AS number FROM part""",
)
def sheet_clean(spark, d):
    cells = read(spark, d, "part").select("p_partkey", *[F.expr(sql).alias(c) for c, sql in CELLS.items()])
    return cells.select("p_partkey", tx.clean_cell(F.col("dim"), rename_dimensions=True).alias("dim"), tx.plain_number(F.col("number")).alias("number"))


@query(
    "sheet_keep",
    """SELECT p_partkey FROM part WHERE p_partkey % 4 IN (0, 1) AND p_size % 6 NOT IN (0, 1) AND p_brand <> 'Brand#2'""",
)
def sheet_keep(spark, d):
    realm = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'atmos' WHEN 1 THEN 'land' WHEN 2 THEN 'ocean' END")
    source = F.expr("CASE p_size % 6 WHEN 0 THEN '  ' WHEN 1 THEN p_name || ' can be derived' ELSE p_name END")
    name = F.expr("p_name || CASE WHEN p_brand = 'Brand#2' THEN '_tpt-x' ELSE '_tavg-x' END")
    return read(spark, d, "part").filter(tx.keep_row(realm, source, name, ("atmos", "land", "aerosol"))).select("p_partkey")


EXPRESSION = """CASE p_partkey % 6 WHEN 0 THEN upper(replace(p_name, ' ', ' + ')) WHEN 1 THEN 'verticalsum(A' || p_size || ', capped_at=5)'
   WHEN 2 THEN 'T' || p_size WHEN 3 THEN 'A, B' || p_size WHEN 4 THEN 'FATES_GPP_PF(1:' || (p_size % 4 + 1) || ') - PCT_LANDUNIT(' || p_size || ') + NPP(1,2)' ELSE 'B * 2.5' END"""
view("expr", f"SELECT p_partkey, p_size, p_name, {EXPRESSION} AS text FROM part")


def expressions(spark, d):
    return read(spark, d, "part").select("p_partkey", F.expr(EXPRESSION).alias("text"))


@query(
    "is_expression",
    """SELECT p_partkey, p_partkey % 6 NOT IN (2, 3) AS is_expression, CASE WHEN p_partkey % 6 = 3 THEN 'A|B' || p_size WHEN p_partkey % 6 = 2 THEN text END AS identifiers FROM expr""",
    ["expr"],
)
def is_expression(spark, d):
    # "A, B" is a list, not an expression: the comma stands between word and blank.
    text = F.col("text")
    return expressions(spark, d).select("p_partkey", tx.is_expression(text).alias("is_expression"), F.array_join(tx.identifier_list(text), "|").alias("identifiers"))


@query(
    "expression_variables",
    r"""SELECT p_partkey, array_to_string(list_concat(list_filter(regexp_extract_all(text, '[A-Za-z_]\w*'), lambda w: w NOT IN ('verticalsum', 'capped_at', 'dim', 'sum', 'np')),
        CASE WHEN contains(text, 'FATES') AND NOT contains(text, 'FATES_FRAC') THEN ['FATES_FRAC'] ELSE [] END), '|') AS names FROM expr""",
    ["expr"],
)
def expression_variables(spark, d):
    return expressions(spark, d).select("p_partkey", F.array_join(tx.expression_variables(F.col("text")), "|").alias("names"))


@query(
    "index_sum_rewrite",
    """SELECT p_partkey, v AS var, CASE v WHEN 'FATES_GPP_PF' THEN array_to_string(range(1, p_size % 4 + 2), ',') WHEN 'PCT_LANDUNIT' THEN p_size::VARCHAR ELSE '1,2' END AS idx,
       CASE v WHEN 'FATES_GPP_PF' THEN 'fates_levpft' WHEN 'PCT_LANDUNIT' THEN 'ltype' ELSE 'lev' END AS dim
       FROM expr, (VALUES ('FATES_GPP_PF'), ('PCT_LANDUNIT'), ('NPP')) g(v) WHERE p_partkey % 6 = 4""",
    ["expr"],
)
def index_sum_rewrite(spark, d):
    spread = expressions(spark, d).select("p_partkey", F.explode(tx.index_sums(F.col("text"))).alias("s"))
    return spread.select("p_partkey", "s.var", F.array_join(F.transform("s.idx", lambda x: x.cast("string")), ",").alias("idx"), "s.dim")


@query(
    "sheet_formulas",
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN
         '(sumoverpft(FATES_GPP_PF, pftlist=[' || array_to_string(range(1, p_size % 4 + 2), ', ') || '], dimname=''fates_levpft'') - sumoverpft(PCT_LANDUNIT, pftlist=['
         || p_size || '], dimname=''ltype'') + sumoverpft(NPP, pftlist=[1, 2], dimname=''lev''))*FATES_FRAC' ELSE text END AS formula,
       CASE p_partkey % 6 WHEN 4 THEN 'FATES_GPP_PF,PCT_LANDUNIT,NPP,FATES_FRAC' WHEN 3 THEN 'A,B' || p_size END AS several FROM expr""",
    ["expr"],
)
def sheet_formulas(spark, d):
    """Formulas of a sheet as the catalog stores them: index sums written as helper calls, FATES amounts with their fraction."""
    blank = {c: F.lit("") for c in ("formula", "dims", "units", "freq", "alias", "levels_name", "levels_units", "levels_axis", "levels_bounds")}
    out = ct.sheet_to_catalog(expressions(spark, d).withColumnRenamed("text", "source_expr").withColumns(blank))
    several = F.when((F.col("p_partkey") % 6).isin(3, 4), F.array_join(F.transform("sources", lambda s: s["model_var"]), ","))
    return out.select("p_partkey", "formula", several.alias("several"))


@query(
    "positional_split",
    "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN split_part(p_name, ' ', 1) WHEN 2 THEN replace(p_name, ' ', '|') ELSE replace(p_name, ' ', '|') || '|' END AS parts FROM part",
)
def positional_split(spark, d):
    cell = F.regexp_replace("p_name", " ", " , ")
    return read(spark, d, "part").select("p_partkey", F.array_join(tx.positional_split(cell, F.col("p_size") % 4), "|").alias("parts"))


DIMS = """CASE p_partkey % 4 WHEN 0 THEN 'longitude, latitude, plev' || p_size || ', time' WHEN 1 THEN '["time", "pft", "lat"]' WHEN 2 THEN 'time, alevel, latitude' ELSE 'time,x' || p_size END"""


@query(
    "dims_parse",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'time|plev|lat|lon' WHEN 1 THEN 'time|vegtype|lat' WHEN 2 THEN 'time|lev|lat' ELSE 'time|x' || p_size END AS dims FROM part""",
)
def dims_parse(spark, d):
    text = read(spark, d, "part").select("p_partkey", F.expr(DIMS).alias("text"))
    return text.select("p_partkey", F.array_join(tx.parse_dimensions(F.col("text"), rename_dimensions=True), "|").alias("dims"))


@query(
    "infer_levels",
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'own' WHEN p_partkey % 4 = 0 THEN 'plev' || p_size WHEN p_partkey % 4 = 2 THEN 'standard_hybrid_sigma' END AS name,
       CASE WHEN p_size % 5 = 0 THEN 'm' WHEN p_partkey % 4 = 0 THEN 'Pa' WHEN p_partkey % 4 = 2 THEN '1' END AS units,
       CASE WHEN p_size % 5 <> 0 AND p_partkey % 4 = 2 THEN 'ilev' END AS bounds FROM part""",
)
def infer_levels(spark, d):
    given = F.when(F.col("p_size") % 5 == 0, "own").otherwise("")
    part = read(spark, d, "part").select("p_partkey", "p_size", F.expr(DIMS).alias("text"))
    level = tx.infer_levels(ct.raw_dimensions(F.col("text"), True), given, F.lit("m"))
    return part.withColumn("l", level).select("p_partkey", "l.name", "l.units", F.col("l.src_axis_bnds").alias("bounds"))


@query(
    "sheet_to_catalog",
    """SELECT name, CASE k WHEN 0 THEN 'A' || s || '::day,B::' WHEN 1 THEN 'A' || s || ':x:,B:y:' ELSE 'FATES_NPP_PF::,FATES_FRAC::' END AS sources,
       CASE k WHEN 1 THEN 'A' || s || ' - B' WHEN 2 THEN '(FATES_NPP_PF * ' || s || ')*FATES_FRAC' END AS formula, 'time,plev,lat,lon' AS dims, 'plev19' AS level FROM
       (SELECT 'n' || p_partkey AS name, p_partkey % 3 AS k, p_size AS s FROM part)""",
)
def sheet_to_catalog(spark, d):
    part = read(spark, d, "part").select(
        F.concat(F.lit("n"), "p_partkey").alias("name"),
        F.expr("CASE p_partkey % 3 WHEN 0 THEN 'A' || p_size || ', B' WHEN 1 THEN 'A' || p_size || ' - B' ELSE 'FATES_NPP_PF * ' || p_size END").alias("source_expr"),
        F.expr("CASE p_partkey % 3 WHEN 0 THEN 'day, ' END").alias("freq"),
        F.expr("CASE p_partkey % 3 WHEN 1 THEN 'x, y' END").alias("alias"),
        F.lit("time, plev19, lat, lon").alias("dims"),
        F.lit("K").alias("units"),
    )
    out = ct.sheet_to_catalog(part)
    text = F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["model_var"], F.coalesce(s["alias"], F.lit("")), F.coalesce(s["freq"], F.lit("")))), ",")
    return out.select("name", text.alias("sources"), "formula", F.array_join(F.col("dims")[0], ",").alias("dims"), F.col("levels.name").alias("level"))


@query(
    "catalog_to_rows",
    """SELECT v.name, v.variant, CASE WHEN e.p_partkey % 10 = 0 AND v.variant = 1 THEN '' ELSE coalesce(v.formula, '') END AS formula,
       CASE WHEN e.p_partkey % 10 = 0 THEN v.region ELSE '' END AS region, v.long_name, s.vars AS source_expr, s.freq, s.alias, coalesce(e.level, '') AS levels_name,
       CASE e.p_partkey % 7 WHEN 0 THEN '[["time","latitude","longitude"],["time","lat","lon"]]' WHEN 1 THEN '["time"]' ELSE '["time","lat","lon"]' END AS dims
       FROM variant v JOIN entry e USING (name) JOIN (
         SELECT name, string_agg(model_var, ', ' ORDER BY j) AS vars, CASE WHEN count(freq) > 0 THEN string_agg(coalesce(freq, ''), ', ' ORDER BY j) ELSE '' END AS freq,
                CASE WHEN count(alias) > 0 THEN string_agg(coalesce(alias, ''), ', ' ORDER BY j) ELSE '' END AS alias FROM source GROUP BY 1) s USING (name)""",
    ["variant", "entry", "source"],
)
def catalog_to_rows(spark, d):
    out = ct.catalog_to_rows(catalog(spark, d))
    return out.select("name", "variant", "formula", "region", "long_name", "source_expr", "freq", "alias", "levels_name", "dims")


@query(
    "flatten_tables",
    """SELECT 'n' || (p_partkey % 700) AS name, arg_max('t' || lpad(p_partkey::VARCHAR, 9, '0'), p_partkey) AS table_id, arg_max(p_brand, p_partkey) AS long_name,
       'time|lat' AS dims, arg_max(split_part(p_name, ' ', 1), p_partkey) AS "table" FROM part GROUP BY 1""",
)
def flatten(spark, d):
    text = F.concat(
        F.lit('{"Header": {}, "variable_entry": {"n'), F.col("p_partkey") % 700, F.lit('": {"long_name": "'), "p_brand", F.lit('", "modeling_realm": "'), "p_name",
        F.lit('", "dimensions": '), F.when(F.col("p_partkey") % 2 == 0, '["time", "lat"]').otherwise('"time lat"'), F.lit("}}}"),
    )
    path = F.concat(F.lit("/tables/CMIP7_t"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(".json"))
    out = flatten_tables(read(spark, d, "part").select(path.alias("path"), text.alias("value")))
    return out.select("name", "table_id", "long_name", F.array_join("dims", "|").alias("dims"), "table")


@query(
    "positive_direction",
    "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'down' ELSE p_type END AS positive FROM part",
)
def positive(spark, d):
    name = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'hfls_tavg-u-hxy-u' WHEN 1 THEN 'nbp_tavg-u-hxy-lnd' ELSE p_name END")
    return read(spark, d, "part").select("p_partkey", tx.positive_direction(name, F.col("p_type")).alias("positive"))
