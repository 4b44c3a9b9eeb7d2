"""Audits of logs, output paths and produced variables; means for inspection."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import text as tx
from gridloom.operators import audit as au
from gridloom.plans import chains
from gridloom.plans.bindings import field, read
from gridloom.plans.catalog_queries import catalog, request
from gridloom.plans.registry import query, view
from gridloom.sources.sinks import flat_table


@query("spatial_mean_series", "SELECT var, time_idx, sum(value) / nullif(count(value), 0) AS value FROM field GROUP BY 1, 2", ["field"])
def spatial_mean_series(spark, d):
    return au.spatial_mean_series(field(spark, d))


@query("time_mean_map", "SELECT var, cell, sum(value) / nullif(count(value), 0) AS value FROM field WHERE lev = 1 GROUP BY 1, 2", ["field"])
def time_mean_map(spark, d):
    return au.time_mean_map(field(spark, d), first=1)


PATH = """'CMIP/' || CASE WHEN o_orderkey % 9 = 0 THEN 'OTHER' ELSE 'INST' END || '/M3/' || o_orderstatus || '/r' || (o_orderkey % 3) || 'i1p1f1/'
  || CASE WHEN o_orderkey % 4 = 0 THEN 'nh' ELSE 'glb' END || '/mon/v' || (o_custkey % 300) || '/tavg-u-hxy-u/' || CASE WHEN o_orderkey % 5 = 0 THEN 'gn' ELSE 'gr' END
  || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '/file' || o_orderkey || '.nc' END"""
view(
    "inventory",
    f"""SELECT split_part(path, '/', 8) AS variable, split_part(path, '/', 8) || '_tavg-u-hxy-u' AS name, split_part(path, '/', 5) AS member,
        split_part(path, '/', 6) AS region, split_part(path, '/', 10) AS grid, path, o_orderkey FROM (SELECT {PATH} AS path, o_orderkey FROM orders)
        WHERE o_orderkey % 11 <> 0 AND o_orderkey % 9 <> 0""",
)


def inventory(spark, d):
    paths = read(spark, d, "orders").select(F.expr(PATH).alias("path"), "o_orderkey")
    return au.produced_inventory(paths, institution="INST")


@query("produced_inventory", "SELECT variable, name, member, region, grid, path FROM inventory WHERE member = 'r1i1p1f1' AND name IN (SELECT 'v' || p_partkey || '_tavg-u-hxy-u' FROM part WHERE p_partkey % 3 = 0)", ["inventory"])
def produced_inventory(spark, d):
    paths = read(spark, d, "orders").select(F.expr(PATH).alias("path"))
    expected = catalog(spark, d).filter("p_partkey % 3 = 0").select("name")
    found = au.produced_inventory(paths, institution="INST", member="r1i1p1f1", expected=expected)
    return found.select("variable", "name", "member", "region", "grid", "path")


@query(
    "dimension_inventory",
    """SELECT variable, string_agg(DISTINCT dims, ';' ORDER BY dims) AS dims, string_agg(DISTINCT grid, ',' ORDER BY grid) AS grids, min(path) AS sample_path,
       string_agg(DISTINCT branding, ',' ORDER BY branding) AS brandings, string_agg(DISTINCT data_var, ',' ORDER BY data_var) AS data_vars,
       string_agg(sizes, ';' ORDER BY path) AS sample_sizes FROM (
       SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'time, lat, lon' ELSE 'time, plev, lat' END AS dims, 'n' || o_orderkey AS sizes,
              'tavg-u-hxy-u' AS branding, variable || CASE WHEN o_orderkey % 3 = 0 THEN '_bnds' ELSE '' END AS data_var FROM inventory) GROUP BY 1""",
    ["inventory"],
)
def dimension_inventory(spark, d):
    even = F.col("o_orderkey") % 2 == 0
    opened = inventory(spark, d).withColumns(
        {"dims": F.when(even, "time, lat, lon").otherwise("time, plev, lat"), "data_var": F.concat("variable", F.when(F.col("o_orderkey") % 3 == 0, "_bnds").otherwise("")), "sizes": F.concat(F.lit("n"), "o_orderkey")}
    )
    out = au.dimension_inventory(opened)
    return out.select(
        "variable", F.array_join("dims", ";").alias("dims"), F.array_join("grids", ",").alias("grids"), "sample_path",
        F.array_join("brandings", ",").alias("brandings"), F.array_join("data_vars", ",").alias("data_vars"), F.array_join("sample_sizes", ";").alias("sample_sizes")
    )


@query("dimension_sizes", "SELECT variable, path, 'time, lat' AS dims, 'n' || o_orderkey AS sizes FROM inventory", ["inventory"])
def dimension_sizes(spark, d):
    opened = inventory(spark, d).withColumns({"dims": F.lit("time, lat"), "sizes": F.concat(F.lit("n"), "o_orderkey")})
    return au.dimension_sizes(opened)


# One log file per document source, so a few files hold nearly all lines.
LOG_FILE = "CASE WHEN lang = 'de' THEN 'notes.txt' ELSE 'cmor_20240101T000000Z_' || source || '.log' END"
LOG_LINE = "CASE WHEN (doc_id + n) % 4 = 0 THEN 'ERROR: ' || line WHEN (doc_id + n) % 50 = 1 THEN line || ' completed' ELSE line END"
view(
    "log_line",
    f"""SELECT file, doc_id * 1000000 + n AS line_no, {LOG_LINE} AS line FROM (
        SELECT doc_id, {LOG_FILE} AS file, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents)""",
)
view(
    "log_summary",
    r"""SELECT file[23:-5] AS variable, file, bool_or(is_error) AS has_error, bool_or(regexp_matches(line, '(?i)\b(success|completed?|finished)\b')) AS has_success,
        sum(is_error::INTEGER)::BIGINT AS error_count FROM (
        SELECT *, regexp_matches(line, '(?i)Error: ') AS is_error FROM log_line WHERE file LIKE 'cmor%') GROUP BY 1, 2""",
    ("log_line",),
)


def log_lines(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.expr(LOG_FILE).alias("file"), "text")
    lines = docs.select("doc_id", "file", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return lines.select("file", (F.col("doc_id") * 1000000 + F.col("n")).alias("line_no"), F.expr(LOG_LINE).alias("line"))


@query("log_rollup", "SELECT * FROM log_summary", ["log_summary"])
def log_rollup(spark, d):
    return au.log_rollup(log_lines(spark, d))


@query(
    "log_errors",
    """SELECT file[23:-5] AS variable, file, line_no, trim(line, ' ' || chr(9) || chr(13) || chr(10) || chr(12) || chr(11)) AS line
       FROM log_line WHERE file LIKE 'cmor%' AND regexp_matches(line, '(?i)Error: ')""",
    ["log_line"],
)
def log_errors(spark, d):
    return au.log_errors(log_lines(spark, d))


@query("log_variable", "SELECT file, CASE WHEN file LIKE 'cmor%' THEN file[23:-5] END AS variable, count(*) AS lines FROM log_line GROUP BY 1, 2", ["log_line"])
def log_variable(spark, d):
    return log_lines(spark, d).groupBy("file").agg(F.count(F.lit(1)).alias("lines")).withColumn("variable", tx.log_variable(F.col("file")))


@query(
    "report_rows",
    "SELECT variable, '[' || string_agg(DISTINCT '\"' || grid || '\"', ',' ORDER BY '\"' || grid || '\"') || ']' AS grids, min(path) AS sample_path FROM inventory GROUP BY 1",
    ["inventory"],
)
def report_rows(spark, d):
    summary = inventory(spark, d).groupBy("variable").agg(F.array_sort(F.collect_set("grid")).alias("grids"), F.min("path").alias("sample_path"))
    return flat_table(summary)


LINE = """CASE conv_id % 4 WHEN 0 THEN 'WARN No mapping for ' || role || turn || ' in catalog ' || text WHEN 1 THEN 'Variable ' || role || turn || ' processed with status: ERROR m3 input variable not found. ' || text
   WHEN 2 THEN 'Source variable(s) not found for x' || turn || ', skipping ' || text ELSE text END"""
view("line", f"SELECT conv_id, turn, {LINE} AS line FROM conversations")


@query(
    "unmapped_from_log",
    r"""SELECT conv_id, turn, kind, name FROM (
        SELECT conv_id, turn, 'no_mapping' AS kind, regexp_extract(line, 'No mapping for (.+) in ', 1) AS name FROM line
        UNION ALL SELECT conv_id, turn, 'no_input', coalesce(nullif(regexp_extract(line, 'Variable (.*) processed with status: ERROR \w+ input variable not found\.', 1), ''),
                         regexp_extract(line, 'Source variable\(s\) not found for ([^,\s]+)', 1)) FROM line) WHERE name <> ''""",
    ["line"],
)
def unmapped_from_log(spark, d):
    lines = read(spark, d, "conversations").select("conv_id", "turn", F.expr(LINE).alias("line"))
    return au.unmapped_from_log(lines).select("conv_id", "turn", "kind", "name")


EXPECTED = """SELECT 'v' || p_partkey || '_tavg-u-hxy-u' AS name FROM part WHERE p_size <= 40
              INTERSECT SELECT name FROM request INTERSECT SELECT 'v' || s_suppkey || '_tavg-u-hxy-u' FROM supplier"""
view("expected", EXPECTED, ("request",))


def expected(spark, d):
    chosen = read(spark, d, "supplier").select(F.concat(F.lit("v"), "s_suppkey", F.lit("_tavg-u-hxy-u")).alias("name"))
    entries = catalog(spark, d).join(read(spark, d, "part").filter("p_size <= 40").select("p_partkey"), "p_partkey")
    return au.expected_variables(entries, request(spark, d), chosen)


@query("expected_variables", "SELECT name FROM expected", ["expected"])
def expected_variables(spark, d):
    return expected(spark, d)


@query(
    "expected_minus_produced",
    "SELECT DISTINCT l_partkey AS name FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01') ORDER BY name",
)
def expected_minus_produced(spark, d):
    lines = read(spark, d, "lineitem")
    produced = lines.filter(F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    return au.missing_variables(lines.select(F.col("l_partkey").alias("name")), produced.select(F.col("l_partkey").alias("name")))


@query(
    "audit_counts",
    """SELECT (SELECT count(*) FROM expected) AS expected_variables, (SELECT count(DISTINCT name) FROM inventory) AS produced_variables,
       (SELECT count(DISTINCT variable) FROM log_summary WHERE has_error) AS variables_with_log_errors,
       (SELECT count(*) FROM expected WHERE name NOT IN (SELECT name FROM inventory)) AS missing_variables,
       (SELECT count(*) FROM inventory WHERE o_orderkey % 17 = 0) AS inspection_errors""",
    ["expected", "inventory", "log_summary"],
)
def audit_counts(spark, d):
    produced = inventory(spark, d)
    broken = produced.filter("o_orderkey % 17 = 0")
    return au.audit_counts(expected(spark, d), produced, au.log_rollup(log_lines(spark, d)), broken)


REPORT = {
    "expected_variables": "expected",
    "produced_variables": "(SELECT DISTINCT name FROM inventory)",
    "missing_variables": "(SELECT name FROM expected EXCEPT SELECT name FROM inventory)",
    "log_records": "log_summary",
    "log_errors": "(SELECT unnest(range(error_count)) FROM log_summary)",
    "inspection_errors": "(SELECT * FROM inventory WHERE o_orderkey % 17 = 0)",
}


@query("audit_report", " UNION ALL ".join(f"SELECT '{name}' AS report, count(*) AS n FROM {sql}" for name, sql in REPORT.items()), ["expected", "inventory", "log_summary"])
def audit_report(spark, d):
    """Rows in every table of the assembled report."""
    produced = inventory(spark, d)
    chosen = read(spark, d, "supplier").select(F.concat(F.lit("v"), "s_suppkey", F.lit("_tavg-u-hxy-u")).alias("name"))
    entries = catalog(spark, d).join(read(spark, d, "part").filter("p_size <= 40").select("p_partkey"), "p_partkey")
    _, report = chains.audit_report(
        entries, produced, log_lines(spark, d), request=request(spark, d), selected=chosen, inspection_errors=produced.filter("o_orderkey % 17 = 0")
    )
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n") for name, df in report.items()])


@query(
    "run_status",
    "SELECT DISTINCT o_custkey AS name, CASE o_orderstatus WHEN 'O' THEN 'ok' WHEN 'F' THEN 'started' ELSE 'ERROR' END AS status FROM orders",
)
def run_status(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", "ok").when(F.col("o_orderstatus") == "F", "started").otherwise("ERROR")
    return au.run_status(read(spark, d, "orders").select(F.col("o_custkey").alias("name"), status.alias("status")))


@query("top_variables", "SELECT DISTINCT name FROM inventory ORDER BY name LIMIT 36", ["inventory"])
def top_variables(spark, d):
    return au.top_n(inventory(spark, d).select("name").distinct(), ["name"], 36)


@query(
    "top_per_variable",
    "SELECT name, path FROM (SELECT name, path, row_number() OVER (PARTITION BY name ORDER BY path) AS rn FROM inventory) WHERE rn <= 3",
    ["inventory"],
)
def top_per_variable(spark, d):
    return au.top_per_group(inventory(spark, d).select("name", "path"), ["name"], ["path"], 3)


@query("sorted_distinct", "SELECT DISTINCT region, variable FROM inventory ORDER BY 1, 2", ["inventory"])
def sorted_distinct(spark, d):
    return inventory(spark, d).select("region", "variable").distinct().orderBy("region", "variable")
