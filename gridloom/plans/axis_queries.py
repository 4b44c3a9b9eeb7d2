"""Axis bounds, rolling, monotone order, sigma levels, corner bounds, index axes, time encoding."""

from pyspark.sql import functions as F

from gridloom.functions.calendar import cf_date, cf_time, encode_time, noleap_year_fraction
from gridloom.operators import axes as ax
from gridloom.plans.bindings import axes, read
from gridloom.plans.registry import query, view

view("lat_axis", "SELECT axis_id, i, i * 3.5e0 - 88e0 + s % 3 AS v FROM axes", ("axes",))
view("lon_axis", "SELECT axis_id, i, (i * 7.5e0 + 200 + s % 3) % 360 AS v FROM axes", ("axes",))
view("plev_axis", "SELECT axis_id, i, 2000e0 - i * 43 + s % 3 AS v FROM axes", ("axes",))
view(
    "rough_axis",
    "SELECT axis_id, i, CASE WHEN s % 11 <> 0 THEN (i // 3) * 0.5e0 - CASE WHEN s % 7 = 0 THEN 2 ELSE 0 END END AS v FROM axes",
    ("axes",),
)


def axis(spark, d, value):
    return axes(spark, d).select("axis_id", "i", value.alias("v"))


def lat_axis(spark, d):
    return axis(spark, d, F.col("i") * 3.5 - 88.0 + F.col("s") % 3)


def lon_axis(spark, d):
    return axis(spark, d, (F.col("i") * 7.5 + 200 + F.col("s") % 3) % 360)


def rough_axis(spark, d):
    dip = F.when(F.col("s") % 7 == 0, 2).otherwise(0)
    return axis(spark, d, F.when(F.col("s") % 11 != 0, F.floor(F.col("i") / 3) * 0.5 - dip))


def bounds_sql(table: str, lower: str, upper: str) -> str:
    return f"""SELECT axis_id, i, v, {lower} AS b0, {upper} AS b1 FROM (
       SELECT axis_id, i, v, coalesce((v + lag(v) OVER w) * 0.5e0, v - (lead(v) OVER w - v) * 0.5e0, v - 0.5e0) AS lo,
              coalesce((lead(v) OVER w + v) * 0.5e0, v + (v - lag(v) OVER w) * 0.5e0, v + 0.5e0) AS hi, lead(i) OVER w IS NULL AS last
       FROM {table} WINDOW w AS (PARTITION BY axis_id ORDER BY i))"""


@query("bounds_lat", bounds_sql("lat_axis", "greatest(lo, -90e0)", "least(hi, 90e0)"), ["lat_axis"])
def bounds_lat(spark, d):
    return ax.bounds_from_centers(lat_axis(spark, d), "lat")


LON_BOUNDS = bounds_sql("lon_axis", "round(lo, 8)", "round(CASE WHEN last AND hi < lo THEN 360e0 ELSE hi END, 8)")


@query("bounds_lon", LON_BOUNDS, ["lon_axis"])
def bounds_lon(spark, d):
    return ax.bounds_from_centers(lon_axis(spark, d), "lon")


@query("bounds_plev", bounds_sql("plev_axis", "lo", "CASE WHEN last AND hi < 0 THEN 50e0 ELSE hi END"), ["plev_axis"])
def bounds_plev(spark, d):
    return ax.bounds_from_centers(axis(spark, d, F.lit(2000.0) - F.col("i") * 43 + F.col("s") % 3), "plev")


view("lon_bounds", LON_BOUNDS, ("lon_axis",))
view(
    "rolled",
    """SELECT axis_id, (i - shift + n) % n AS i, v, b0, b1, shift FROM lon_bounds JOIN (
       SELECT axis_id, count(*) AS n, coalesce(min(CASE WHEN v < before THEN i END), 0) AS shift FROM
       (SELECT *, lag(v) OVER (PARTITION BY axis_id ORDER BY i) AS before FROM lon_axis) GROUP BY 1) USING (axis_id)""",
    ("lon_bounds", "lon_axis"),
)


@query("roll_lon", "SELECT axis_id, i, v, b0, b1, shift FROM rolled", ["rolled"])
def roll_lon(spark, d):
    bounds = bounds_lon(spark, d)
    return ax.roll_to_monotonic(bounds, ax.roll_shift(lon_axis(spark, d)))


@query(
    "dateline_fix",
    """SELECT axis_id, i, v, shift, CASE WHEN i = 0 AND open AND n > 1 THEN 0e0 ELSE b0 END AS b0,
       CASE WHEN i = 0 AND n > 1 THEN next WHEN i = n - 1 AND open AND n > 1 THEN 360e0 ELSE b1 END AS b1 FROM (
       SELECT *, lead(b0) OVER w AS next, first_value(b0) OVER w > 0 AS open, count(*) OVER (PARTITION BY axis_id) AS n
       FROM rolled WINDOW w AS (PARTITION BY axis_id ORDER BY i))""",
    ["rolled"],
)
def dateline_fix(spark, d):
    return ax.dateline_fix(roll_lon(spark, d))


def monotone_sql(table: str, sign: int) -> str:
    step = "1e-12"
    return f"""SELECT axis_id, i, CASE WHEN v IS NOT NULL AND t <= lim - {step} * 0.5e0 THEN (lim + i * {step}) * {sign}e0 ELSE v END AS v FROM (
       SELECT *, max(t) OVER (PARTITION BY axis_id, seg ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lim FROM (
       SELECT axis_id, i, v, v * {sign}e0 - i * {step} AS t, sum((v IS NULL)::INTEGER) OVER (PARTITION BY axis_id ORDER BY i) AS seg FROM {table}))"""


@query("monotone_axis", monotone_sql("rough_axis", 1), ["rough_axis"])
def monotone_axis(spark, d):
    return ax.make_strictly_monotonic(rough_axis(spark, d))


@query("monotone_axis_decreasing", monotone_sql("rough_axis", -1), ["rough_axis"])
def monotone_axis_decreasing(spark, d):
    return ax.make_strictly_monotonic(rough_axis(spark, d), "decreasing")


@query(
    "is_monotone",
    """SELECT axis_id, bool_and(first OR coalesce(v > before, false)) OR bool_and(first OR coalesce(v < before, false)) AS monotonic FROM (
       SELECT axis_id, i = 0 AS first, v, lag(v) OVER (PARTITION BY axis_id ORDER BY i) AS before FROM
       (SELECT axis_id, i, CASE WHEN axis_id % 3 = 0 THEN i - CASE WHEN s = 50 THEN 1 ELSE 0 END WHEN axis_id % 3 = 1 THEN -i ELSE s END AS v FROM axes)) GROUP BY 1""",
    ["axes"],
)
def is_monotone(spark, d):
    a = F.col("axis_id")
    dent = F.when(F.col("s") == 50, 1).otherwise(0)
    value = F.when(a % 3 == 0, F.col("i") - dent).when(a % 3 == 1, -F.col("i")).otherwise(F.col("s"))
    return ax.is_strictly_monotonic(axis(spark, d, value))


view("edges", "SELECT DISTINCT axis_id, k FROM (SELECT axis_id, i AS k FROM axes UNION ALL SELECT axis_id, i + 1 FROM axes)", ("axes",))


def edges(spark, d):
    return axes(spark, d).select("axis_id", F.explode(F.array(F.col("i"), F.col("i") + 1)).alias("k")).distinct()


@query(
    "interface_bounds",
    "SELECT * FROM (SELECT axis_id, k, k * 2.5e0 AS b0, lead(k * 2.5e0) OVER (PARTITION BY axis_id ORDER BY k) AS b1 FROM edges) WHERE b1 IS NOT NULL",
    ["edges"],
)
def interface_bounds(spark, d):
    return ax.interface_bounds(edges(spark, d).withColumn("z", F.col("k") * 2.5))


@query(
    "sigma_axis",
    """SELECT axis_id, k, sigma, b0, b1, true AS valid FROM (
       SELECT axis_id, i AS k, (i + 0.5e0) / 64e0 AS sigma,
         CASE axis_id % 3 WHEN 2 THEN CASE WHEN i = 0 THEN 0e0 ELSE ((i - 1 + 0.5e0) / 64e0 + (i + 0.5e0) / 64e0) * 0.5e0 END ELSE i / 64e0 END AS b0,
         CASE axis_id % 3 WHEN 2 THEN CASE WHEN i = n - 1 THEN 1e0 ELSE ((i + 0.5e0) / 64e0 + (i + 1 + 0.5e0) / 64e0) * 0.5e0 END ELSE (i + 1) / 64e0 END AS b1
       FROM (SELECT *, count(*) OVER (PARTITION BY axis_id) AS n FROM axes))""",
    ["axes"],
)
def sigma_axis(spark, d):
    a = F.col("axis_id")
    sigma = (F.col("i") + 0.5) / 64.0
    mid = axes(spark, d).select("axis_id", F.col("i").alias("k"), F.when(a % 4 != 3, sigma).alias("hybm"), sigma.alias("lev"))
    edge = F.col("k") / F.lit(64.0)
    faces = edges(spark, d).select(
        "axis_id", "k", F.when(a % 3 == 0, edge).alias("hybi"), F.when(a % 3 == 1, edge).otherwise(F.col("k") * 10.0).alias("ilev")
    )
    return ax.sigma_axis(mid, faces, check="flag")


view(
    "corners",
    "SELECT p_partkey // 400 AS axis_id, p_partkey % 400 // 20 AS j, p_partkey % 20 AS i, CASE WHEN p_size % 9 <> 0 THEN p_retailprice END AS v FROM part",
)


def corners(spark, d):
    k = F.col("p_partkey")
    return read(spark, d, "part").select(
        F.floor(k / 400).alias("axis_id"), F.floor(k % 400 / 20).alias("j"), (k % 20).alias("i"), F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice")).alias("v")
    )


@query(
    "corner_bounds",
    """SELECT a.axis_id, a.j, a.i, least(a.v, b.v, c.v, e.v) AS b0, greatest(a.v, b.v, c.v, e.v) AS b1 FROM corners a
       JOIN corners b ON b.axis_id = a.axis_id AND b.j = a.j AND b.i = a.i + 1
       JOIN corners c ON c.axis_id = a.axis_id AND c.j = a.j + 1 AND c.i = a.i
       JOIN corners e ON e.axis_id = a.axis_id AND e.j = a.j + 1 AND e.i = a.i + 1""",
    ["corners"],
)
def corner_bounds(spark, d):
    return ax.corner_bounds(corners(spark, d))


@query(
    "supergrid_split",
    """SELECT axis_id, kind, j // 2 AS j, i // 2 AS i, (v + 300e0) % 360 AS lon FROM (
       SELECT *, CASE WHEN j % 2 = 1 AND i % 2 = 1 THEN 'center' WHEN j % 2 = 0 AND i % 2 = 0 THEN 'corner' END AS kind FROM corners) WHERE kind IS NOT NULL""",
    ["corners"],
)
def supergrid_split(spark, d):
    grid = corners(spark, d).select("axis_id", "j", "i", (F.col("v") + 300.0).alias("lon"))
    return ax.supergrid_split(grid)


INDEX_SQL = """SELECT axis_id, ts, row_number() OVER (PARTITION BY axis_id ORDER BY ts) - 1 AS i FROM
               (SELECT DISTINCT event_type AS axis_id, ts FROM events)"""


@query("index_axis", "SELECT axis_id, s, row_number() OVER (PARTITION BY axis_id ORDER BY s) - 1 AS i FROM (SELECT DISTINCT axis_id, s FROM axes)", ["axes"])
def index_axis(spark, d):
    return ax.index_axis(axes(spark, d), "s")


@query("index_axis_long", INDEX_SQL)
def index_axis_long(spark, d):
    points = read(spark, d, "events").select(F.col("event_type").alias("axis_id"), "ts")
    return ax.index_axis(points, "ts", bucket=F.substring(F.col("ts").cast("string"), 1, 16))  # by the minute


@query("index_axis_sampled", INDEX_SQL)
def index_axis_sampled(spark, d):
    """The same numbers with bounds that are sampled: a bucket has about 1,000 points."""
    points = read(spark, d, "events").select(F.col("event_type").alias("axis_id"), "ts")
    return ax.index_axis(points, "ts", size=1_000)


SECONDS = "(hour(ts) * 3600 + minute(ts) * 60)::BIGINT * 1000000 + microsecond(ts)"
CUMULATIVE = "[0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334]"


@query(
    "cf_time_noleap",
    f"""SELECT event_id, CASE WHEN NOT (month(ts) = 2 AND day(ts) = 29) THEN
        (((year(ts) - 1850) * 365 + ({CUMULATIVE})[month(ts)] + day(ts) - 1) * 86400000000 + {SECONDS})::DOUBLE / 86400000000e0 END AS t FROM events""",
)
def cf_time_noleap(spark, d):
    return read(spark, d, "events").select("event_id", cf_time(F.col("ts")).alias("t"))


@query(
    "cf_time_standard",
    f"""SELECT event_id, ((ts::DATE - DATE '2000-01-01') * 86400000000 + {SECONDS})::DOUBLE / 3600000000e0 AS t FROM events""",
)
def cf_time_standard(spark, d):
    events = read(spark, d, "events")
    kind = dict(events.dtypes)["ts"]
    return events.select("event_id", encode_time(kind, F.col("ts"), "hours since 2000-01-01", "standard").alias("t"))


@query(
    "cf_time_360_day",
    """SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 30 THEN
       (((year(o_orderdate) - 1990) * 360 + (month(o_orderdate) - 2) * 30 + day(o_orderdate) - 1) * 86400000000)::DOUBLE / 86400000000e0 END AS t FROM orders""",
)
def cf_time_360(spark, d):
    return read(spark, d, "orders").select("o_orderkey", cf_time(F.col("o_orderdate"), "days since 1990-02-01", "360_day").alias("t"))


@query(
    "cf_date_noleap",
    """SELECT event_id, CASE WHEN NOT (month(ts) = 2 AND day(ts) = 29) THEN year(ts)::INTEGER END AS year, CASE WHEN NOT (month(ts) = 2 AND day(ts) = 29) THEN month(ts)::INTEGER END AS month,
        CASE WHEN NOT (month(ts) = 2 AND day(ts) = 29) THEN day(ts)::INTEGER END AS day, CASE WHEN NOT (month(ts) = 2 AND day(ts) = 29) THEN (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::BIGINT END AS second FROM events""",
)
def cf_date_noleap(spark, d):
    """Dates of numbers in seconds, which a double holds exactly."""
    units = "seconds since 1850-03-01"
    seconds = cf_time(F.date_trunc("second", F.col("ts")).cast("timestamp_ntz"), units)
    found = read(spark, d, "events").select("event_id", cf_date(seconds, units).alias("d"))
    return found.select("event_id", "d.year", "d.month", "d.day", (F.col("d.micros") / 1000000).cast("long").alias("second"))


@query(
    "cf_date_standard",
    """SELECT o_orderkey, year(t)::INTEGER AS year, month(t)::INTEGER AS month, day(t)::INTEGER AS day, (hour(t) * 3600000000)::BIGINT AS micros FROM (
       SELECT o_orderkey, TIMESTAMP '1900-02-28 00:00:00' + to_hours(((o_orderkey * 6151) % 2000000)::INTEGER) AS t FROM orders)""",
)
def cf_date_standard(spark, d):
    hours = ((F.col("o_orderkey") * 6151) % 2000000).cast("double")
    found = read(spark, d, "orders").select("o_orderkey", cf_date(hours, "hours since 1900-02-28", "standard").alias("d"))
    return found.select("o_orderkey", "d.year", "d.month", "d.day", "d.micros")


@query(
    "cf_date_360_day",
    """SELECT o_orderkey, (1990 + n // 360)::INTEGER AS year, (n % 360 // 30 + 1)::INTEGER AS month, (n % 30 + 1)::INTEGER AS day FROM (
       SELECT o_orderkey, (o_orderkey * 7919) % 300000 + 30 AS n FROM orders)""",
)
def cf_date_360(spark, d):
    found = read(spark, d, "orders").select("o_orderkey", cf_date(((F.col("o_orderkey") * 7919) % 300000).cast("double"), "days since 1990-02-01", "360_day").alias("d"))
    return found.select("o_orderkey", "d.year", "d.month", "d.day")


@query(
    "noleap_year_fraction",
    f"SELECT o_orderkey, (year(o_orderdate) * 365 + ({CUMULATIVE})[month(o_orderdate)] + day(o_orderdate))::DOUBLE / 365e0 AS y FROM orders",
)
def year_fraction(spark, d):
    return read(spark, d, "orders").select("o_orderkey", noleap_year_fraction(F.col("o_orderdate")).alias("y"))
