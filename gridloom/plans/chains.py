"""The other entry points, each as one plan: series from slice files, the audit of a run, and the merged catalog sheet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.calendar import cf_date, step_year
from gridloom.operators import audit as au
from gridloom.operators import catalog as ct
from gridloom.operators import series as sr
from gridloom.sources import blocks, tables


def stream_years(slices: DataFrame, freq: str, units: str | None, calendar: str) -> Column:
    """The year of a slice row: of its time (the start of its interval, where bounds are there), else of its step since year 0."""
    if units is not None and (axis := next((c for c in ("time_b0", "time") if c in slices.columns), None)):
        return cf_date(F.col(axis).cast("double"), units, calendar)["year"]
    return step_year(F.col("time_idx"), freq, calendar)


def stream_series(
    streams: Mapping[tuple[str, str], DataFrame],
    *,
    years: tuple[int, int, int] | None = None,
    units: str | None = None,
    calendar: str = "noleap",
    dims: Sequence[str] = ("time_idx", "lev", "cell"),
) -> DataFrame:
    """Long series of all streams, wide slices by (frequency, stream): dims, var, value, freq, stream and, with ``years`` (first,
    last, step), block.

    Streams stay apart, as they do in files, so a variable that two of them have is kept twice. A dim that a stream lacks is NULL.
    """
    made = None
    for (freq, stream), slices in streams.items():
        keys = [d for d in dims if d in slices.columns]
        variables = [c for c in slices.columns if c not in (*keys, *fixed.TIME_COLUMNS)]
        extra = []
        if years is not None:
            slices, extra = slices.withColumn("_year", stream_years(slices, freq, units, calendar)), ["_year"]
        rows = sr.slices_to_series(slices, [*keys, *extra], variables).withColumns({"freq": F.lit(freq), "stream": F.lit(stream)})
        if years is not None:
            rows = sr.year_blocks(rows, *years, F.col("_year")).drop("_year")
        made = rows if made is None else made.unionByName(rows, allowMissingColumns=True)
    return made


def generate_series(
    spark: SparkSession,
    root: str,
    out: str,
    model: str,
    realm: str,
    *,
    years: tuple[int, int, int] | None = None,
    overwrite: bool = False,
    units: str | None = None,
    calendar: str = "noleap",
    dims: Sequence[str] = ("time_idx", "lev", "cell"),
    patterns: Mapping = fixed.HISTORY_PATTERNS,
) -> list[str]:
    """Slice files of one realm into series by variable, frequency and stream (file-name part); the parts that had files.

    ``years`` (first, last, step) stores blocks of years: those that the manifest lists are kept, and slices are not read for
    them, unless ``overwrite``. Without it whole series are replaced. ``units`` and ``calendar`` date the slices' time; slices
    without one count their steps from year 0. Files are chosen by the reader, so their list does not come to the driver.
    """
    if model not in patterns or realm not in patterns[model]:
        raise ValueError(f"no patterns for model={model}, realm={realm}")
    done, streams = [], {}
    for freq, listed in patterns[model][realm].items():
        for pattern in listed:
            glob = f"*{pattern}*"
            if tables.list_files(spark, root, glob).isEmpty():
                continue
            done.append(pattern)
            options = {"pathGlobFilter": glob, "recursiveFileLookup": "true", "mergeSchema": "true"}
            slices = spark.read.options(**options).parquet(root)
            if years is not None and not overwrite:
                keys = [c for c in slices.columns if c in (*dims, *fixed.TIME_COLUMNS)]
                variables = [c for c in slices.columns if c not in keys]
                wanted = blocks.open_blocks(spark, out, freq, pattern, variables, range(years[0], years[1] + 1, years[2]))
                if not wanted:
                    continue
                slices = slices.select(*keys, *[v for v in variables if any(v == w for w, _ in wanted)])
            streams[freq, pattern] = slices
    if streams:
        series = stream_series(streams, years=years, units=units, calendar=calendar, dims=dims)
        if years is not None and not overwrite:
            series = sr.new_blocks(series, blocks.manifest(spark, out), blocks.KEYS)
            blocks.store(spark, series, out)
        else:
            mine = F.struct("freq", "stream").isin(*[F.struct(F.lit(f), F.lit(p)) for f, p in streams])
            blocks.store(spark, series, out, mine if years is None else mine & F.col("block").between(years[0], years[1]))
    return done


def audit_report(
    catalog: DataFrame,
    produced: DataFrame,
    lines: DataFrame,
    *,
    request: DataFrame | None = None,
    selected: DataFrame | None = None,
    inspected: DataFrame | None = None,
    inspection_errors: DataFrame | None = None,
    samples: int = 3,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Summary row and tables of an audit, ready for :func:`gridloom.sources.sinks.write_report`.

    ``produced`` is an inventory of output paths, ``lines`` the log lines, ``inspected`` the inventory with what opening
    the files showed, ``inspection_errors`` the files that could not be opened (``name``). A variable's row in the dimension
    inventory lists the sizes of ``samples`` paths; those of all paths are rows of their own table.
    """
    expected = au.expected_variables(catalog, request, selected)
    logs = au.log_rollup(lines)
    errors = produced.select("name").limit(0) if inspection_errors is None else inspection_errors
    report = {
        "expected_variables": expected,
        "produced_variables": produced.select("name").distinct(),
        "missing_variables": au.missing_variables(expected, produced),
        "log_records": logs,
        "log_errors": au.log_errors(lines),
        "inspection_errors": errors,
    }
    if inspected is not None:
        report["dimension_inventory"] = au.dimension_inventory(inspected, samples)
        report["dimension_sizes"] = au.dimension_sizes(inspected)
    return au.audit_counts(expected, produced, logs, errors), report


def merged_sheet(catalog: DataFrame, request: DataFrame, definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sheet rows of all catalog entries and of a stub for every requested variable without one; and names no table defines.

    ``definitions`` are flattened tables. Every row has the request's parameter, priority and experiments.
    """
    gap = ct.catalog_gap(request, definitions.select("name", "table"), catalog)
    open_names = gap.filter("kind = 'stub'").select("name")
    text = lambda name: F.col(name) if name in definitions.columns else F.lit(None).cast("string")
    stubs = definitions.join(open_names, "name", "left_semi").select(
        "name",
        "table",
        F.to_json("dims").alias("dims"),
        F.coalesce(ct.stub_levels(F.col("dims")), F.lit("")).alias("levels_name"),
        *[F.coalesce(text(n), F.lit("")).alias(n) for n in ("units", "long_name", "standard_name", "cell_methods", "positive")],
    )
    parameter = request.groupBy("name").agg(F.min("parameter").alias("parameter"))
    meta = ct.request_rollup(request).join(parameter, "name")
    return ct.merge_catalog_rows(ct.catalog_to_rows(catalog), stubs, meta), gap.filter("kind = 'not_in_tables'").select("name")
