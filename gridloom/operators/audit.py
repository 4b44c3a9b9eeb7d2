"""Audits: what was requested, mapped, logged and produced."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions import text as tx
from gridloom.functions.sizing import small

PATH_FACETS = (
    "activity", "consortium", "model", "experiment", "member", "region", "frequency", "variable", "branding", "grid",
)


def expected_variables(catalog: DataFrame, request: DataFrame | None = None, selected: DataFrame | None = None) -> DataFrame:
    """Catalog names that are also requested and selected, as far as these are given."""
    names = catalog.select("name").distinct()
    for other in (request, selected):
        names = names if other is None else names.join(other.select("name").distinct(), "name", "left_semi")
    return names


def missing_variables(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Expected names that were not produced, sorted."""
    return expected.select("name").distinct().join(produced.select("name").distinct(), "name", "left_anti").orderBy("name")


def produced_inventory(
    paths: DataFrame,
    institution: str | None = None,
    member: str | None = None,
    expected: DataFrame | None = None,
    depth: int = 11,
    facets: Sequence[str] = PATH_FACETS,
) -> DataFrame:
    """Facets of every output path (relative to the root), and ``name`` as variable and branding.

    Paths with fewer parts, another institution or member, or an unexpected name are left out. All regions count.
    """
    parts = F.split("path", "/")
    deep = paths.filter(F.size(parts) >= depth)
    named = deep.withColumns({f: parts[i] for i, f in enumerate(facets)})
    if institution is not None:
        named = named.filter(F.col("consortium") == institution)
    if member is not None:
        named = named.filter(F.col("member") == member)
    named = named.withColumn("name", F.concat_ws("_", "variable", "branding"))
    return named if expected is None else named.join(small(expected.select("name").distinct()), "name", "left_semi")


def dimension_inventory(inventory: DataFrame, samples: int | None = None) -> DataFrame:
    """Per variable the sorted distinct dims, brandings, grids and data variables, the sizes by path and the first path.

    Distinct texts per variable are few (grids, dimension sets). With ``samples`` only the sizes of so many paths are
    listed, cut per task before the shuffle; otherwise all.
    """
    sets = inventory.groupBy("variable").agg(
        F.array_sort(F.collect_set("dims")).alias("dims"),
        F.array_sort(F.collect_set("branding")).alias("brandings"),
        F.array_sort(F.collect_set("grid")).alias("grids"),
        F.array_sort(F.collect_set("data_var")).alias("data_vars"),
        F.min("path").alias("sample_path"),
    )
    listed = inventory.select("variable", "path", "sizes")
    first = listed if samples is None else top_per_group(listed, ["variable"], ["path"], samples)
    sizes = first.groupBy("variable").agg(F.array_sort(F.collect_list(F.struct("path", "sizes"))).alias("_s"))
    return sets.join(sizes.select("variable", F.transform("_s", lambda s: s["sizes"]).alias("sample_sizes")), "variable")


def dimension_sizes(inventory: DataFrame) -> DataFrame:
    """The sizes of every opened path as rows, however many a variable has: variable, path, dims, sizes."""
    return inventory.select("variable", "path", "dims", "sizes")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of each group. Every task keeps at most n rows per group before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of the whole table; each task sends at most n rows."""
    return df.orderBy(*order).limit(n)


def split_lines(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no, line) from whole texts."""
    return texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _named_lines(lines: DataFrame, expected: DataFrame | None) -> DataFrame:
    """Lines of files with a log name, with their ``variable``."""
    named = lines.withColumn("variable", tx.log_variable(F.col("file"))).filter(F.col("variable").isNotNull())
    return named if expected is None else named.join(small(expected.select(F.col("name").alias("variable")).distinct()), "variable", "left_semi")


def _error_line() -> Column:
    return F.col("line").rlike(fixed.LOG_ERROR_PATTERN)


def log_rollup(lines: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Per log file and variable: any error, any success word and the number of error lines, from one pass.

    ``lines`` has ``file, line_no, line``. Only files with a log name count. The lines: :func:`log_errors`.
    """
    return _named_lines(lines, expected).groupBy("variable", "file").agg(
        F.bool_or(_error_line()).alias("has_error"),
        F.bool_or(F.col("line").rlike(fixed.LOG_SUCCESS_PATTERN)).alias("has_success"),
        F.sum(_error_line().cast("long")).alias("error_count"),
    )


def log_errors(lines: DataFrame, expected: DataFrame | None = None, first: int | None = None) -> DataFrame:
    """All error lines (variable, file, line_no, line) as rows, so a file may have any number; or the ``first`` of each."""
    errors = _named_lines(lines, expected).filter(_error_line())
    chosen = errors if first is None else top_per_group(errors, ["variable", "file"], ["line_no"], first)
    return chosen.select("variable", "file", "line_no", F.btrim("line", F.lit(" \t\r\n\f\v")).alias("line"))


def audit_counts(
    expected: DataFrame, produced: DataFrame, logs: DataFrame, inspection_errors: DataFrame
) -> DataFrame:
    """One row of counts: expected, produced, with log errors, missing, inspection errors. Each input is read once."""
    flags = ("_expected", "_produced", "_logged", "_broken")

    def tagged(names: DataFrame, kind: str) -> DataFrame:
        return names.select("name", *[F.lit(int(f == kind)).cast("long").alias(f) for f in flags])

    sources = (expected, produced, logs.filter("has_error").select(F.col("variable").alias("name")), inspection_errors)
    rows = reduce(DataFrame.unionByName, [tagged(df, f) for df, f in zip(sources, flags, strict=True)])
    # One grouping by name; inspection errors count as often as they come.
    by_name = rows.groupBy("name").agg(*[F.max(f).alias(f) for f in flags[:3]], F.sum("_broken").alias("_broken"))
    absent = F.col("name").isNull() | (F.col("_produced") == 0)
    counted = {
        "expected_variables": F.col("_expected"),
        "produced_variables": F.col("_produced"),
        "variables_with_log_errors": F.col("_logged"),
        "missing_variables": F.when(absent, F.col("_expected")),
        "inspection_errors": F.col("_broken"),
    }
    return by_name.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in counted.items()])


def unmapped_from_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """Names reported as unmapped (``no_mapping``) or without input (``no_input``), one row per report."""
    find = lambda pattern: F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))
    reports = F.array(
        F.struct(F.lit("no_mapping").alias("kind"), find(fixed.NO_MAPPING_PATTERN).alias("name")),
        F.struct(
            F.lit("no_input").alias("kind"),
            F.coalesce(find(fixed.NO_INPUT_PATTERN), find(fixed.NO_INPUT_PATTERN_NEW)).alias("name"),
        ),
    )
    found = F.filter(reports, lambda r: r["name"].isNotNull())
    return lines.withColumn("_r", F.explode(found)).select("*", "_r.kind", "_r.name").drop("_r")


def run_status(results: DataFrame) -> DataFrame:
    """Distinct (name, status) of a run."""
    return results.select("name", "status").distinct()


def spatial_mean_series(field: DataFrame, keys: Sequence[str] = ("var", "time_idx")) -> DataFrame:
    """Unweighted mean over every dimension but time, missing skipped."""
    return field.groupBy(*keys).agg(F.avg("value").alias("value"))


def time_mean_map(
    field: DataFrame, extra: Sequence[str] = ("lev",), spatial: Sequence[str] = ("cell",), first: int = 0, keys: Sequence[str] = ("var",)
) -> DataFrame:
    """Mean over time at the first position of every extra dimension, for fields with exactly two spatial dims.

    A ``cell`` column stands for both of them.
    """
    if not (list(spatial) == ["cell"] or len(spatial) == 2):
        raise ValueError(f"a map needs two spatial dimensions, not {list(spatial)}")
    at_first = field
    for dim in extra:
        at_first = at_first.filter(F.col(dim) == first)
    return at_first.groupBy(*keys, *spatial).agg(F.avg("value").alias("value"))
