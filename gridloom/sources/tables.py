"""Reading field, catalog and table files as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions import text as tx
from gridloom.functions.sizing import small
from gridloom.functions.values import null_if_nan
from gridloom.operators.catalog import CATALOG_SCHEMA


def scan_series(
    spark: SparkSession, paths: Sequence[str], variables: Sequence[str] | None = None, static: Sequence[str] = fixed.STATIC_CARRIED
) -> tuple[DataFrame, DataFrame]:
    """Many series files as one field along time, and the static variables once.

    Files partitioned by ``var=`` are pruned by the variable list before anything is opened. NaN becomes NULL here.
    """
    return split_series(spark.read.parquet(*paths), variables, static)


def split_series(
    every: DataFrame, variables: Sequence[str] | None = None, static: Sequence[str] = fixed.STATIC_CARRIED
) -> tuple[DataFrame, DataFrame]:
    """Series rows of the wanted variables, and each static value once however many files repeat it: the earliest that is not missing."""
    wanted = every if variables is None else every.filter(F.col("var").isin(list(variables)))
    clean = wanted.withColumn("value", null_if_nan(F.col("value").cast("double")))
    moving = clean.filter(~F.col("var").isin(*static))
    fixed_rows = clean.filter(F.col("var").isin(*static)).groupBy("var", "cell").agg(
        F.min_by("value", F.when(F.col("value").isNotNull(), F.struct(*[c for c in ("time_idx", "lev") if c in clean.columns], "value"))).alias("value")
    )
    return moving, fixed_rows


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of the files under a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line_no, line) of text files of any size, numbered from 0 in each file; a newline at the end starts no line.

    The reader splits files by bytes. A line's number is its place in its split after the counted lines of the splits before
    it: one pass counts, one reads, and only the table of splits is joined, so no task holds a file and no line is moved.
    Ids rise by one inside a split, and both passes cut the files alike as they are one relation.
    """
    split = {"_path": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start")}
    found = spark.read.option("lineSep", "\n").text(paths)
    lines = found.select(*[c.alias(n) for n, c in split.items()], F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    counted = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("_path").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.select(*split, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return lines.join(small(splits), list(split)).select(tx.file_name(F.col("_path")).alias("file"), (F.col("_id") + F.col("_shift")).alias("line_no"), "line")


def _catalog_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    def texts(entry: dict, keys: Sequence[str]) -> dict:
        return {k: None if entry.get(k) is None else str(entry[k]) for k in keys}

    columns = ["name", "table", "units", "formula", "positive", "cell_methods", "regrid_method", "long_name", "standard_name", "region"]
    for batch in batches:
        rows = []
        for path, text in zip(batch["path"], batch["value"]):
            document = yaml.safe_load(text)
            if not isinstance(document, dict) or not isinstance(document.get("variables"), dict):
                raise TypeError(f"{path} has no 'variables' mapping")
            for order, (name, entry) in enumerate(document["variables"].items()):
                dims = entry.get("dims") or []
                sources = [s if isinstance(s, dict) else {"model_var": s} for s in entry.get("sources") or []]
                rows.append(
                    texts(entry, columns[1:])
                    | {
                        "name": str(name),
                        "dims": dims if dims and isinstance(dims[0], list) else [dims],
                        "sources": [texts(s, ("model_var", "alias", "freq")) for s in sources],
                        "levels": texts(entry["levels"], ("name", "units", "src_axis_name", "src_axis_bnds")) if entry.get("levels") else None,
                        "variants": [texts(v, ("long_name", "formula", "region")) for v in entry["variants"]] if entry.get("variants") else None,
                        "path": path,
                        "ord": order,
                    }
                )
        yield pd.DataFrame(rows, columns=[*columns, "dims", "sources", "levels", "variants", "path", "ord"])


def read_catalog(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Catalog rows from YAML files with a ``variables`` mapping; each file is parsed where it is read."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return whole.mapInPandas(_catalog_rows, CATALOG_SCHEMA + ", path string, ord int")


ENTRY_SCHEMA = (
    "struct<long_name:string,units:string,dimensions:string,modeling_realm:string,standard_name:string,"
    "cell_methods:string,positive:string>"
)


def flatten_tables(tables: DataFrame, skipped: Sequence[str] = fixed.SKIPPED_TABLES) -> DataFrame:
    """(name, table_id, entry columns) from variable-table JSON texts (``path, value``); the last file of a name wins.

    ``dims`` splits the dimensions, stored as list or as blank-separated text, and ``table`` is the realm's first word.
    """
    table_id = F.regexp_replace(F.regexp_extract(tx.file_name(F.col("path")), r"^(.*)\.json$", 1), "^CMIP7_", "")
    parsed = F.from_json("value", f"struct<variable_entry:map<string,{ENTRY_SCHEMA}>>")
    kept = tables.withColumn("table_id", table_id).filter(~F.col("table_id").isin(*skipped))
    spread = kept.select("path", "table_id", F.explode(parsed["variable_entry"]).alias("name", "entry"))
    last = spread.groupBy("name").agg(F.max_by(F.struct("table_id", "entry"), F.col("path")).alias("_e"))
    flat = last.select("name", "_e.table_id", "_e.entry.*")
    from_list = F.from_json("dimensions", "array<string>")
    words = F.filter(F.split(F.trim("dimensions"), r"[\s,]+"), lambda d: d != "")
    realm = F.split(F.trim(F.coalesce("modeling_realm", F.lit(""))), r"\s+")[0]
    return flat.withColumn("dims", F.coalesce(from_list, words)).withColumn("table", F.coalesce(F.nullif(realm, F.lit("")), "table_id"))


def read_tables(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return flatten_tables(spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def coordinate_file(coordinates: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The text (``value``) of the first known coordinate file by name, of all files or per ``keys`` (a table set)."""
    names = F.array(*[F.lit(n) for n in fixed.COORDINATE_FILES])
    ranked = coordinates.withColumn("_rank", F.array_position(names, tx.file_name(F.col("path")))).filter("_rank > 0")
    return ranked.groupBy(*keys).agg(F.min_by("value", "_rank").alias("value"))


def requested_levels(coordinates: DataFrame, axis: str) -> list[float]:
    """Requested values of an axis from coordinate-table JSON texts (``path, value``).

    Of the known file names the first that is present is used; an axis it does not define is an error.
    """
    chosen = coordinate_file(coordinates)
    parsed = F.from_json("value", "struct<axis_entry:map<string,struct<requested:array<string>>>>")
    row = chosen.filter(F.col("value").isNotNull()).select(F.try_element_at(parsed["axis_entry"], F.lit(axis))["requested"].alias("r")).first()
    if row is None:
        raise FileNotFoundError(f"none of {list(fixed.COORDINATE_FILES)} is present")
    if row["r"] is None:
        raise KeyError(f"axis {axis!r} has no requested values")
    return [float(x) for x in row["r"]]


def axis_levels(coordinates: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, axis, ord, plev) of every axis with requested values in the given JSON texts (``value``)."""
    parsed = F.from_json("value", "struct<axis_entry:map<string,struct<requested:array<string>>>>")
    spread = coordinates.select(*keys, F.explode(parsed["axis_entry"]).alias("axis", "entry"))
    listed = spread.filter(F.col("entry.requested").isNotNull())
    return listed.select(*keys, "axis", F.posexplode("entry.requested").alias("ord", "_t")).select(*keys, "axis", "ord", F.col("_t").try_cast("double").alias("plev"))


def same_grid(left: DataFrame, right: DataFrame, columns: Sequence[str] = ("cell", "lat", "lon")) -> bool:
    """True if both hold the same cells with the same coordinates."""
    a, b = left.select(*columns).distinct(), right.select(*columns).distinct()
    # One shuffle: a row that both sides have counts 1 from each.
    sides = a.withColumn("_s", F.lit(1)).unionByName(b.withColumn("_s", F.lit(2)))
    return sides.groupBy(*columns).agg(F.sum("_s").alias("_t")).filter(F.col("_t") != 3).isEmpty()


GRID_MARK = ("grid_cells", "grid_hash", "grid_hash2")


def grid_fingerprint(grid: DataFrame, columns: Sequence[str] = ("cell", "lat", "lon")) -> tuple:
    """Number of distinct cells of a grid and two sums of hashes over them: alike for the same cells in any order."""
    cells = grid.select(*[(F.col(c) + F.lit(0)).alias(c) for c in columns]).distinct()  # adding 0 makes -0.0 a 0.0
    total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
    return tuple(cells.agg(F.count(F.lit(1)), total(1), total(2)).first())


def marked(fields: DataFrame, grid: DataFrame) -> DataFrame:
    """Fixed fields with the fingerprint of their grid in every row: constants, which cost nothing in a column file."""
    values = dict(zip(GRID_MARK, grid_fingerprint(grid), strict=True))
    return fields.withColumns({n: F.lit(v).cast("bigint" if n == "grid_cells" else "decimal(38,0)") for n, v in values.items()})


def fx_on_grid(stored: DataFrame, name: str, grid: DataFrame) -> DataFrame | None:
    """The stored fixed field of a name if there is one and it lies on the current grid; else None.

    Marked fields (:func:`marked`) are known by comparing three numbers; of others all coordinates are compared.
    """
    field = stored.filter(F.col("var") == name)
    if set(GRID_MARK) <= set(field.columns):
        marks = field.select(*GRID_MARK).distinct().limit(2).collect()
        return field.drop(*GRID_MARK) if len(marks) == 1 and tuple(marks[0]) == grid_fingerprint(grid) else None
    return field if not field.isEmpty() and same_grid(field, grid) else None


def load_existing_fx(spark: SparkSession, path: str, name: str, grid: DataFrame) -> DataFrame | None:
    """A stored fixed field, if there is one and it lies on the current grid; else None."""
    return fx_on_grid(spark.read.parquet(path), name, grid)


def facet_path(facets: Sequence[str] = fixed.TREE_FACETS) -> Column:
    """Output path of a row from its facet columns."""
    return F.concat_ws("/", *[F.col(f).cast("string") for f in facets])
