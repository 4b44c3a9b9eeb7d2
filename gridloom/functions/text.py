"""Column expressions on catalog sheets, file names and log lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed

NAME = r"[A-Za-z_]\w*"


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True if ``text`` holds any of the phrases, case-sensitive."""
    return F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(text, p)) if phrases else F.lit(False)


def lookup(table: Mapping[str, str], key: Column, default: Column | None = None) -> Column:
    """Value of a fixed table, else ``default`` (NULL when not given)."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, default)


# --- file names and paths ------------------------------------------------------------------------------------------


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def names_variable(name: Column, variable: Column) -> Column:
    """True if a file name holds ``.variable.``."""
    return F.contains(name, F.concat(F.lit("."), variable, F.lit(".")))


def log_variable(name: Column) -> Column:
    """Variable of a log file name, NULL for other files."""
    return F.nullif(F.regexp_extract(name, fixed.LOG_NAME_PATTERN, 1), F.lit(""))


def canonical_realm(realm: Column) -> Column:
    return lookup(fixed.CANONICAL_REALM, realm, realm)


def positive_direction(name: Column, stored: Column | None = None) -> Column:
    """``up`` or ``down`` for the listed names, else what the entry already has."""
    return lookup(fixed.POSITIVE_DIRECTION, name, stored)


# --- sheet cells -----------------------------------------------------------------------------------------------------


def clean_cell(cell: Column, *, rename_dimensions: bool = False) -> Column:
    """Without quotes and outer blanks; dimension names in short form on request."""
    bare = F.trim(F.translate(cell, "'\"", ""))
    return lookup(fixed.SHEET_DIMENSION_NAMES, bare, bare) if rename_dimensions else bare


def plain_number(cell: Column) -> Column:
    """``1.000,5`` as ``1000.5`` and a typographic minus as ``-``; text that is not such a number keeps its dots."""
    minus = F.translate(cell, "−", "-")
    numeric = F.trim(minus).rlike(r"^-?\d[\d.]*(,\d+)?$")
    return F.when(numeric, F.translate(F.translate(minus, ".", ""), ",", ".")).otherwise(minus)


def keep_row(
    realm: Column,
    source: Column,
    name: Column,
    realms: Sequence[str],
    source_phrases: Sequence[str] = fixed.SOURCE_SKIP_PHRASES,
    name_phrases: Sequence[str] = fixed.NAME_SKIP_PHRASES,
) -> Column:
    """Rows with a known realm, a source text, and none of the phrases that mark rows to skip."""
    text = F.trim(F.coalesce(source, F.lit("")))
    return (
        F.coalesce(realm.isin(*realms), F.lit(False))
        & (text != "")
        & ~contains_any(text, source_phrases)
        & ~contains_any(F.coalesce(name, F.lit("")), name_phrases)
    )


# --- formulas --------------------------------------------------------------------------------------------------------


def is_expression(text: Column) -> Column:
    """True for arithmetic, calls, several words or names with FATES; false for a single name."""
    t = F.trim(text)
    return t.rlike(r"[+\-*/^%]") | t.rlike(r"\w+\s*\(") | t.rlike(r"\w+\s+\w+") | F.contains(t, F.lit("FATES"))


def identifier_list(text: Column) -> Column:
    """Names of a comma list; NULL if any part is not a plain name or there is none."""
    parts = F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")
    plain = F.forall(parts, lambda p: p.rlike(rf"^{NAME}$"))
    return F.when((F.size(parts) > 0) & plain, parts)


def expression_variables(text: Column) -> Column:
    """Names in an expression, in order and with repeats, without function and keyword names.

    FATES variables are per land fraction, so the fraction joins the list when it is not named.
    """
    words = F.regexp_extract_all(text, F.lit(rf"({NAME})"), F.lit(1))
    known = F.array(*[F.lit(w) for w in fixed.EXPRESSION_WORDS])
    names = F.filter(words, lambda w: ~F.array_contains(known, w))
    add = F.contains(text, F.lit("FATES")) & ~F.contains(text, F.lit("FATES_FRAC"))
    return F.when(add, F.concat(names, F.array(F.lit("FATES_FRAC")))).otherwise(names)


def sum_dimension(variable: Column) -> Column:
    """Dimension an index list of ``variable`` refers to, read off the ending of its name."""
    is_fates = F.startswith(variable, F.lit("FATES"))
    chain = F.when(variable == "PCT_LANDUNIT", F.lit("ltype"))
    for ending, dim in fixed.FATES_SUM_DIMENSIONS.items():
        chain = chain.when(is_fates & F.endswith(variable, F.lit(ending)), F.lit(dim))
    return chain.otherwise(F.lit("lev"))


def index_numbers(text: Column) -> Column:
    """Whole numbers of ``1:3``, ``1,2`` or ``4`` as an array; a range that falls is empty."""
    bounds = F.split(text, ":")
    first, last = F.trim(bounds[0]).cast("int"), F.trim(F.get(bounds, F.lit(1))).cast("int")
    span = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    listed = F.transform(F.split(text, ","), lambda p: F.trim(p).cast("int"))
    return F.when(F.contains(text, F.lit(":")), span).otherwise(listed)


# A name and, in brackets, a list of numbers or one range of them. Other brackets stay what they are.
INDEX_SUM = rf"({NAME})\((\d+(?:,\d+)*|\d+:\d+)\)"


def _is_function(name: Column) -> Column:
    return name.isin(*fixed.EXPRESSION_WORDS)


def index_sums(formula: Column) -> Column:
    """All ``VAR(1:3)`` style sums of a formula as array of (var, idx, dim); calls of functions are none."""
    names = F.regexp_extract_all(formula, F.lit(INDEX_SUM), F.lit(1))
    lists = F.regexp_extract_all(formula, F.lit(INDEX_SUM), F.lit(2))
    found = F.filter(F.arrays_zip(names.alias("var"), lists.alias("list")), lambda s: ~_is_function(s["var"]))
    return F.transform(
        found,
        lambda s: F.struct(
            s["var"].alias("var"), index_numbers(s["list"]).alias("idx"), sum_dimension(s["var"]).alias("dim")
        ),
    )


def write_index_sums(formula: Column) -> Column:
    """Formula with each ``VAR(1:3)`` as the helper call that sums the listed positions of the dimension ``VAR`` implies.

    The text is cut at the sums and put together again, so a name that ends another one is not touched.
    """
    part = lambda group: F.regexp_extract_all(formula, F.lit(INDEX_SUM), F.lit(group))
    pieces = F.arrays_zip(
        F.split(formula, INDEX_SUM, -1).alias("before"), part(0).alias("whole"), part(1).alias("var"), part(2).alias("list")
    )

    def written(s: Column) -> Column:
        numbers = F.array_join(F.transform(index_numbers(s["list"]), lambda n: n.cast("string")), ", ")
        call = F.concat(
            F.lit("sumoverpft("), s["var"], F.lit(", pftlist=["), numbers, F.lit("], dimname='"), sum_dimension(s["var"]), F.lit("')")
        )
        sum_text = F.when(s["var"].isNull(), F.lit("")).when(_is_function(s["var"]), s["whole"]).otherwise(call)
        return F.concat(s["before"], sum_text)

    return F.when(formula.isNotNull(), F.array_join(F.transform(pieces, written), ""))


def positional_split(text: Column, count: Column) -> Column:
    """Comma list cut or padded with empty text to exactly ``count`` parts."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: F.trim(p))
    return F.slice(F.concat(parts, F.array_repeat(F.lit(""), count)), F.lit(1), count)


def parse_dimensions(text: Column, *, rename_dimensions: bool = False) -> Column:
    """Dimension names of a JSON array or comma list, with vegetation types and pressure axes by their common name."""
    as_json = F.from_json(text, "array<string>")
    listed = F.split(text, ",")
    raw = F.when(F.startswith(F.trim(text), F.lit("[")), F.coalesce(as_json, listed)).otherwise(listed)
    clean = F.transform(raw, lambda d: clean_cell(d, rename_dimensions=rename_dimensions))
    named = F.transform(clean, lambda d: F.when(d == "pft", F.lit("vegtype")).otherwise(d))
    renamed = F.transform(named, lambda d: F.when(d == pressure_axis(named), F.lit("plev")).otherwise(d))
    order = F.array(*[F.lit(d) for d in fixed.DIMENSION_ORDER])
    place = lambda d: F.when(F.array_contains(order, d), F.array_position(order, d)).otherwise(len(fixed.DIMENSION_ORDER) + 1)
    # The running number keeps the given order among equals.
    keyed = F.transform(renamed, lambda d, i: F.struct(place(d).alias("p"), i.alias("i"), d.alias("d")))
    ordered = F.transform(F.array_sort(keyed), lambda s: s["d"])
    return F.when(pressure_axis(named).isNotNull(), ordered).otherwise(named)


def pressure_axis(dims: Column) -> Column:
    """First dimension named ``plev`` plus a number, NULL if there is none."""
    return F.get(F.filter(dims, lambda d: d.rlike(r"^plev\d")), F.lit(0))


def _levels(name: Column, units: Column, axis: Column, bounds: Column) -> Column:
    return F.struct(
        name.alias("name"), units.alias("units"), axis.alias("src_axis_name"), bounds.alias("src_axis_bnds")
    )


def infer_levels(
    dims: Column,
    name: Column | None = None,
    units: Column | None = None,
    axis: Column | None = None,
    bounds: Column | None = None,
) -> Column:
    """Level block: explicit columns first, else by pressure axis, else the hybrid block for model levels."""
    none = F.lit(None).cast("string")
    blank = lambda c: none if c is None else F.nullif(F.trim(c), F.lit(""))
    given = blank(name)
    hybrid = F.array_contains(dims, "lev") | F.array_contains(dims, "alevel")
    return (
        F.when(given.isNotNull(), _levels(given, blank(units), blank(axis), blank(bounds)))
        .when(pressure_axis(dims).isNotNull(), _levels(pressure_axis(dims), F.lit("Pa"), none, none))
        .when(hybrid, _levels(F.lit("standard_hybrid_sigma"), F.lit("1"), F.lit("lev"), F.lit("ilev")))
    )
