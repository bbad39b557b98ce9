"""A declarative table specification: types, derive, filter, sort, slice, select, names, in that order.

SQL semantics by default. `nulls="js"` gives the in-memory dialect: ne and nin keep nulls, comparisons take null as 0,
sorting puts null and NaN last in both directions (which is also the default here).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from agrolith.functions.rowwise import RowFunction, called, settled
from agrolith.functions.types import coerce

#: Operand counts: exact, or None for one and more.
OPERANDS = {"eq": 1, "ne": 1, "lt": 1, "lte": 1, "gt": 1, "gte": 1, "in": None, "nin": None, "c": 1, "nc": 1, "n": 0, "nn": 0, "v": 0, "nv": 0}


@dataclass
class Filter:
    """type: one of OPERANDS. column: a name. values: literals, or Columns to compare with another column."""

    type: str
    column: str
    values: list[Any] = field(default_factory=list)


@dataclass
class Sort:
    column: str
    direction: str = "asc"


@dataclass
class TableSpec:
    types: dict[str, str] = field(default_factory=dict)
    derive: dict[str, Column | str | RowFunction] = field(default_factory=dict)
    filter: list[Filter] = field(default_factory=list)
    sort: list[Sort] = field(default_factory=list)
    slice: tuple[int | None, int | None] = (None, None)
    select: list[str] | None = None
    names: dict[str, str] = field(default_factory=dict)
    nulls: str = "sql"
    #: With a name, what a derived column raises on a row is kept in a map of that name, and the value is null.
    errors: str | None = None


def floating(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes).get(name) in ("double", "float")


def numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType) if name in df.columns else False


def valid(df: DataFrame, name: str, kind: str | None = None) -> Column:
    """Whether a value is one of its logical type (the column's own if none is given): there, not NaN, and for a text
    such as the type's coercion takes."""
    column = df[name]
    if kind is None or kind in ("raw", "other", "string", "array", "object", "buffer"):
        return column.isNotNull() & (~F.isnan(column) if floating(df, name) else F.lit(True))
    fits = coerce(column, kind)
    fits = fits.isNotNull() & (~F.isnan(fits) if kind in ("integer", "number") else F.lit(True))
    return fits & (fits_integer(coerce(column, kind)) if kind == "integer" else F.lit(True))


def fits_integer(number: Column) -> Column:
    return number == F.floor(number)


def predicate(df: DataFrame, entry: Filter, nulls: str = "sql", like_wildcards: bool = False, kind: str | None = None) -> Column:
    """kind: the logical type by which v and nv judge. A null text compares with nothing in either dialect."""
    if entry.type not in OPERANDS:
        raise ValueError(f"unknown filter {entry.type!r}")
    wanted = OPERANDS[entry.type]
    if wanted is not None and len(entry.values) != wanted:
        raise ValueError(f"filter {entry.type!r} takes {wanted} operands, not {len(entry.values)}")
    column, js = df[entry.column], nulls == "js"
    values = [v if isinstance(v, Column) else F.lit(v) for v in entry.values]
    compared = F.coalesce(column, F.lit(0)) if js and numeric(df, entry.column) else column
    match entry.type:
        case "eq":
            return column.eqNullSafe(values[0]) if js else column == values[0]
        case "ne":
            return ~column.eqNullSafe(values[0]) if js else column != values[0]
        case "lt":
            return compared < values[0]
        case "lte":
            return compared <= values[0]
        case "gt":
            return compared > values[0]
        case "gte":
            return compared >= values[0]
        case "in":
            return column.isin(*values) if values else F.lit(False)
        case "nin":
            out = ~column.isin(*values) if values else F.lit(True)
            return out | column.isNull() if js else out
        case "c" | "nc":
            held = column.like(f"%{entry.values[0]}%") if like_wildcards else F.contains(column, values[0])
            return held if entry.type == "c" else ~held
        case "n":
            return column.isNull()
        case "nn":
            return column.isNotNull()
        case "v":
            return valid(df, entry.column, kind)
    return ~valid(df, entry.column, kind)


def ordering(df: DataFrame, sorts: list[Sort]) -> list[Column]:
    """Null and NaN last whatever the direction."""
    out = []
    for sort in sorts:
        if sort.direction not in ("asc", "desc"):
            raise ValueError(f"unknown direction {sort.direction!r}")
        column = F.nanvl(df[sort.column], F.lit(None)) if floating(df, sort.column) else df[sort.column]
        out.append(column.asc_nulls_last() if sort.direction == "asc" else column.desc_nulls_last())
    return out


def evaluate(df: DataFrame, spec: TableSpec) -> DataFrame:
    for name, kind in spec.types.items():
        df = df.withColumn(name, coerce(df[name], kind))
    # derived columns see the source under its new names, and not each other
    renamed = df.withColumnsRenamed(spec.names)
    derived = {name: (F.expr(value) if isinstance(value, str) else value) for name, value in spec.derive.items()}
    calls = {name: value for name, value in derived.items() if isinstance(value, RowFunction)}
    derived = {name: value for name, value in derived.items() if name not in calls} | called(renamed, calls)
    if derived:
        back = {new: old for old, new in spec.names.items()}
        df = renamed.withColumns(derived).withColumnsRenamed(back)
    if calls:
        df = settled(df, list(calls), spec.errors)
    for entry in spec.filter:
        df = df.where(predicate(df, entry, spec.nulls, kind=spec.types.get(entry.column)))
    if spec.sort:
        df = df.orderBy(*ordering(df, spec.sort))
    start, stop = spec.slice
    if start:
        df = df.offset(start)
    if stop is not None:
        df = df.limit(max(stop - (start or 0), 0))
    if spec.select is not None:
        if not spec.select:
            raise ValueError("at least one column must be selected")
        df = df.select(*spec.select)
    return df.withColumnsRenamed(spec.names)


def quoted(*parts: str) -> str:
    """A multipart identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def render_sql(table: str | tuple[str, ...], spec: TableSpec) -> tuple[str, list[Any]]:
    """The spec as SQL text with `?` parameters; derive and types have no SQL form and are refused."""
    if spec.derive or spec.types:
        raise ValueError("derive and types have no SQL form")
    if not table:
        raise ValueError("a table is needed")
    if spec.select is not None and not spec.select:
        raise ValueError("at least one column must be selected")
    params: list[Any] = []
    columns = ", ".join(quoted(c) + (f" AS {quoted(spec.names[c])}" if c in spec.names else "") for c in spec.select) if spec.select else "*"
    sql = f"SELECT {columns} FROM {quoted(*([table] if isinstance(table, str) else table))}"
    symbols = {"eq": "=", "ne": "<>", "lt": "<", "lte": "<=", "gt": ">", "gte": ">="}
    where = []
    for entry in spec.filter:
        wanted = OPERANDS.get(entry.type, -1)
        if wanted == -1 or (wanted is not None and wanted != len(entry.values)):
            raise ValueError(f"bad filter {entry.type!r}")
        name = quoted(entry.column)
        if entry.type in symbols:
            where.append(f"{name} {symbols[entry.type]} ?")
            params += entry.values
        elif entry.type in ("in", "nin"):
            marks = ", ".join("?" for _ in entry.values) or "NULL"
            where.append(f"{name} {'NOT ' if entry.type == 'nin' else ''}IN ({marks})")
            params += entry.values
        elif entry.type in ("c", "nc"):
            where.append(f"{name} {'NOT ' if entry.type == 'nc' else ''}LIKE ?")
            params.append(f"%{entry.values[0]}%")
        else:
            where.append(f"{name} IS {'NOT ' if entry.type in ('nn', 'v') else ''}NULL")
    if where:
        sql += " WHERE " + " AND ".join(where)
    if spec.sort:
        sql += " ORDER BY " + ", ".join(f"{quoted(s.column)} {s.direction.upper()} NULLS LAST" for s in spec.sort)
    start, stop = spec.slice
    if stop is not None:
        sql += f" LIMIT {max(stop - (start or 0), 0)}"
    if start:
        sql += f" OFFSET {start}"
    return sql, params


def search(df: DataFrame, query: str) -> DataFrame:
    """Rows in which every token of the query begins a word of some column, case aside."""
    text = F.concat_ws(" ", *(F.col(quoted(c)).cast("string") for c in df.columns))
    for token in query.split():
        escaped = "".join(f"\\{c}" if not c.isalnum() else c for c in token)
        df = df.where(text.rlike(rf"(?i)(?:^|\W){escaped}"))
    return df
