"""Row functions in Python, for what expressions cannot say: Arrow batches, errors kept by row, types inferred."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 100


@dataclass(frozen=True)
class RowFunction:
    """A function of a row (a dict). Without a type it is inferred from what the first SAMPLE_ROWS rows give."""

    function: Callable[[dict], Any]
    type: str | None = None


def output_type(df: DataFrame, function: Callable[[dict], Any], sample_rows: int = SAMPLE_ROWS) -> str:
    """boolean, bigint, double or string, whichever holds all values of the sample that the function doesn't fail on."""
    found = set()
    for row in df.limit(sample_rows).collect():
        try:
            found.add(type(function(row.asDict())))
        except Exception:  # noqa: BLE001, S112  a failing row tells nothing about the type
            continue
    found.discard(type(None))
    if found == {bool}:
        return "boolean"
    if found == {int}:
        return "bigint"
    return "double" if found and found <= {int, float} else "string"


def guarded(function: Callable[[dict], Any], kind: str) -> Callable:
    """The function as a UDF that gives the value or, where it raises, the error's text."""
    number = {"double": float, "bigint": int, "string": str}.get(kind, lambda x: x)

    def run(row):
        try:
            value = function(row if isinstance(row, dict) else row.asDict())
            return {"value": None if value is None else number(value), "error": None}
        except Exception as error:  # noqa: BLE001  whatever the caller's function raises
            return {"value": None, "error": f"{type(error).__name__}: {error}"}

    return F.udf(run, f"value {kind}, error string", useArrow=True)


def called(df: DataFrame, calls: dict[str, RowFunction]) -> dict[str, Column]:
    """name -> struct(value, error), each computed from the frame's own columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return {name: guarded(call.function, call.type or output_type(df, call.function))(row) for name, call in calls.items()}


def settled(df: DataFrame, names: list[str], errors: str | None) -> DataFrame:
    """Values in place of the structs; with errors, a map column from a derived column's name to its error, if any."""
    if errors:
        told = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.col(f"`{n}`.error") for n in names)))
        df = df.withColumn(errors, F.map_filter(told, lambda _, text: text.isNotNull()))
    return df.withColumns({name: F.col(f"`{name}`.value") for name in names})
