"""Bound SQL parameters and the predicate that reads one level of a rollup table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bindings:
    """Collects parameters in order: value(x) gives `?`, list(xs) `?, ?`; an empty list gives NULL, which matches
    nothing in an IN list."""

    def __init__(self) -> None:
        self._params: list[Any] = []

    def value(self, value: Any) -> str:
        self._params.append(value)
        return "?"

    def list(self, values: list | tuple) -> str:
        if not isinstance(values, list | tuple):
            raise TypeError("a list is needed")
        return ", ".join(self.value(v) for v in values) or "NULL"

    @property
    def params(self) -> list[Any]:
        return list(self._params)


def present(values: str | list[str] | None) -> list[str]:
    """A scalar or list without blanks."""
    given = [values] if isinstance(values, str) else list(values or [])
    return [v for v in given if v is not None and str(v).strip()]


def level_of(admin0: list[str], admin1: list[str], most: int = 2) -> int:
    return min(0 if not admin0 else 1 if not admin1 else 2, most)


def level_sql(selection: dict[str, Any], bind: Bindings, most: int = 2, iso3: list[str] | None = None) -> str:
    """A WHERE clause: the selected names, and NULL tests that pick the level below the selection."""
    admin0, admin1 = present(selection.get("admin0")), present(selection.get("admin1"))
    level = level_of(admin0, admin1, most)
    parts = [f"iso3 IN ({bind.list(iso3)})"] if iso3 else []
    parts += [f"admin0_name IN ({bind.list(admin0)})"] if admin0 else []
    parts += [f"admin1_name IN ({bind.list(admin1)})"] if admin1 and level >= 1 else []
    parts += [f"admin1_name IS {'NOT ' if level >= 1 else ''}NULL"]
    parts += [f"admin2_name IS {'NOT ' if level >= 2 else ''}NULL"] if most >= 2 else []
    return " AND ".join(parts)


def level_column(selection: dict[str, Any], most: int = 2, names: tuple[str, str, str] = ("admin0_name", "admin1_name", "admin2_name"), grouping: str | None = None) -> Column:
    """The same predicate as a column. With grouping, the level is read from that grouping_id column instead of NULLs,
    so a missing key is not taken for a level."""
    admin0, admin1 = present(selection.get("admin0")), present(selection.get("admin1"))
    level = level_of(admin0, admin1, most)
    out = F.lit(True)
    if admin0:
        out &= F.col(names[0]).isin(*admin0)
    if admin1 and level >= 1:
        out &= F.col(names[1]).isin(*admin1)
    if grouping:
        return out & (F.col(grouping) == [3, 1, 0][level])
    out &= F.col(names[1]).isNotNull() if level >= 1 else F.col(names[1]).isNull()
    if most >= 2:
        out &= F.col(names[2]).isNotNull() if level >= 2 else F.col(names[2]).isNull()
    return out
