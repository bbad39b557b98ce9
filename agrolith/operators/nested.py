"""Nested documents to rows: model arrays, fan-outs, properties, entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType


def parsed(df: DataFrame, text: str, schema: str, name: str = "doc") -> DataFrame:
    """JSON text as a nested column; what doesn't parse is null."""
    return df.withColumn(name, F.from_json(F.col(text), schema))


def model_rows(df: DataFrame, keys: list[str], models: str, labels: str, name: str = "name", values: str = "values") -> DataFrame:
    """keys, model, label, place, value: an array of (name, values) structs beside an array of the values' labels. Values
    beyond the labels are dropped, labels without a value give null."""
    each = df.select(*keys, F.explode(models).alias("_m"), F.col(labels).alias("_l"))
    placed = each.select(*keys, F.col(f"_m.{name}").alias("model"), F.posexplode("_l").alias("place", "label"), F.col(f"_m.{values}").alias("_v"))
    return placed.select(*keys, "model", "label", "place", F.get("_v", F.col("place")).alias("value"))


def fan_out(df: DataFrame, array: str, name: str, keep_empty: bool = False) -> DataFrame:
    """One row for each element; rows without any are dropped unless keep_empty."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.select(*(c for c in df.columns if c != array), explode(array).alias(name))


def flattened(df: DataFrame, struct: str, prefix: str = "") -> DataFrame:
    """A struct's fields as columns, structs within it too; a clash with another column takes the struct's name before."""
    names = [c for c in df.columns if c != struct]
    out: list[Column] = [F.col(c) for c in names]

    def add(column: Column, kind, name: str) -> None:
        if isinstance(kind, StructType):
            for field in kind.fields:
                add(column[field.name], field.dataType, field.name)
            return
        own = f"{prefix}{name}"
        while own in names:
            own = f"{struct}_{own}"
        names.append(own)
        out.append(column.alias(own))

    for field in df.schema[struct].dataType.fields:
        add(F.col(struct)[field.name], field.dataType, field.name)
    return df.select(*out)


def season_rows(df: DataFrame, array: str, mark: str = "-") -> DataFrame:
    """One row for each "label-year" of an array, split: season, year (null where it is no number)."""
    each = fan_out(df, array, "_s")
    return each.withColumn("season", F.substring_index("_s", mark, 1)).withColumn("year", F.substring_index("_s", mark, -1).try_cast("int")).drop("_s")


def entries(column: str, df: DataFrame) -> Column:
    """A struct's or map's entries as an array of (key, value); a struct's values become strings."""
    kind = df.schema[column].dataType
    if isinstance(kind, MapType):
        return F.map_entries(column)
    return F.array(*(F.struct(F.lit(f.name).alias("key"), F.col(column)[f.name].cast("string").alias("value")) for f in kind.fields))


def from_entries(pairs: Column) -> Column:
    """The map of an array of (key, value); of equal keys the last one counts."""
    last = F.filter(pairs, lambda pair, at: ~F.exists(F.slice(pairs, at + 2, F.greatest(F.size(pairs) - at - 1, F.lit(0))), lambda other: other["key"] == pair["key"]))
    return F.map_from_entries(last)
