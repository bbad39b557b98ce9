"""Sinks: RFC 4180 CSV, parquet with a given schema, reports and sidecars."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOM = "﻿"


def csv_cell(column: Column) -> Column:
    """Null to empty, newlines to CRLF, quoted where it holds a comma, quote or newline."""
    text = F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), r"\r\n|\r|\n", "\r\n")
    return F.when(text.rlike(r'[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_line(columns: list[str]) -> Column:
    return F.concat_ws(",", *(csv_cell(F.col(f"`{c}`")) for c in columns))


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, header: bool = True) -> None:
    """CRLF lines in part files; each part begins with the header, so each is a file of its own, and an empty frame gives
    one with the header alone. A byte-order mark is added by csv_text(), for downloads."""
    columns = columns or df.columns
    lines = df.select(csv_line(columns).alias("value"))
    if header:
        names = ",".join(columns)

        def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = True
            for batch in batches:
                if first and batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([names])], ["value"])
                    first = False
                yield pa.RecordBatch.from_arrays([batch.column(0)], ["value"])

        alone = df.sparkSession.createDataFrame([(names,)], "value string")
        lines = alone.coalesce(1) if df.isEmpty() else lines.mapInArrow(headed, "value string")
    lines.write.option("lineSep", "\r\n").mode("overwrite").text(path)


def csv_text(df: DataFrame, columns: list[str] | None = None, bom: bool = True, last_newline: bool = True, most_rows: int = 100_000) -> str:
    """A download of at most most_rows rows; more raise. Without bom an empty frame gives an empty text."""
    columns = columns or df.columns
    lines = [row[0] for row in df.limit(most_rows + 1).select(csv_line(columns).alias("line")).collect()]
    if len(lines) > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    if not lines and not bom:
        return ""
    text = "\r\n".join([",".join(columns), *lines])
    return (BOM if bom else "") + text + ("\r\n" if last_newline else "")


def write_parquet(df: DataFrame, path: str, schema: dict[str, str], mode: str = "overwrite") -> None:
    """Columns cast to a fixed schema, in its order."""
    df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in schema.items())).write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, order: list[str]) -> None:
    """Documents in an order, one line each."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def sidecar(df: DataFrame, **text: str) -> str:
    """Row count and columns beside given texts, as JSON."""
    columns = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]
    return json.dumps({**text, "rows": df.count(), "columns": columns}, ensure_ascii=False, indent=2)
