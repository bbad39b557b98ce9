"""Named sources as views."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.functions.types import inferred

from . import containers, files


def register_views(spark: SparkSession, entries: list[dict[str, Any]]) -> list[str]:
    """entries: key, path, and optionally table (cache it), select (expressions) and where (predicates, all of which
    hold). Entries with a blank key are skipped. Projection and predicates reach the parquet scan."""
    names = []
    for entry in entries:
        key = (entry.get("key") or "").strip()
        if not key:
            continue
        df = spark.read.parquet(entry["path"])
        if entry.get("where"):
            df = df.where(" AND ".join(f"({w})" for w in entry["where"]))
        if entry.get("select"):
            df = df.selectExpr(*entry["select"])
        (df.cache() if entry.get("table") else df).createOrReplaceTempView(key)
        names.append(key)
    return names


def load(spark: SparkSession, source: Any, **options: Any) -> DataFrame:
    """A frame from a frame, an Arrow table, a list (of rows or plain values) or a file, told apart by its extension."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, pa.Table):
        return spark.createDataFrame(source)
    if isinstance(source, list | tuple):
        if not source:
            raise ValueError("an empty list has no columns")
        if isinstance(source[0], dict):
            columns = list(dict.fromkeys(key for row in source for key in row))
            return spark.createDataFrame(pa.Table.from_pydict({c: [row.get(c) for row in source] for c in columns}))
        return spark.createDataFrame(pa.Table.from_pydict({"value": list(source)}))
    if not isinstance(source, str):
        raise TypeError(f"no source: {type(source).__name__}")
    kind = source.rsplit(".", 1)[-1].lower()
    readers = {
        "parquet": lambda: spark.read.parquet(source),
        "orc": lambda: spark.read.orc(source),
        "csv": lambda: files.read_csv(spark, source, **options),
        "tsv": lambda: files.read_csv(spark, source, sep="\t", **options),
        "json": lambda: spark.read.json(source, multiLine=True),
        "ndjson": lambda: spark.read.json(source),
        "arrow": lambda: containers.read_arrow(spark, source),
        "feather": lambda: containers.read_arrow(spark, source),
        "xml": lambda: spark.read.format("xml").option("rowTag", options.get("row_tag", "row")).load(source),
        "txt": lambda: spark.read.text(source),
        "png": lambda: image(spark, source),
        "jpg": lambda: image(spark, source),
        "jpeg": lambda: image(spark, source),
        "html": lambda: spark.read.text(source, wholetext=True),
        "db": lambda: containers.read_sqlite(spark, source, options["table"]),
        "sqlite": lambda: containers.read_sqlite(spark, source, options["table"]),
        "xlsx": lambda: containers.read_xlsx(spark, source, **options),
    }
    return readers.get(kind, lambda: spark.read.format("binaryFile").load(source))()


def image(spark: SparkSession, path: str) -> DataFrame:
    """(origin, height, width, channels, mode, data) of images."""
    return spark.read.format("image").load(path).select("image.origin", "image.height", "image.width", "image.nChannels", "image.mode", "image.data").withColumnRenamed("nChannels", "channels")


def chunks(spark: SparkSession, path: str, size: int = 1 << 16) -> DataFrame:
    """A file's bytes as a stream of rows (place, chunk), in order of place."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    places = F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))
    return files.select("content", F.explode(places).alias("place")).select("place", F.substr("content", F.col("place") * size + 1, F.lit(size)).alias("chunk"))


class Catalog:
    """Sources by name, loaded when first asked for and kept until they are replaced or, for a list, its length changes."""

    def __init__(self, spark: SparkSession, sources: dict[str, Any]) -> None:
        self.spark, self.sources, self.frames, self.sizes = spark, dict(sources), {}, {}

    @classmethod
    def of(cls, spark: SparkSession, sources: dict[str, Any]) -> Catalog:
        catalog = cls(spark, sources)
        for name in sources:
            catalog.frame(name).createOrReplaceTempView(name)
        return catalog

    def frame(self, name: str) -> DataFrame:
        source = self.sources[name]
        held = source.get("data") if isinstance(source, dict) else source
        size = len(held) if isinstance(held, list) else None
        if name in self.sizes and self.sizes[name] != size:
            self.frames.pop(name, None)
        if name not in self.frames:
            self.sizes[name] = size
            options = {k: v for k, v in source.items() if k not in ("data", "file")} if isinstance(source, dict) else {}
            self.frames[name] = load(self.spark, source.get("data", source.get("file")) if isinstance(source, dict) else source, **options)
        return self.frames[name]

    def replace(self, name: str, source: Any) -> None:
        self.sources[name] = source
        self.frames.pop(name, None)
        self.frame(name).createOrReplaceTempView(name)

    def sql(self, text: str, *values: Any) -> DataFrame:
        return self.spark.sql(text, args=list(values)) if values else self.spark.sql(text)

    def row(self, text: str, *values: Any) -> dict | None:
        """The first row, or None; a limit keeps the rest from being computed."""
        first = self.sql(text, *values).limit(1).collect()
        return first[0].asDict() if first else None

    def tables(self) -> list[str]:
        return sorted(self.sources)

    def columns(self, name: str) -> list[tuple[str, str, bool]]:
        return [(f.name, f.dataType.simpleString(), f.nullable) for f in self.frame(name).schema.fields]


def typed(df: DataFrame) -> DataFrame:
    """String columns by the 90 % rule."""
    return inferred(df)
