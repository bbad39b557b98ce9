"""Text files of fixed shapes as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.functions.columns import SEASONS
from agrolith.functions.types import inferred

#: Marks of missing observations.
MISSING = (-99.9, -99.99, -999.0, -999.9, -9999.0, 9999.0)


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True, typed: bool | str = True, schema: str | None = None) -> DataFrame:
    """typed: True lets Spark infer and falls back to strings where that fails, "auto" applies the 90 % rule to a
    bounded sample, False keeps strings. With a schema nothing is inferred."""
    reader = spark.read.option("header", header).option("sep", sep).option("multiLine", True).option("escape", '"')
    if schema:
        return reader.schema(schema).csv(path)
    if typed is True:
        try:
            return reader.option("inferSchema", True).csv(path)
        except Exception as error:
            if "convert" not in str(error).lower() and "cast" not in str(error).lower():
                raise
    strings = reader.csv(path)
    return inferred(strings) if typed == "auto" else strings


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(line, value, file) in the order of each file: such files are small, and read one to a task."""
    whole = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"))
    return whole.select("file", F.posexplode(F.split("text", r"\r?\n")).alias("line", "value"))


def present(value) -> F.Column:
    return value.isNotNull() & ~value.isin(*MISSING)


def season_index(spark: SparkSession, path: str) -> DataFrame:
    """`SEAS YEAR VALUE` rows, white-space delimited: season, year, value."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.size(parts) == 3).select(parts.alias("p"))
    out = rows.select(F.col("p")[0].alias("season"), F.col("p")[1].try_cast("int").alias("year"), F.col("p")[2].try_cast("double").alias("value"))
    return out.where(F.col("season").isin(*SEASONS) & F.col("year").isNotNull() & present(F.col("value")))


def fixed_width_months(spark: SparkSession, path: str, marker: str = "STANDARDIZED", width: int = 6) -> DataFrame:
    """After the last line with the marker: four digits of year, then twelve fields: year, month, value."""
    lines = numbered(spark, path)
    starts = lines.where(F.upper(F.col("value")).contains(marker)).groupBy("file").agg(F.max("line").alias("start"))
    rows = lines.join(starts, "file").where("line > start").where(F.col("value").rlike(r"^\s*\d{4}"))
    fields = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda m: F.substr("value", m * width + 5, F.lit(width)).try_cast("double"))
    long = rows.select(F.substring("value", 1, 4).try_cast("int").alias("year"), F.posexplode(fields).alias("month", "value"))
    return long.select("year", (F.col("month") + 1).alias("month"), "value").where(present(F.col("value")))


def year_matrix(spark: SparkSession, path: str) -> DataFrame:
    """The first line gives the first and last year; year rows have twelve values; other lines are prose."""
    lines = numbered(spark, path)
    bounds = lines.where("line = 0").select("file", F.split(F.trim("value"), r"\s+").alias("b")).select("file", F.col("b")[0].try_cast("int").alias("y0"), F.col("b")[1].try_cast("int").alias("y1"))
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.where("line > 0").withColumn("p", parts).where(F.size("p") >= 13).withColumn("year", F.col("p")[0].try_cast("int")).join(bounds, "file").where("year BETWEEN y0 AND y1")
    values = F.transform(F.slice("p", 2, 12), lambda x: x.try_cast("double"))
    return rows.select("year", F.posexplode(values).alias("month", "value")).select("year", (F.col("month") + 1).alias("month"), "value").where(present(F.col("value")))
