"""Readers of landed files. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside import schemas
from courtside.functions import text

# path layouts below the lake root, as the name of every directory level
PLAYER_LAYOUT = ("year", "week", "surface")
TOURNAMENT_LAYOUT = ("year", "type", "surfaceInout", "tournament")


def path_part(path: Column, from_end: int) -> Column:
    """Directory level of a file path, counted from the file name (0), as ``value`` or ``level=value``."""
    level = F.element_at(F.split(path, "/"), -(from_end + 1))
    decoded = F.try_url_decode(F.replace(level, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^[A-Za-z_]+=", "")


def read_lake(
    spark: SparkSession, path: str, columns: list[str], layout: tuple[str, ...], *, year: int | None = None,
) -> DataFrame:
    """All one-row CSV files below ``path/year/...`` as one table, in a single scan.

    The first directory level is the year: a given year becomes part of the path, so other years are not even listed.
    Directory levels not in the file come as columns ``_<level>``, and ``seq`` is the file path: its order is the landing
    order that "last row" lookups rely on.
    """
    first = "*" if year is None else f"{{{year},*={year}}}"
    pattern = "/".join([path.rstrip("/"), first] + ["*"] * (len(layout) - 1))
    raw = spark.read.schema(schemas.text_schema(columns, index=True)).option("header", True).option("escape", '"').csv(f"{pattern}/*.csv")
    file = F.col("_metadata.file_path")
    levels = [
        path_part(file, len(layout) - i).alias(f"_{name}") for i, name in enumerate(layout)
    ]
    return raw.select(*columns, file.alias("seq"), *levels)


def read_players(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Raw player statistics of a lake."""
    return read_lake(spark, path, schemas.STAT_COLUMNS, PLAYER_LAYOUT, year=year)


def read_tournaments(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Raw matches of a lake."""
    return read_lake(spark, path, schemas.MATCH_COLUMNS, TOURNAMENT_LAYOUT, year=year)


def read_entities(spark: SparkSession, path: str, columns: list[str], layout: tuple[str, ...]) -> DataFrame:
    """Entities written below one directory per level. The levels are partitions: a filter on them decides which directories are
    read. Their values are text, as in their names."""
    levels = T.StructType([T.StructField(f"_{name}", T.StringType()) for name in layout])
    schema = T.StructType([*schemas.text_schema(columns).fields, *levels.fields])
    return spark.read.schema(schema).parquet(path)


def read_table_csv(
    spark: SparkSession, path: str, columns: list[str], *, index: bool = False, complete_only: bool = False,
) -> DataFrame:
    """A consolidated CSV with its null markers resolved, optionally without incomplete rows."""
    raw = spark.read.schema(schemas.text_schema(columns, index=index)).option("header", True).option("escape", '"').csv(path)
    out = raw.select(*[text.null_tokens(F.col(c)).alias(c) for c in columns])
    return out.dropna("any") if complete_only else out


def tournament_lookup(df: DataFrame, json: str = "json") -> DataFrame:
    """name, surface, inOut and points of every tournament in JSON objects keyed by name."""
    parsed = df.select(F.explode(F.from_json(json, schemas.TOURNAMENT_INFO)).alias("name", "info"))
    return parsed.select("name", "info.surface", "info.inOut", "info.points")


def read_tournament_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Tournament lookup from a JSON file, one object per file."""
    return tournament_lookup(spark.read.text(path, wholetext=True), "value")


def read_feed(spark: SparkSession, path: str, schema: T.StructType, *, per_line: bool = False) -> DataFrame:
    """Landed feed documents, one per file or one per line, with ``landed``: the directory of the file. A poll lands its
    documents in one directory, named so that later polls sort behind earlier ones. Only documents on lines can be split
    between tasks."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    return spark.read.schema(schema).json(path, multiLine=not per_line).select(*schema.fieldNames(), folder.alias("landed"))


def stream_feed(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int) -> DataFrame:
    """Landed feed documents, one per line, as a stream that takes so many files at a time, oldest first; columns as ``read_feed``."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    return stream.select(*schema.fieldNames(), folder.alias("landed"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages to extract from: url and html."""
    return spark.read.parquet(path).select("url", "html")
