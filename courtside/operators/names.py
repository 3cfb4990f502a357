"""Known names and their variants as landed tables, so a run resolves names without exploding a vocabulary again.

Names come from several vocabularies (the spellings of statistics, those of the match history); each has two tables below
``path/<vocabulary>``: ``names`` (name, pos, landing) and ``variants`` (variant, left_out, name, pos, landing), the latter bucketed
and sorted by variant, so a join by variant moves the asked names only. ``extend`` adds the names that are not there yet and
nothing else. Variants are written before their names: a landing that breaks off is made up for by the next one, and a variant
written twice changes no result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators import fuzzy
from courtside.session import exists, materialize

NAMES = "name string, pos bigint, landing int"
VARIANTS = "variant string, left_out int, name string, pos bigint, landing int"
BUCKETS = 16


class NameIndex:
    """The landed names below a path; ``buckets`` counts for an index that is made by this call, an existing one keeps its own."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}/layout"
        if not exists(spark, f"{layout}/_SUCCESS"):
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(layout)
        self.buckets = spark.read.parquet(layout).first()["buckets"]

    def _table(self, vocabulary: str) -> str:
        """The variants as a table of this session; bucketing is known to the catalog, not to the files."""
        path = f"{self.path}/{vocabulary}/variants"
        table = f"name_variants_{hashlib.md5(path.encode()).hexdigest()}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({VARIANTS}) USING parquet "
                       f"CLUSTERED BY (variant) SORTED BY (variant) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return table

    def names(self, vocabulary: str) -> DataFrame:
        path = f"{self.path}/{vocabulary}/names"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], NAMES)
        return self.spark.read.schema(NAMES).parquet(path)

    def variants(self, vocabulary: str) -> DataFrame:
        table = self._table(vocabulary)
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def extend(self, df: DataFrame, vocabulary: str, name: str = "name", position: str | None = None) -> int:
        """Adds the names of ``df`` that the vocabulary does not have yet and returns their number. Only these are exploded."""
        known = self.names(vocabulary)
        landing = (known.agg(F.max("landing").alias("n")).first()["n"] or 0) + 1
        found = fuzzy.distinct_names(df, name, position)
        new = materialize(found.join(known, "name", "left_anti"), "new-names")
        count = new.count()
        if count:
            shared = fuzzy.shared_variants(new).withColumn("landing", F.lit(landing))
            # dealt by bucket first: one file a bucket instead of one for every task and bucket
            (shared.select("variant", "left_out", "name", "pos", "landing").repartition(self.buckets, "variant")
             .write.mode("append").insertInto(self._table(vocabulary)))
            new.withColumn("landing", F.lit(landing)).write.mode("append").parquet(f"{self.path}/{vocabulary}/names")
        return count

    def resolve(self, queries: DataFrame, vocabulary: str, query: str = "query") -> DataFrame:
        """Best known name of every distinct query: query, name, score, as ``fuzzy.resolve_names`` over all landed names."""
        asked = fuzzy.distinct_queries(queries, query)
        return fuzzy.resolve_against(asked, self.names(vocabulary).select("name", "pos"), self.variants(vocabulary).drop("landing"))
