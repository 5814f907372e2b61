"""A stored table with one row per key that can be updated in place.

Rows lie in `parts` folders by the hash of their key. An update reads and rewrites only the folders that hold a changed
key. The new rows are stored beside the table first and then take the folders' place, so an update that was broken off
can be run again, and one that is run twice changes nothing more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerpulse.session import cut_lineage
from ledgerpulse.sources.files import path_exists

_PART = "_part"


class KeyedTable:
    """Rows of `schema` under `path`, one per `key`; `parts` must stay the same for the life of the table."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, parts: int = 64) -> None:
        self.spark, self.path, self.key, self.parts = spark, path, key, parts
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _write(self, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_PART).parquet(self.path))

    def _stored(self) -> DataFrame:
        whole = T.StructType([*self.schema, T.StructField(_PART, T.IntegerType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(self.path)

    def read(self) -> DataFrame:
        """All rows; none before the first are written."""
        return self._stored().select(*self.schema.names)

    def upsert(self, rows: DataFrame) -> list[int]:
        """Puts whole rows in, in the place of those with the same key; returns the parts that were rewritten.

        Of several rows with one key the greatest by the other columns stays. Rows without key are refused.
        """
        others = [c for c in self.schema.names if c != self.key]
        new = rows.select(*self.schema.names).groupBy(self.key).agg(F.max(F.struct(*others)).alias("_row")).select(
            F.assert_true(F.col(self.key).isNotNull(), "a row needs its key").alias("_checked"), self.key, "_row.*")
        return self._replace(cut_lineage(new).drop("_checked"), lambda held, fresh: held.join(fresh, self.key, "left_anti").unionByName(fresh))

    def update(self, changes: DataFrame) -> list[int]:
        """Sets columns of rows that are there: `changes` has the key and the columns to set; a null leaves the old value.

        Of several changes of one key the greatest by the columns in order counts. Keys that are not there change nothing.
        """
        names = [c for c in changes.columns if c != self.key]
        new = changes.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(F.struct(*names)).alias("_new"))

        def merged(held: DataFrame, fresh: DataFrame) -> DataFrame:
            joined = held.join(fresh, self.key, "left")
            return joined.withColumns({c: F.coalesce(F.col(f"_new.{c}").cast(self.schema[c].dataType), F.col(c)) for c in names}).drop("_new")

        return self._replace(cut_lineage(new), merged)

    def _replace(self, fresh: DataFrame, merge) -> list[int]:
        touched = sorted(r[0] for r in fresh.select(self._part()).distinct().collect())  # at most `parts` numbers
        if not touched:
            return []
        held = self._stored().filter(F.col(_PART).isin(touched)).select(*self.schema.names)
        staged = cut_lineage(merge(held, fresh).select(*self.schema.names).withColumn(_PART, self._part()))
        self._write(staged.repartition(len(touched), _PART))
        return touched
