"""Tables stored in hash buckets by key: a load of any size meets them without moving what is stored."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class BucketedTable:
    """An insert-only table in a folder, ``buckets`` files a load at most, each holding one bucket of the keys.

    The number of buckets is fixed for good: some hundred MB of keys a bucket at the size the table is to reach. Key,
    number and columns are written beside the rows, and a table that is opened otherwise is refused.
    """

    spark: SparkSession
    path: str
    key: str
    buckets: int

    @property
    def name(self) -> str:
        return "bucketed_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def _declared(self) -> StructType | None:
        from lodestrata.streaming.flows import stored
        held = stored(self.spark, f"{self.path}/_declared")
        if held is None:
            return None
        row = held.head()
        if (row["key"], row["buckets"]) != (self.key, self.buckets):
            raise ValueError(f"{self.path} is stored in {row['buckets']} buckets by {row['key']}")
        return StructType.fromJson(json.loads(row["columns"]))

    def _open(self, schema: StructType) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'")

    def append(self, rows: DataFrame) -> None:
        """Adds rows; columns are taken by name, and others than the table's are refused. One shuffle by key, so that
        each bucket is written by one task into one file."""
        schema = self._declared()
        if schema is None:
            schema = StructType.fromJson(rows.schema.jsonValue())
            shape = self.spark.createDataFrame([(self.key, self.buckets, schema.json())], "key string, buckets int, columns string")
            shape.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_declared")
        if {f.name: f.dataType.simpleString() for f in schema} != {f.name: f.dataType.simpleString() for f in rows.schema}:
            raise ValueError(f"{self.path} has other columns")
        self._open(schema)
        rows.select(*schema.names).repartition(self.buckets, self.key).write.insertInto(self.name)

    def read(self) -> DataFrame | None:
        """All rows, or None before the first load. Joins and groups by the key need no shuffle of them."""
        schema = self._declared()
        if schema is None:
            return None
        self._open(schema)
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)


def stored_buckets(df: DataFrame, key: str) -> int | None:
    """The number of buckets by that one key in which the frame's only source is stored, else None. Runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    if leaves.size() != 1 or leaves.head().getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = leaves.head().relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation" or relation.bucketSpec().isEmpty():
        return None
    spec = relation.bucketSpec().get()
    return spec.numBuckets() if spec.bucketColumnNames().mkString(",").lower() == key.lower() else None


def only_named(target: DataFrame, names: DataFrame, key: str, buckets: int) -> DataFrame:
    """Stored rows whose key is among the names (column ``_named``): these are dealt out as the buckets are, once each, and the table is not."""
    dealt = names.distinct().repartition(buckets, "_named")
    return target.join(dealt.hint("merge"), F.col(key) == F.col("_named"), "left_semi")
