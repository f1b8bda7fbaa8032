"""Aligning and joining source tables that do not have the same columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aligned_union(frames: Mapping[str, DataFrame], tag: str | None = None) -> DataFrame:
    """UNION ALL of tables with different columns: one sorted column list, typed NULL for
    what a table lacks. ``tag`` names a column that keeps the table of origin."""
    tagged = [df.withColumn(tag, F.lit(name)) if tag else df for name, df in sorted(frames.items())]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return out.select(*sorted(out.columns, key=str.lower))


def mixed_types(inventory: DataFrame) -> DataFrame:
    """Columns that do not have one type across the tables that carry them."""
    return (inventory.groupBy(F.lower("column_name").alias("column_name"))
            .agg(F.array_sort(F.collect_set("data_type")).alias("types")).where("size(types) > 1"))


def union_findings(inventory: DataFrame, pattern: str, required: Sequence[str], aliases: Sequence[str]) -> DataFrame:
    """What stops a declared union: no table, a required column missing, or aliases that are one name to a
    case-insensitive reader, among themselves or with a column of a covered table. ``inventory`` is (table_name,
    column_name, ...)."""
    spark = inventory.sparkSession
    covered = inventory.where(F.col("table_name").like(pattern))
    tables = covered.select("table_name").distinct()
    none = tables.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit("NO_TABLES").alias("finding"), F.lit(None).cast("string").alias("table_name"),
        F.lit(pattern).alias("detail"))
    have = covered.select("table_name", F.lower("column_name").alias("_c")).distinct()
    wanted = tables.select("table_name", F.explode(F.array(*map(F.lit, required))).alias("detail")).withColumn("_c", F.lower("detail"))
    missing = wanted.join(have, ["table_name", "_c"], "left_anti").select(
        F.lit("MISSING_REQUIRED").alias("finding"), "table_name", "detail")
    named = spark.createDataFrame([(a,) for a in aliases], "a string").groupBy(F.lower("a").alias("detail")).count()
    clash = named.where("count > 1").select(F.lit("ALIAS_CLASH").alias("finding"), F.lit(None).cast("string").alias("table_name"), "detail")
    taken = have.join(named, have["_c"] == named["detail"]).select(F.lit("ALIAS_CLASH").alias("finding"), "table_name", "detail")
    return none.unionByName(missing).unionByName(clash).unionByName(taken)
