"""Order-independent fingerprints of a key column, and their comparison before and after."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("n_rows", "n_distinct", "sum_all", "md5sum_all", "min_hk", "max_hk", "md5sum_distinct")


def _md5_number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, key_col: str) -> DataFrame:
    """One row. Rows are counted per distinct key first, so each key is digested once and
    one pass serves the sums over rows and over distinct keys."""
    per_key = df.groupBy(key_col).agg(F.count(F.lit(1)).alias("n"))
    text = F.hex(key_col)
    counted = per_key.select(
        "n", text.alias("t"), F.crc32(text).cast("decimal(20,0)").alias("c"), _md5_number(text).alias("m"))
    n = F.col("n").cast("decimal(18,0)")
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("t").alias("n_distinct"),
        F.sum(F.col("c") * n).cast("string").alias("sum_all"),
        F.sum(F.col("m") * n).cast("decimal(38,0)").cast("string").alias("md5sum_all"),
        F.min("t").alias("min_hk"), F.max("t").alias("max_hk"),
        F.sum("m").cast("decimal(38,0)").cast("string").alias("md5sum_distinct"))


def compare_fingerprints(before: DataFrame, after: DataFrame, key: str = "table_name") -> DataFrame:
    """Per table, the fingerprint fields that differ and a verdict."""
    a = before.select(key, *[F.col(f).alias("_b_" + f) for f in FIELDS], F.lit(True).alias("_b"))
    b = after.select(key, *FIELDS, F.lit(True).alias("_a"))
    both = a.join(b, key, "full_outer")
    differs = F.array_compact(F.array(*[
        F.when(~F.col(f).eqNullSafe(F.col("_b_" + f)), F.lit(f)) for f in FIELDS]))
    verdict = (F.when(F.col("_b").isNull(), "ONLY_AFTER").when(F.col("_a").isNull(), "ONLY_BEFORE")
               .when(F.size("differs") > 0, "DIFFERENT").otherwise("IDENTICAL"))
    shared = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    differs = F.when(shared, differs).otherwise(F.array().cast("array<string>"))
    return both.withColumn("differs", differs).select(key, "differs", verdict.alias("verdict"))


def stack(parts: dict[str, DataFrame], key_cols: dict[str, str]) -> DataFrame:
    """Fingerprints of several tables as one frame."""
    return reduce(DataFrame.unionByName, [
        fingerprint(df, key_cols[t]).withColumn("table_name", F.lit(t)) for t, df in parts.items()])
