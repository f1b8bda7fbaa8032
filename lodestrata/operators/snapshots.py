"""Reference snapshots: landing their edges and deriving effectivity from their differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.rules import strip


def land_membership(organisations: DataFrame, stamp: dict[str, str]) -> DataFrame:
    """Directed edges out of the ``included`` and ``included_in`` arrays, tagged by direction."""
    added = {"relationship_status": F.lit("active"), **{k: F.lit(v) for k, v in stamp.items()}}
    down = organisations.select(
        F.col("reference_id").alias("group_reference_id"), F.explode("included").alias("member_reference_id"),
        F.lit("includes").alias("relation"), "effective_from")
    up = organisations.select(
        F.explode("included_in").alias("group_reference_id"), F.col("reference_id").alias("member_reference_id"),
        F.lit("included_in").alias("relation"), "effective_from")
    return down.unionByName(up).withColumns(added)


def snapshot_effectivity(prev: DataFrame, cur: DataFrame, fetched: Sequence[str], snapshot_dts: str) -> DataFrame:
    """OFFERED and WITHDRAWN rows between two (type, value) snapshots.

    ``fetched`` names the types this snapshot asked for, because a type without values
    leaves no row to say so; such a type is refused and not compared, or every value it had
    would read as withdrawn. For the same reason a type with a blank value on either side is refused: a blank one
    before would read as withdrawn as well. Types that were not fetched are left alone.
    """
    spark = cur.sparkSession
    asked = spark.createDataFrame([(t,) for t in sorted(set(fetched))], "type string")
    now = cur.select("type", F.col("value").cast("string").alias("value")).distinct()
    before = prev.select("type", F.col("value").cast("string").alias("value")).distinct()
    sides = now.withColumn("_now", F.lit(True)).unionByName(before.withColumn("_now", F.lit(False)))
    blanks = sides.where(strip("value") == "").groupBy("type").agg(F.max("_now").alias("_blank"))
    sized = now.groupBy("type").agg(F.count(F.lit(1)).alias("_n"))
    verdict = asked.join(sized, "type", "left").join(blanks, "type", "left")
    refused = verdict.where("_n IS NULL OR _blank IS NOT NULL").select(
        "type", F.lit(None).cast("string").alias("value"), F.lit("REFUSED").alias("reference_status"),
        F.when(F.col("_n").isNull(), "no values").when(F.col("_blank"), "blank value").otherwise("blank value before").alias("reason"))
    usable = verdict.where("_n IS NOT NULL AND _blank IS NULL").select("type")
    both = now.withColumn("_now", F.lit(True)).join(before.withColumn("_was", F.lit(True)), ["type", "value"], "full_outer")
    moved = (both.where("_now IS NULL OR _was IS NULL").join(usable, "type", "left_semi")
             .select("type", "value", F.when(F.col("_was").isNull(), "OFFERED").otherwise("WITHDRAWN").alias("reference_status"),
                     F.lit(None).cast("string").alias("reason")))
    return moved.unionByName(refused).withColumn("effective_from", F.lit(snapshot_dts).cast("timestamp"))
