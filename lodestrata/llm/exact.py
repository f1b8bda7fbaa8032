"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import saved, sieve, sifted

# Code points of the normalised text that the prefix hash covers.
PREFIX = 256
BLANKS = " \t\n\x0b\x0c\r"


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def exact_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", hash_all: bool = False) -> DataFrame:
    """doc, digest, keep, group_size and kept of every row; texts are equal when equal without white space.

    Lengths that occur once are decided first, then (length, prefix hash) pairs that occur once. Only rows of
    the surviving pairs have their whole text hashed (``hash_all`` hashes the others too, for callers that want
    the digest); their group is that of the full hash. The survivors' pairs go out as a sieve of bounded size,
    so no text is shuffled. Of a group the row with the most code points stays, then the smallest id (null
    last), then any one of wholly equal rows. ``digest`` is null where it was not needed.
    """
    norm = squeezed(F.col("_text"))
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).cast("string").alias("_text")).withColumn("_norm", norm)
    rows = rows.withColumn("_size", F.length("_norm")).withColumn("_pair", F.xxhash64("_size", F.substring("_norm", 1, PREFIX)))

    pairs = saved(rows.groupBy("_size", "_pair").agg(F.count(F.lit(1)).alias("_n")), "pairs")
    sizes = pairs.groupBy("_size").agg(F.sum("_n").alias("_of_size")).where("_of_size > 1")
    shared = saved(pairs.join(sizes, "_size").where("_n > 1").select("_pair"), "shared-pairs")

    wanted = F.col("_survives") | F.lit(hash_all)
    hashed = sifted(rows, "_pair", sieve(shared, "_pair"), "_survives").select(
        "doc", F.length(F.coalesce("_text", F.lit(""))).alias("_chars"), "_survives",
        F.when(wanted, F.sha2("_norm", 256)).alias("digest"), F.monotonically_increasing_id().alias("_row"))
    hashed = saved(hashed, "hashed")

    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("doc").isNull().alias("n"), "doc", "_row"))
    groups = (hashed.where("_survives").groupBy("digest").agg(best.alias("_best"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1").select(F.col("digest").alias("_d"), F.col("_best.doc").alias("_keep"), F.col("_best._row").alias("_keep_row"), "_n"))
    groups = saved(groups, "groups")
    alone = F.col("_n").isNull()
    return (hashed.join(groups, hashed["digest"] == groups["_d"], "left")
            .select("doc", "digest", F.when(alone, F.col("doc")).otherwise(F.col("_keep")).alias("keep"),
                    F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept")))
