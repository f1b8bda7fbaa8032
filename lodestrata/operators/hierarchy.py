"""Dated parent-child edges: the parent on a date, roll-up keys, overlap of two relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.rules import strip
from lodestrata.operators.ordered import ordered_scan

WIDE = "decimal(38,0)"


def parent_as_of(edges: DataFrame, questions: DataFrame, child: str = "child", when: str = "when",
                 points="probe") -> DataFrame:
    """Each distinct (child, date) asked, both present, with the parent then and a status.

    Edges are (child, parent, from, to), half-open, NULL for open ends. Status is
    ``backwards`` when any edge of the child ends before it starts, ``none``, ``ambiguous``,
    ``blank_parent`` or ``ok``.

    Starts, ends and questions are swept in date order with running counts, instead of
    pairing every question with every edge of its child: a child with many edges and many
    questions costs their sum, not their product. While one edge is open, the running sum
    of its parent's digests identifies that parent.
    """
    ids = [F.xxhash64("parent").cast(WIDE).alias("_id1"), F.xxhash64("parent", F.lit(1)).cast(WIDE).alias("_id2")]
    e = edges.select("child", "parent", "from", "to", *ids,
                     F.coalesce(F.col("from") > F.col("to"), F.lit(False)).alias("_back"))
    good, zero = e.where("not _back"), F.lit(0).cast(WIDE)
    starts = good.select("child", F.col("from").alias("_at"), F.lit(1).alias("_open"), "_id1", "_id2", F.lit(0).alias("_b"))
    ends = good.where("to IS NOT NULL").select(
        "child", F.col("to").alias("_at"), F.lit(-1).alias("_open"), (-F.col("_id1")).cast(WIDE).alias("_id1"),
        (-F.col("_id2")).cast(WIDE).alias("_id2"), F.lit(0).alias("_b"))
    bad = e.where("_back").select(
        "child", F.lit(None).cast(e.schema["from"].dataType).alias("_at"), F.lit(0).alias("_open"),
        zero.alias("_id1"), zero.alias("_id2"), F.lit(1).alias("_b"))
    marks = (starts.unionByName(ends).unionByName(bad).groupBy("child", "_at")
             .agg(F.sum("_open").alias("_open"), F.sum("_id1").cast(WIDE).alias("_id1"),
                  F.sum("_id2").cast(WIDE).alias("_id2"), F.sum("_b").alias("_b"))
             .withColumn("_asked", F.lit(0)))
    asked = questions.select(F.col(child).alias("child"), F.col(when).alias("_at")).where("child IS NOT NULL AND _at IS NOT NULL").distinct().select(
        "child", "_at", F.lit(0).cast("long").alias("_open"), zero.alias("_id1"), zero.alias("_id2"),
        F.lit(0).cast("long").alias("_b"), F.lit(1).alias("_asked"))
    # An edge leaves at most two marks, a question one.
    once = edges.select("child")
    bound = once.unionByName(once).unionByName(questions.select(F.col(child).alias("child")))
    swept = ordered_scan(marks.unionByName(asked), ["child"], ["_at", "_asked"], points=points, probe_on=bound, sums={
        "_n": F.col("_open"), "_p1": F.col("_id1"), "_p2": F.col("_id2"), "_backs": F.col("_b")})
    answers = swept.where("_asked = 1")
    names = e.groupBy(F.col("child").alias("_child"), F.col("_id1").alias("_i1"), F.col("_id2").alias("_i2")).agg(
        F.min("parent").alias("_parent"))
    one = answers["_n"] == 1
    found = answers.join(names, one & (answers["child"] == names["_child"]) & (answers["_p1"] == names["_i1"])
                         & (answers["_p2"] == names["_i2"]), "left")
    status = (F.when(F.col("_backs") > 0, "backwards").when(F.col("_n") == 0, "none")
              .when(F.col("_n") > 1, "ambiguous").when(strip("_parent") == "", "blank_parent").otherwise("ok"))
    return found.select(F.col("child").alias(child), F.col("_at").alias(when),
                        F.when(status == "ok", F.col("_parent")).alias("parent"), status.alias("status"))


def rollup(edges: DataFrame, facts: DataFrame, child: str, when: str, points="probe") -> DataFrame:
    """Facts with ``rollup_key``: the parent on the fact's date, else the child itself."""
    found = parent_as_of(edges, facts, child, when, points).select(
        F.col(child).alias("_c"), F.col(when).alias("_w"), "parent", F.col("status").alias("parent_status"))
    out = facts.join(found, (facts[child] == found["_c"]) & (facts[when] == found["_w"]), "left")
    # Every child and date has an answer; only a missing child or date has none.
    out = out.drop("_c", "_w").withColumn("parent_status", F.coalesce("parent_status", F.lit("none")))
    usable = F.col("parent_status").isin("ok", "none")
    return out.withColumn(
        "rollup_key", F.when(usable, F.coalesce("parent", F.col(child).cast("string"))))


def rollup_sums(edges: DataFrame, facts: DataFrame, child: str, when: str, sums: Sequence[str], points="probe") -> DataFrame:
    """``rollup`` summed by rollup_key and parent_status. Facts are summed per child and date before they meet the
    edges, so what is asked and joined is one row for each of these."""
    daily = facts.groupBy(child, when).agg(F.count(F.lit(1)).alias("fact_count"), *[F.sum(c).alias(c) for c in sums])
    return rollup(edges, daily, child, when, points).groupBy("rollup_key", "parent_status").agg(
        F.sum("fact_count").alias("fact_count"), *[F.sum(c).alias(c) for c in sums])


def edge_overlap(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("child", "parent")) -> DataFrame:
    """Edges two relations both state."""
    return a.select(*cols).intersect(b.select(*cols))
