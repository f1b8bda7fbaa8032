"""Running values and neighbours within a key that hold up when one key is very large.

A window keeps a whole key in one task. ``ordered_scan`` uses that plan while every key is
small, and otherwise cuts the large keys into chunks at points of their own order: windows
run per (key, chunk), and one summary row per chunk carries totals and edge values across
the cuts. A key is large above ``FLOOR`` rows, the most that one task is to sort, however many
rows there are in all. The choice is one of plan only: both give the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOOR = 10_000_000
PROBE = 0.01
POINTS_PER_CHUNK = 40
STRIDE = 64


def same(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str = "",
         nullable: Sequence[str] | None = None) -> Column:
    """Equality of the named columns of two frames, null-safe for the ``nullable`` ones (all
    by default). Plain equality lets a join use the partitioning its input already has."""
    null_safe = names if nullable is None else nullable
    return reduce(lambda a, b: a & b, [
        left[n].eqNullSafe(right[prefix + n]) if n in null_safe else left[n] == right[prefix + n]
        for n in names])


def large_keys(df: DataFrame, keys: Sequence[str], *, floor: int = FLOOR, probe: float = PROBE) -> tuple[DataFrame | None, float]:
    """(keys above ``floor`` rows or None, that many rows).

    Counted on a sample, which decides on a plan and on no row. There is one such key in
    ``floor`` rows at most, so they are collected and rebuilt as literals, prefixed ``_k_``.
    """
    sampled = df.select(*keys).sample(probe, 7) if probe < 1 else df.select(*keys)
    counts = sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > floor * probe)
    rows = counts.select(*keys).collect()
    return (literal_rows(df, rows, keys) if rows else None), floor


def literal_rows(df: DataFrame, rows: list[Row], keys: Sequence[str], *more: T.StructField) -> DataFrame:
    fields = [T.StructField("_k_" + f.name, f.dataType) for f in df.select(*keys).schema]
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], T.StructType([*fields, *more]))


def split_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, floor: int = FLOOR, probe: float = PROBE,
                 known: tuple[DataFrame | None, float] | None = None) -> DataFrame | None:
    """Cut points of the large keys in their own order, or None when no key is large.

    ``known`` is what ``large_keys`` found, where it was asked before. The points come from a sample of the large keys' rows, about ``POINTS_PER_CHUNK`` per
    chunk to be cut off, of which the last becomes a cut.
    """
    large, chunk_rows = known or large_keys(df, keys, floor=floor, probe=probe)
    if large is None:
        return None
    rows = df.select(*keys, F.struct(*order).alias("_at"))
    if chunk_rows > POINTS_PER_CHUNK:
        rows = rows.sample(POINTS_PER_CHUNK / chunk_rows, 11)
    cuts = (rows.join(F.broadcast(large), same(rows, large, keys, "_k_"), "left_semi")
            .groupBy(*keys).agg(F.array_sort(F.collect_list("_at")).alias("_all"))
            .select(*keys, F.expr(f"filter(_all, (x, i) -> i > 0 AND i % {POINTS_PER_CHUNK} = 0)").alias("_cuts"))
            .where(F.size("_cuts") > 0))
    found = cuts.collect()
    if not found:
        return None
    # Sorted once more: clocks can lose their order on the way through the driver's time zone.
    return literal_rows(df, found, keys, T.StructField("_cuts", cuts.schema["_cuts"].dataType)).withColumn(
        "_cuts", F.array_sort("_cuts"))


def chunk_number(at: Column) -> Column:
    """How many of a key's ``_cuts`` lie at or before a row: the block first, then within it."""
    firsts = F.expr(f"filter(_cuts, (x, i) -> i % {STRIDE} = 0)")
    block = F.size(F.filter(firsts, lambda p: p <= at)) - 1
    inside = F.slice("_cuts", F.greatest(block, F.lit(0)) * STRIDE + 1, F.lit(STRIDE))
    return F.when(block < 0, 0).otherwise(block * STRIDE + F.size(F.filter(inside, lambda p: p <= at)))


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                 sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None,
                 prev: dict[str, Column] | None = None, following: dict[str, Column] | None = None,
                 points: DataFrame | None | str = "probe", probe_on: DataFrame | None = None) -> DataFrame:
    """Adds, per key and in ascending ``order``: running sums and maxima up to and with the
    row, values of the row before, and values of the row after.

    ``order`` must tell the rows of a key apart as far as the values asked for differ.
    ``probe_on`` is a frame that is cheaper to read and holds each key at least as often;
    when no key is large there, none is large here.
    """
    sums, maxima, prev, following = sums or {}, maxima or {}, prev or {}, following or {}
    if isinstance(points, str):
        small = probe_on is not None and large_keys(probe_on, keys)[0] is None
        points = None if small else split_points(df, keys, order)
    if points is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(
            "*",
            *[F.sum(c).over(upto).alias(n) for n, c in sums.items()],
            *[F.max(c).over(upto).alias(n) for n, c in maxima.items()],
            *[F.lag(c).over(w).alias(n) for n, c in prev.items()],
            *[F.lead(c).over(w).alias(n) for n, c in following.items()])

    at = F.struct(*order)
    cut = (df.join(F.broadcast(points), same(df, points, keys, "_k_"), "left")
           .withColumn("_cut", F.col("_cuts").isNotNull())
           .withColumn("_chunk", F.when(F.col("_cut"), chunk_number(at)).otherwise(0)))
    base = cut.select(*df.columns, "_cut", "_chunk",
                      *[c.alias("_s_" + n) for n, c in sums.items()],
                      *[c.alias("_m_" + n) for n, c in maxima.items()],
                      F.struct(F.lit(True).alias("_"), *[c.alias(n) for n, c in prev.items()]).alias("_p"),
                      F.struct(F.lit(True).alias("_"), *[c.alias(n) for n, c in following.items()]).alias("_f"))

    # One row per chunk of a cut key: its totals, last and first values.
    per_chunk = base.where("_cut").groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum("_s_" + n).alias("_s_" + n) for n in sums],
        *[F.max("_m_" + n).alias("_m_" + n) for n in maxima],
        F.max_by("_p", at).alias("_last"), F.min_by("_f", at).alias("_first"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        *[F.col(k).alias("_c_" + k) for k in keys], F.col("_chunk").alias("_c__chunk"),
        *[F.sum("_s_" + n).over(before).alias("_cs_" + n) for n in sums],
        *[F.max("_m_" + n).over(before).alias("_cm_" + n) for n in maxima],
        F.lag("_last").over(across).alias("_cp"), F.lead("_first").over(across).alias("_cf"))

    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.select(
        *df.columns, "_chunk",
        *[F.sum("_s_" + n).over(upto).alias("_ls_" + n) for n in sums],
        *[F.max("_m_" + n).over(upto).alias("_lm_" + n) for n in maxima],
        F.lag("_p").over(w).alias("_lp"), F.lead("_f").over(w).alias("_lf"))
    joined = local.join(carry, same(local, carry, [*keys, "_chunk"], "_c_"), "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_cs_" + n).isNull(), F.col("_ls_" + n)).otherwise(
            F.coalesce("_ls_" + n, F.lit(0)) + F.col("_cs_" + n)).alias(n) for n in sums],
        *[F.greatest("_lm_" + n, "_cm_" + n).alias(n) for n in maxima],
        *[F.coalesce("_lp", "_cp")[n].alias(n) for n in prev],
        *[F.coalesce("_lf", "_cf")[n].alias(n) for n in following])


def total_order(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Sort keys that tell apart all rows that differ in the named columns, whatever their types."""
    def key(name: str) -> Column:
        kind = df.schema[name].dataType.simpleString()
        return F.to_json(F.struct(F.col(f"`{name}`").alias("v"))) if re.search("map<|variant|interval", kind) else F.col(f"`{name}`")
    return [key(n) for n in names]


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each map task to its own first row per key before the shuffle, so a large
    key costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
