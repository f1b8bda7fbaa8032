"""The issuance ledger: line numbers that never change and invoice dates that stay frozen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.rules import strip
from lodestrata.operators.ordered import ordered_scan, same


def unissued(lines: DataFrame, ledger: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Lines the ledger does not hold at its grain."""
    return lines.join(ledger.select(*grain).distinct(), list(grain), "left_anti")


def invoice_verdicts(lines: DataFrame, ledger: DataFrame, invoice: Sequence[str], ref: str, date: str) -> DataFrame:
    """Per invoice: the date it carries, the highest number issued, and why it is refused.

    All inputs are aggregated per invoice before they meet.
    """
    per_ref = lines.groupBy(*invoice, ref).agg(
        F.count(F.lit(1)).alias("_n"), F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    offered = per_ref.groupBy(*invoice).agg(
        F.max("_n").alias("_copies"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.max(strip(ref) == "").alias("_unnamed"))
    issued = ledger.groupBy(*[F.col(c).alias("_i_" + c) for c in invoice]).agg(
        F.max("line_number").alias("last_number"), F.min("invoice_date").alias("_first"),
        F.max("invoice_date").alias("_final"))
    out = offered.join(issued, same(offered, issued, invoice, "_i_", ()), "left")
    blank = reduce(lambda a, b: a | b, [strip(c) == "" for c in invoice])
    refusal = (
        F.when(blank, "blank invoice key").when(F.col("_unnamed"), "blank line reference").when(F.col("_copies") > 1, "duplicate line reference")
        .when(F.col("_first") != F.col("_final"), "several issued dates")
        .when(F.col("_first").isNull() & (F.col("_lo") != F.col("_hi")), "several supplied dates")
        .when(F.col("_first").isNotNull() & ((F.col("_lo") != F.col("_first")) | (F.col("_hi") != F.col("_first"))),
              "supplied date differs from the issued date")
        .when(F.coalesce("_first", "_lo").isNull(), "no invoice date"))
    return out.select(*invoice, F.coalesce("_first", "_lo").alias("frozen_date"),
                      F.coalesce("last_number", F.lit(0)).alias("last_number"), refusal.alias("refusal"))


def issue_lines(lines: DataFrame, ledger: DataFrame, invoice: Sequence[str], ref: str, date: str,
                points="probe") -> DataFrame:
    """Ledger rows to append: unissued lines numbered on from the highest issued number.

    Issued lines keep their numbers; a refused invoice issues nothing.
    """
    verdicts = invoice_verdicts(lines, ledger, invoice, ref, date).where("refusal IS NULL")
    held = ledger.select(*[F.col(c).alias("_h_" + c) for c in invoice], F.col("line_reference").alias("_h_ref"))
    todo = lines.select(*invoice, ref).join(
        held, same(lines, held, invoice, "_h_", ()) & (lines[ref] == held["_h_ref"]), "left_anti")
    v = verdicts.select(*[F.col(c).alias("_v_" + c) for c in invoice], "frozen_date", "last_number")
    allowed = todo.join(v, same(todo, v, invoice, "_v_", ())).select(*invoice, ref, "frozen_date", "last_number")
    numbered = ordered_scan(allowed, invoice, [ref], sums={"_n": F.lit(1)}, points=points, probe_on=lines)
    return numbered.select(*invoice, F.col(ref).alias("line_reference"),
                           (F.col("last_number") + F.col("_n")).cast("int").alias("line_number"),
                           F.col("frozen_date").alias("invoice_date"))
