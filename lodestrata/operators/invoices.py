"""Invoice release and export checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.rules import strip
from lodestrata.operators.ordered import first_per_key


def invoice_release(lines: DataFrame, invoices: DataFrame, key: Sequence[str], amount: str, gross: str) -> DataFrame:
    """Per invoice, whether its lines sum exactly to its one gross value, and if not why.

    Decimal equality without a tolerance. An invoice without lines is never released, nor one with a line whose
    amount is missing. A missing gross value is a value of its own beside any other.
    """
    sums = lines.groupBy(*key).agg(F.sum(amount).alias("line_total"), F.count(F.lit(1)).alias("line_count"), F.count(amount).alias("_amounts"))
    missing = F.max(F.when(F.col(gross).isNull(), 1).otherwise(0))
    heads = invoices.groupBy(*key).agg((F.countDistinct(gross) + missing).alias("gross_values"), F.min(gross).alias("gross"))
    out = heads.join(sums, list(key), "left").na.fill(0, ["line_count"])
    reason = (F.when(F.col("line_count") == 0, "no lines").when(F.col("gross_values") > 1, "several gross values")
              .when(F.col("gross").isNull(), "no gross value").when(F.col("_amounts") == 0, "no line amounts")
              .when(F.col("_amounts") < F.col("line_count"), "a line without an amount")
              .when(F.col("line_total") != F.col("gross"), "lines do not sum to gross"))
    return out.withColumns({"reason": reason, "released": reason.isNull()}).drop("_amounts")


def join_findings(headers: DataFrame, lines: DataFrame, invoice: str, line_ref: str) -> DataFrame:
    """What keeps header and line files from joining: one row per (finding, invoice, line). Each side is counted
    once and the two meet in one join."""
    def listed(df, *found):
        """found: (condition, finding, row count, line reference)"""
        each = F.array(*[F.when(F.expr(c), F.struct(F.lit(name).alias("finding"), F.col("_inv").alias("invoice"), F.expr(ref).cast("string").alias("line_reference"),
                                                    F.expr(n).cast("long").alias("row_count"))) for c, name, n, ref in found])
        return df.select(F.inline(F.array_compact(each)))

    heads = headers.select(strip(invoice).alias("_inv")).groupBy("_inv").agg(F.count(F.lit(1)).alias("_heads"))
    refs = (lines.select(strip(invoice).alias("_inv"), strip(line_ref).alias("_ref"))
            .groupBy("_inv", "_ref").agg(F.count(F.lit(1)).alias("_n")))
    sums = refs.groupBy("_inv").agg(F.sum("_n").alias("_lines"), F.sum(F.when(F.col("_ref") != "", F.col("_n"))).alias("_named"))
    both = heads.join(sums, "_inv", "full_outer")
    return listed(
        both, ("_inv = '' AND _heads > 0", "HEADER_WITHOUT_ID", "_heads", "null"), ("_inv <> '' AND _heads > 1", "DUPLICATE_HEADER", "_heads", "null"),
        ("_inv <> '' AND _heads IS NULL", "ORPHAN_LINE", "_lines", "null"),
        ("_inv <> '' AND _heads > 0 AND _named IS NULL", "HEADER_WITHOUT_LINES", "1", "null")).unionByName(listed(
            refs, ("_inv = ''", "LINE_WITHOUT_ID", "_n", "_ref"), ("_ref = ''", "BLANK_LINE_REFERENCE", "_n", "null"),
            ("_ref <> '' AND _n > 1", "DUPLICATE_LINE_REFERENCE", "_n", "_ref")))


def gate_findings(headers: DataFrame, lines: DataFrame, ledger: DataFrame, invoice: str, line_ref: str, amount: str, gross: str,
                  required: Sequence[str]) -> DataFrame:
    """Everything that keeps invoices from being exported, as (finding, invoice, line_reference, row_count): files
    that do not join, blank required fields of a line, lines the ledger has not issued, sums that are not the gross."""
    line = [strip(invoice).alias("invoice"), strip(line_ref).alias("line_reference")]
    blank = F.array_compact(F.array(*[F.when(strip(c) == "", F.lit(c)) for c in required]))
    missing = (lines.select(*line, F.explode(blank).alias("_field")).groupBy("_field", "invoice", "line_reference").agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.concat(F.lit("MISSING_FIELD: "), "_field").alias("finding"), "invoice", "line_reference", "row_count"))
    held = ledger.select(strip(invoice).alias("invoice"), strip(line_ref).alias("line_reference")).distinct()
    open_ = (lines.select(*line).groupBy("invoice", "line_reference").agg(F.count(F.lit(1)).alias("row_count")).join(held, ["invoice", "line_reference"], "left_anti")
             .select(F.lit("NOT_ISSUED").alias("finding"), "invoice", "line_reference", "row_count"))
    named = [df.withColumn("_inv", strip(invoice)).drop(invoice) for df in (lines, headers)]
    kept = invoice_release(*named, ["_inv"], amount, gross).where("NOT released").select(
        F.concat(F.lit("NOT_RELEASED: "), "reason").alias("finding"), F.col("_inv").alias("invoice"), F.lit(None).cast("string").alias("line_reference"),
        F.col("line_count").alias("row_count"))
    return join_findings(headers, lines, invoice, line_ref).unionByName(missing).unionByName(open_).unionByName(kept)


def refuse_unreleased(findings: DataFrame) -> None:
    """Before an export: raises with some of the findings, if there are any."""
    some = findings.orderBy("finding", "invoice", "line_reference").limit(5).collect()
    if some:
        raise ValueError(f"not to be exported: {[(r['finding'], r['invoice'], r['line_reference']) for r in some]}")


def one_per_invoice(lines: DataFrame, key: Sequence[str], line_ref: str) -> tuple[DataFrame, DataFrame]:
    """(one row per invoice, refused rows): the first line by reference stands for its invoice;
    a NULL or blank key would gather unrelated lines and is refused."""
    blank = F.lit(False)
    for c in key:
        blank = blank | (strip(c) == "")
    return first_per_key(lines.where(~blank), key, line_ref), lines.where(blank)


def star(computed: DataFrame, lines: DataFrame, hub: DataFrame, line_hk: str, hub_hk: str) -> DataFrame:
    """Current computed values with their line and the line's hub."""
    newest = first_per_key(computed, [line_hk], F.desc("load_dts"), F.desc("sub_seq")).drop("load_dts", "sub_seq")
    return newest.join(lines, line_hk).join(hub, hub_hk)


def with_ledger(lines: DataFrame, ledger: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Lines with their issued number; an unissued line stays and says so."""
    out = lines.join(ledger, list(grain), "left")
    return out.withColumn("issuance", F.when(F.col("line_number").isNull(), "not issued").otherwise("issued"))
