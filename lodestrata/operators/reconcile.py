"""Reconciliation: balances, roll-ups, manifests, landing, supersedes, keys and schemas.

Every operator aggregates each side to its grain before the sides meet, and returns what
disagrees (or a three-valued verdict) as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.keys import row_digest, zero_key
from lodestrata.operators.dedup import distinct_keys
from lodestrata.operators.history import current

# Tolerances in currency units, and the end of the ghost row's day.
BALANCE_TOLERANCE = "0.005"
ROLLUP_TOLERANCE = "0.05"
AFTER_GHOST = "1900-01-02 00:00:00"
GHOST_SOURCE = "SYSTEM"
PASSED, FAILED, NOT_EVALUATED = "PASSED", "FAILED", "NOT_EVALUATED"


def _tolerance(value: str) -> Column:
    return F.lit(value).cast("decimal(18,3)")


def _zero(c: str) -> Column:
    return F.coalesce(c, F.lit(0))


def count_rows(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


# Journals


def without_ghost(df: DataFrame) -> DataFrame:
    """A vault table without the zero-key row that ``Vault.load`` starts it with; other frames as they are."""
    return df.where(F.coalesce(F.col("rec_src") != GHOST_SOURCE, F.lit(True))) if "rec_src" in df.columns else df


def unbalanced(lines: DataFrame, journal: str, debit: str, credit: str, tol: str = BALANCE_TOLERANCE) -> DataFrame:
    sums = without_ghost(lines).groupBy(journal).agg(F.sum(debit).alias("debit"), F.sum(credit).alias("credit"),
                                      F.count(F.lit(1)).alias("line_count"))
    gap = _zero("debit") - _zero("credit")
    return sums.withColumn("difference", gap).where(F.abs(gap) > _tolerance(tol))


def control_totals(lines: DataFrame, headers: DataFrame, journal: str, debit: str, credit: str, total: str,
                   tol: str = BALANCE_TOLERANCE) -> DataFrame:
    """Journals whose current header's control total is not half of debits plus credits."""
    head = current(without_ghost(headers).select(journal, total, "load_dts", "sub_seq"), journal).where(F.col(total).isNotNull())
    sums = without_ghost(lines).groupBy(journal).agg(
        (F.sum(F.coalesce(debit, F.lit(0)) + F.coalesce(credit, F.lit(0))) / 2).alias("half_turnover"))
    return (sums.join(head.select(journal, total), journal)
            .where(F.abs(F.col(total) - F.col("half_turnover")) > _tolerance(tol)))


def line_gaps(lines: DataFrame, journal: str, order_col: str) -> DataFrame:
    """Journals whose line numbers repeat, leave gaps or are missing. Numbers may be text; what is no number
    counts as missing. The ghost is no line."""
    number = F.col(order_col).try_cast("int")
    return (without_ghost(lines).groupBy(journal).agg(
        F.count(F.lit(1)).alias("line_count"), F.countDistinct(number).alias("distinct_numbers"), F.max(number).alias("highest"))
        .where("line_count <> distinct_numbers OR coalesce(highest, 0) <> line_count"))


def violations(df: DataFrame, condition: Column, order: Sequence[str], sample: int = 25) -> DataFrame:
    """The number of violating rows beside a bounded, ordered sample of them."""
    bad = df.where(condition)
    return bad.orderBy(*order).limit(sample).withColumn("violations", bad.agg(F.count(F.lit(1))).scalar())


def orphan_lines(lines: DataFrame, parents: DataFrame, hk: str) -> DataFrame:
    return lines.join(parents.select(hk).distinct(), hk, "left_anti")


def ghost_parents(lines: DataFrame, hks: Sequence[str]) -> DataFrame:
    """Per parent key: rows, and rows that resolve to the zero key."""
    return lines.agg(F.count(F.lit(1)).alias("line_count"), F.array(*[F.struct(
        F.lit(h).alias("parent"), F.coalesce(F.sum(F.when(F.col(h) == zero_key(), 1)), F.lit(0)).alias("ghosts"))
        for h in hks]).alias("a")).select("line_count", F.inline("a"))


# Aggregate against detail


def rollup_detail(detail: DataFrame, classification: DataFrame, key: str, by: Sequence[str], amount: str) -> DataFrame:
    """Detail with its current classification, summed to (account, period)."""
    return detail.join(classification, key).groupBy(*by).agg(F.sum(amount).alias("detail_amount"))


def compare_buckets(journal: DataFrame, detail: DataFrame, by: Sequence[str], tol: str = ROLLUP_TOLERANCE) -> DataFrame:
    """Journal buckets whose detail is missing or off by more than the tolerance."""
    out = journal.join(detail, list(by), "left")
    gap = F.col("journal_amount") - _zero("detail_amount")
    return out.withColumn("difference", gap).where(F.col("detail_amount").isNull() | (F.abs(gap) > _tolerance(tol)))


def orphan_buckets(journal: DataFrame, detail: DataFrame, by: Sequence[str]) -> DataFrame:
    return detail.join(journal.select(*by).distinct(), list(by), "left_anti")


def reconcile_aggregate(detail: DataFrame, classification: DataFrame, journal: DataFrame, key: str,
                        by: Sequence[str], amount: str, journal_amount: str, tol: str = ROLLUP_TOLERANCE) -> DataFrame:
    """All disagreements of two ledgers in one report: both sides are rolled up to their
    buckets and met once in a full outer join."""
    d = rollup_detail(detail, classification, key, by, amount)
    j = journal.groupBy(*by).agg(F.sum(journal_amount).alias("journal_amount"))
    both = j.join(d, list(by), "full_outer")
    gap = _zero("journal_amount") - _zero("detail_amount")
    finding = (F.when(F.col("journal_amount").isNull(), "ORPHAN_DETAIL")
               .when(F.col("detail_amount").isNull(), "NO_DETAIL")
               .when(F.abs(gap) > _tolerance(tol), "VARIANCE"))
    return both.withColumns({"difference": gap, "finding": finding}).where("finding IS NOT NULL")


# Manifests


def manifest_counts(manifest: DataFrame, landed: DataFrame, rejected: DataFrame, superseded: DataFrame) -> DataFrame:
    """Counts of every approved manifest side by side."""
    def n(df, name):
        return count_rows(df.where("manifest_id IS NOT NULL"), ["manifest_id"], name)
    out = manifest.select("manifest_id", "approved_count")
    for frame, name in ((landed, "landed"), (rejected, "quarantined"), (superseded, "superseded")):
        out = out.join(n(frame, name), "manifest_id", "left")
    return out.na.fill(0, ["landed", "quarantined", "superseded"])


def manifest_identity(manifest: DataFrame, landed: DataFrame, rejected: DataFrame, superseded: DataFrame,
                      only_violations: bool = True) -> DataFrame:
    """approved = landed + (quarantined - superseded); holds for links, which drop no row."""
    out = manifest_counts(manifest, landed, rejected, superseded)
    variance = F.col("landed") + F.col("quarantined") - F.col("superseded") - F.col("approved_count")
    out = out.withColumn("variance", variance)
    return out.where("variance <> 0") if only_violations else out


def superseded_against_rejected(rejected: DataFrame, superseded: DataFrame) -> DataFrame:
    r = count_rows(rejected, ["manifest_id"], "quarantined")
    s = count_rows(superseded, ["manifest_id"], "superseded").withColumnRenamed("manifest_id", "_m")
    return r.join(s, r.manifest_id.eqNullSafe(s["_m"]), "full_outer").select(
        F.coalesce("manifest_id", "_m").alias("manifest_id"), _zero("quarantined").alias("quarantined"),
        _zero("superseded").alias("superseded"))


def over_subtracted(rejected: DataFrame, superseded: DataFrame) -> DataFrame:
    """Manifests that supersede more than they quarantined, which would hide a variance."""
    return superseded_against_rejected(rejected, superseded).where("superseded > quarantined")


def unaccounted(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows whose manifest is NULL or unknown, counted per manifest."""
    per = count_rows(rows, ["manifest_id"], "row_count")
    return per.join(manifest.select("manifest_id").distinct(), "manifest_id", "left_anti")


def expected_keys(feed: DataFrame, dedup_by: Sequence[str], repeated: Sequence[int] | None = None) -> DataFrame:
    """Distinct source keys; NULL and absent parts stay apart from each other. ``repeated`` as for ``distinct_keys``."""
    return distinct_keys(feed, dedup_by, repeated).agg(F.count(F.lit(1)).alias("expected"))


def landing_variance(feed: DataFrame, dedup_by: Sequence[str], landed: DataFrame, hk: str,
                     quarantined: DataFrame, superseded: DataFrame, repeated_in_feed: Sequence[int] | None = None,
                     repeated_landed: Sequence[int] | None = None) -> DataFrame:
    """Signed difference between the keys the feed holds and those that arrived somewhere. Where ``repeated_hashes``
    of the feed's keys or of the landed ones (or of the log they come from) are known, keys that come once are counted
    without a shuffle."""
    def n(df):
        return df.agg(F.count(F.lit(1))).scalar()
    real = landed.where(F.col("load_dts") > F.lit(AFTER_GHOST).cast("timestamp"))
    out = expected_keys(feed, dedup_by, repeated_in_feed).withColumns({
        "landed": n(distinct_keys(real, [hk], repeated_landed)), "quarantined": n(quarantined), "superseded": n(superseded)})
    variance = F.col("expected") - (F.col("landed") + F.col("quarantined") - F.col("superseded"))
    return out.withColumn("variance", variance).withColumn(
        "status", F.when(F.col("expected") == 0, NOT_EVALUATED).when(variance == 0, PASSED).otherwise(FAILED))


# Supersedes


def digest_counts(rows: DataFrame, cols: Sequence[str], hk_cols: Sequence[str], name: str) -> DataFrame:
    """Rows per (manifest, content digest)."""
    return count_rows(rows.select("manifest_id", row_digest(cols, hk_cols).alias("digest")),
                      ["manifest_id", "digest"], name)


def current_records(recorded: DataFrame, rulebook: str) -> DataFrame:
    """Supersede records per (manifest, digest) with those of another rulebook counted apart,
    because their digests cannot be compared."""
    ours = F.col("rulebook_version") == rulebook
    return recorded.groupBy("manifest_id", "digest").agg(
        F.coalesce(F.sum(F.when(ours, 1)), F.lit(0)).alias("recorded"),
        F.coalesce(F.sum(F.when(ours, 0).otherwise(1)), F.lit(0)).alias("stale"))


def _by_digest(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    r = right.withColumnsRenamed({"manifest_id": "_m", "digest": "_d"})
    return left.join(r, left.manifest_id.eqNullSafe(r["_m"]) & (left.digest == r["_d"]), how).drop("_m", "_d")


def supersede_shortfall(landed: DataFrame, quarantined: DataFrame, recorded: DataFrame) -> DataFrame:
    """Supersede records still to write: min(landed, quarantined) less what is on record."""
    out = _by_digest(_by_digest(quarantined, landed, "inner"), recorded, "left")
    short = F.least("landed", "quarantined") - _zero("recorded")
    return out.select("manifest_id", "digest", short.alias("shortfall")).where("shortfall > 0")


def orphaned_records(recorded: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Supersede records that outnumber the rejects they account for."""
    out = _by_digest(recorded, quarantined, "left").withColumn("quarantined", _zero("quarantined"))
    return out.where("recorded > quarantined").select("manifest_id", "digest", "recorded", "quarantined")


# Keys and schemas


def key_diff(df: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per key column: rows, distinct stored keys, rows whose key moves under the new rule."""
    cols = [F.struct(F.lit(n).alias("key_name"), old.alias("old_key"), new.alias("new_key")) for n, (old, new) in keys.items()]
    per = (df.select(F.explode(F.array(*cols)).alias("k")).select("k.*")
           .groupBy("key_name", "old_key", "new_key").agg(F.count(F.lit(1)).alias("n")))
    moved = ~F.col("old_key").eqNullSafe(F.col("new_key"))
    out = per.groupBy("key_name").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(moved, F.col("n"))), F.lit(0)).alias("rows_moved"),
        F.coalesce(F.sum(F.when(moved, 1)), F.lit(0)).alias("keys_moved"))
    return out.withColumn("verdict", F.when(F.col("rows_moved") > 0, "RE_KEYED").otherwise("MATCHED"))


def derivation_verdict(records: DataFrame) -> DataFrame:
    """State of each recorded key derivation.

    ``records`` has one row per target: stored_digest, current_digest, stored_map,
    current_map (both MAP<key, derivation>, NULL where no map was kept), stored_text (the map
    as it was digested), has_rows, at_risk (keys whose tables hold rows).
    """
    stored_keys, current_keys = F.map_keys("stored_map"), F.map_keys("current_map")
    removed = F.array_except(stored_keys, current_keys)
    moved = F.filter(F.array_intersect(stored_keys, current_keys),
                     lambda k: ~F.col("stored_map")[k].eqNullSafe(F.col("current_map")[k]))
    risky = F.array_intersect(F.concat(moved, removed), F.coalesce("at_risk", F.array().cast("array<string>")))
    corrupt = F.col("stored_text").isNotNull() & (F.sha2("stored_text", 256) != F.col("stored_digest"))
    verdict = (F.when(F.col("stored_digest").isNull() & F.col("has_rows"), "UNRECORDED")
               .when(F.col("stored_digest").isNull(), "FIRST_LOAD")
               .when(corrupt, "CORRUPT_RECORD")
               .when(F.col("stored_digest") == F.col("current_digest"), "MATCHED")
               .when(F.col("stored_map").isNull() | F.col("current_map").isNull(), "UNMAPPED")
               .when(F.size(risky) > 0, "RE_KEYED").otherwise("EXTENDED"))
    return records.withColumns({
        "verdict": verdict, "moved": F.coalesce(moved, F.array().cast("array<string>")),
        "removed": F.coalesce(removed, F.array().cast("array<string>")),
        "added": F.coalesce(F.array_except(current_keys, stored_keys), F.array().cast("array<string>")),
        "fails": verdict.isin("UNRECORDED", "RE_KEYED", "UNMAPPED", "CORRUPT_RECORD")})


def schema_drift(stored: DataFrame, declared: DataFrame) -> DataFrame:
    """Differences of two column inventories (table_name, column_name, ordinal, data_type)."""
    def side(df, p):
        return df.select("table_name", "column_name", F.col("ordinal").alias(p + "_ordinal"),
                         F.col("data_type").alias(p + "_type"))
    a, b = side(stored, "stored"), side(declared, "declared")
    known_a = stored.select("table_name").distinct().withColumn("_a", F.lit(True))
    known_b = declared.select("table_name").distinct().withColumn("_b", F.lit(True))
    both = (a.join(b, ["table_name", "column_name"], "full_outer")
            .join(known_a, "table_name", "left").join(known_b, "table_name", "left"))
    finding = (F.when(F.col("_a").isNull(), "MISSING_TABLE").when(F.col("_b").isNull(), "EXTRA_TABLE")
               .when(F.col("stored_ordinal").isNull(), "MISSING_COLUMN")
               .when(F.col("declared_ordinal").isNull(), "EXTRA_COLUMN")
               .when(F.col("stored_type") != F.col("declared_type"), "TYPE_CHANGED")
               .when(F.col("stored_ordinal") != F.col("declared_ordinal"), "ORDER_CHANGED"))
    return (both.withColumn("finding", finding).where("finding IS NOT NULL")
            .select("table_name", F.when(F.col("finding").like("%_TABLE"), "*").otherwise(F.col("column_name")).alias("column_name"),
                    "finding").distinct())
