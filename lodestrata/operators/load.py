"""Insert-only loading of hubs, links, transactional links and satellites, with its audit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.keys import zero_key
from lodestrata.operators.dedup import FEW, first_write, refuse_ambiguous, repeated_hashes, with_hash_in
from lodestrata.operators.ordered import first_per_key, large_keys, literal_rows, ordered_scan, same, split_points, total_order
from lodestrata.sources.buckets import only_named, stored_buckets

GHOST_DTS = "1900-01-01 00:00:00"
# The order of a key's versions: by load, within a load by the source's clock.
VERSION = ["load_dts", "applied_dts", "hashdiff"]


def union_feeds(frames: Sequence[DataFrame]) -> DataFrame:
    """Several feeds into one entity; feeds that disagree on a type are refused, not widened."""
    shape = [(f.name, f.dataType) for f in frames[0].schema]
    for other in frames[1:]:
        if sorted((f.name, str(f.dataType)) for f in other.schema) != sorted((n, str(t)) for n, t in shape):
            raise ValueError("feeds of one entity must stage one shape")
    return reduce(DataFrame.unionByName, frames)


def absent_from(rows: DataFrame, target: DataFrame, keys: Sequence[str],
                nullable: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key the target does not hold; null-safe in the ``nullable`` columns (all by
    default)."""
    held = target.select(*[F.col(k).alias("_t_" + k) for k in keys])
    return rows.join(held, same(rows, held, keys, "_t_", nullable), "left_anti")


def named_in(target: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Stored rows that a load of the log has to meet: those whose key the log names. Where the log's keys are small
    enough they are broadcast; where the target is stored in buckets by the key they are dealt out as it is. In both
    cases the target stays where it is, and nothing of it but these rows is shuffled. Otherwise all rows take part,
    as a join that cuts them down first would shuffle the target as well."""
    names = log.select(F.col(key).alias("_named"))
    if fits_broadcast(names):
        return target.join(F.broadcast(names), target[key] == names["_named"], "left_semi")
    buckets = stored_buckets(target, key)
    return target if buckets is None else only_named(target, names, key, buckets)


def named_keys(target: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Exactly the stored keys that the log names, each once. ``named_in`` may hold others beside them."""
    held = named_in(target.select(key), log, key).distinct()
    names = log.select(F.col(key).alias("_named"))
    return held.join(names, held[key] == names["_named"], "left_semi")


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own estimate of the frame is within its limit for broadcasts. Runs no job."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def load_keyed(log: DataFrame, target: DataFrame | None, hk: str, tie: Sequence[str] = (),
               repeated: Sequence[int] | None | str = "probe") -> DataFrame:
    """Rows to insert into a hub, link or transactional link. The first write wins for good. ``repeated`` as for
    ``first_write``; a target that is not broadcast meets the log in the shuffle of one window over all."""
    if target is None:
        return first_write(log, hk, tie, repeated)
    firsts = first_write(log, hk, tie, repeated if fits_broadcast(target.select(hk)) else None)
    return absent_from(firsts, named_in(target.select(hk), log, hk), [hk], ())


def load_again(log: DataFrame, target: DataFrame | None, hk: str, tie: Sequence[str] = (), few: int = FEW) -> DataFrame:
    """``load_keyed`` for a log of which much or all may be stored already. Where both are too large for broadcasts the
    keys alone are compared first, and if few are new, nothing but their rows takes part in the load."""
    if target is None or fits_broadcast(log.select(hk)) or fits_broadcast(target.select(hk)) or stored_buckets(target, hk):
        return load_keyed(log, target, hk, tie)
    new = absent_from(log.select(hk), target, [hk], ()).distinct().limit(few + 1).collect()
    if len(new) > few:
        return load_keyed(log, target, hk, tie)
    if not new:
        return log.where(F.lit(False))
    named = literal_rows(log, new, [hk])
    return first_write(log.join(F.broadcast(named), same(log, named, [hk], "_k_"), "left_semi"), hk, tie, None)


def load_unambiguous(log: DataFrame, target: DataFrame | None, hk: str) -> DataFrame:
    """``load_keyed`` for links: a log whose copies of a key disagree is refused first. Without a key that comes again
    there is nothing to refuse."""
    repeated = repeated_hashes(log, hk)
    if repeated is None or repeated:
        refuse_ambiguous(log if repeated is None else with_hash_in(log, hk, repeated, "left_semi"), hk)
    return load_keyed(log, target, hk, repeated=repeated)


def latest_version(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last stored version per key in loading order."""
    return first_per_key(target, keys, F.desc("load_dts"), F.desc("sub_seq"))


def collapse_copies(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per version delivered, the first in the order of all columns, with the number of its copies."""
    grain = [*keys, *VERSION]
    rest = [c for c in log.columns if c not in grain]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(total_order(log, rest))])
    return (log.groupBy(*grain)
            .agg(F.min_by(F.struct(*rest), order).alias("_rest"), F.count(F.lit(1)).alias("_copies"))
            .select(*grain, "_rest.*", "_copies").select(*log.columns, "_copies"))


def load_satellite(log: DataFrame, target: DataFrame | None, hk: str, mas_key: str | None = None,
                   drop_replayed: bool = False, **skew) -> DataFrame:
    """Rows to insert into a satellite: those that change what was known before them.

    A row is compared with its predecessor in the whole log, and the first of a key with
    the stored latest, so A, B, A stores three rows. ``sub_seq`` numbers the versions of a
    key within one load by source clock. ``drop_replayed`` leaves out log rows whose version
    an earlier load already delivered. Of copies of a version the first in the order of all
    columns is stored. ``skew`` is passed to ``large_keys``, which chooses between two plans
    for the same rows.
    """
    keys = [hk] + ([mas_key] if mas_key else [])
    if drop_replayed:
        log = first_per_key(log, [*keys, "applied_dts", "hashdiff"], "load_dts", "rec_src")
    if target is not None:
        target = named_in(target.select(*keys, "hashdiff", "load_dts", "sub_seq"), log, hk)
    in_log = large_keys(log, keys, **skew)
    if in_log[0] is None:
        return _changed_in_one_pass(log, target, keys)
    points = split_points(log, keys, VERSION, known=in_log)
    within = split_points(log, [*keys, "load_dts"], VERSION[1:], **skew)
    return _changed_with_large_keys(log, target, keys, points, within)


def _changed_in_one_pass(log: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Log and stored versions meet in one shuffle by key, where windows answer all three
    questions: what came before, what is stored last, and whether the row is stored. Of the
    target only the keys of the log take part."""
    both = log.withColumn("_stored", F.lit(False))
    ties = total_order(log, [c for c in log.columns if c not in (*keys, *VERSION)])
    if target is not None:
        held = target.select(*keys, "hashdiff", "load_dts", "sub_seq").withColumn("_stored", F.lit(True))
        both = both.unionByName(held, allowMissingColumns=True)
        # Widest grouping first: the windows after it find their rows together already.
        newest = F.max(F.when(F.col("_stored"), F.struct("load_dts", "sub_seq", "hashdiff")))
        both = both.withColumn("_latest", newest.over(Window.partitionBy(*keys))["hashdiff"])
    side = Window.partitionBy(*keys, "_stored").orderBy(*VERSION, *ties)
    in_load = Window.partitionBy(*keys, "_stored", "load_dts").orderBy(*VERSION[1:], *ties)
    rows = both.select("*", F.lag("hashdiff").over(side).alias("_prev"),
                       F.row_number().over(in_load).alias("_nr"))
    rows = rows.withColumn("sub_seq", F.when(F.col("_stored"), F.col("sub_seq")).otherwise(F.col("_nr") - 1).cast("int"))
    if target is None:
        return rows.where(~F.col("hashdiff").eqNullSafe(F.col("_prev"))).select(*log.columns)
    changed = rows.where(F.col("_stored") | ~F.col("hashdiff").eqNullSafe(F.coalesce("_prev", "_latest")))
    grain = Window.partitionBy(*keys, "load_dts", "sub_seq")
    return (changed.withColumn("_held", F.max("_stored").over(grain))
            .where("not _stored AND not _held").select(*log.columns))


def _changed_with_large_keys(log: DataFrame, target: DataFrame | None, keys: list[str],
                             points: DataFrame | None, within: DataFrame | None) -> DataFrame:
    """The same where a key is too large for one task. Copies collapse first, since no cut can
    separate them; then the key is scanned in chunks, and the target is met by joins."""
    versions = collapse_copies(log, keys)
    compared = ordered_scan(versions, keys, VERSION, prev={"_prev": F.col("hashdiff")}, points=points)
    numbered = ordered_scan(compared, [*keys, "load_dts"], VERSION[1:], sums={"_upto": F.col("_copies")}, points=within)
    rows = numbered.withColumn("sub_seq", (F.col("_upto") - F.col("_copies")).cast("int"))
    if target is None:
        return rows.where(~F.col("hashdiff").eqNullSafe(F.col("_prev"))).select(*log.columns)
    nullable = keys[1:]
    seed = latest_version(target.select(*keys, "hashdiff", "load_dts", "sub_seq"), keys).select(
        *[F.col(k).alias("_l_" + k) for k in keys], F.col("hashdiff").alias("_latest"))
    joined = rows.join(seed, same(rows, seed, keys, "_l_", nullable), "left")
    changed = joined.where(~F.col("hashdiff").eqNullSafe(F.coalesce("_prev", "_latest"))).select(*log.columns)
    return absent_from(changed, target, [*keys, "load_dts", "sub_seq"], nullable)


def load_out_of_order(log: DataFrame, target: DataFrame | None, hk: str, mas_key: str | None = None, **skew) -> DataFrame:
    """Rows to insert into a satellite out of a log that may come in any pieces, late, or once more.

    A version is compared with the one before it in the order of versions, whether that is stored or in the log, and not
    with the one stored last: of A, B, A each is stored once, and neither a replay of all of them nor one of the first two
    adds a row. A late version is stored if it differs from the one before it; what is stored stays, so the version after
    a late one may repeat it. ``sub_seq`` goes on from the rows stored of the same load. NULL clocks come first; copies of a
    version are one. ``skew`` is passed to ``split_points``: large keys are scanned in chunks. Whether there are any is
    asked of log and table as they are, before copies collapse, and for keys alone: no load of a small key is large.
    """
    keys = [hk] + ([mas_key] if mas_key else [])
    rows, probe = collapse_copies(log, keys).drop("_copies").withColumn("_late", F.lit(True)), log.select(*keys)
    if target is not None:
        held = named_in(target.select(*keys, *VERSION, "sub_seq"), log, hk).withColumn("_late", F.lit(False))
        rows, probe = rows.unionByName(held, allowMissingColumns=True), probe.unionByName(target.select(*keys))
    order, in_load = [*VERSION, "_late"], ["_late", *VERSION[1:]]
    large = large_keys(probe, keys, **skew)[0] is not None
    points = split_points(rows, keys, order, **skew) if large else None
    within = split_points(rows, [*keys, "load_dts"], in_load, **skew) if large else None
    after = ordered_scan(rows, keys, order, prev={"_prev": F.col("hashdiff")}, points=points)
    new = F.col("_late") & ~F.col("hashdiff").eqNullSafe(F.col("_prev"))
    numbered = ordered_scan(after.where(~F.col("_late") | new), [*keys, "load_dts"], in_load, sums={"_nr": F.col("_late").cast("int")},
                            maxima={"_top": F.when(~F.col("_late"), F.col("sub_seq"))}, points=within)
    number = F.coalesce(F.col("_top"), F.lit(-1)) + F.col("_nr")
    return numbered.where("_late").withColumn("sub_seq", number.cast("int")).select(*log.columns)


def without_earlier(log: DataFrame, since: str) -> DataFrame:
    """Log rows of the loads after ``since``; with ``load_satellite``'s seed this is enough
    for a run whose earlier loads are all stored, and spares the scan of the whole log."""
    return log.where(F.col("load_dts") > F.lit(since).cast("timestamp"))


def ghost(df: DataFrame, rec_src: str = "SYSTEM") -> DataFrame:
    """The one zero-key row every vault table starts with, in the table's own shape."""
    fixed = {"load_dts": F.lit(GHOST_DTS).cast("timestamp"), "applied_dts": F.lit(GHOST_DTS).cast("timestamp"),
             "sub_seq": F.lit(0), "rec_src": F.lit(rec_src), "cdc_op": F.lit("I")}
    cols = []
    for f in df.schema:
        value = zero_key() if f.name.endswith("_hk") else fixed.get(f.name, F.lit(None))
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.sparkSession.range(1).select(*cols)


def missing_ghost(df: DataFrame, hk: str) -> DataFrame:
    """The ghost row, unless the table holds it."""
    held = df.where(F.col(hk) == zero_key()).limit(1).agg(F.count(F.lit(1)))
    return ghost(df).where(held.scalar() == 0)


def with_ghost(df: DataFrame, hk: str) -> DataFrame:
    """The table and its ghost row, added once however often this runs."""
    return df.unionByName(missing_ghost(df, hk))


def empty_like(df: DataFrame) -> DataFrame:
    """The exact shape of a frame and no rows; needs no scan."""
    return df.sparkSession.createDataFrame([], df.schema)


def discards_keyed(log: DataFrame, target: DataFrame, hk: str) -> DataFrame:
    """Where the staged rows of a keyed load went: (reason, discarded), plus ``accepted``."""
    per_key = log.groupBy(hk).agg(F.count(F.lit(1)).alias("n"))
    held = target.select(F.col(hk).alias("_t")).distinct()
    marked = per_key.join(held, per_key[hk] == held._t, "left").select(
        "n", F.col("_t").isNotNull().alias("held"))
    return marked.agg(F.array(
        F.struct(F.lit("duplicate_in_batch").alias("reason"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("row_count")),
        F.struct(F.lit("already_present").alias("reason"),
                 F.coalesce(F.sum(F.when(F.col("held"), 1).otherwise(0)), F.lit(0)).alias("row_count")),
        F.struct(F.lit("accepted").alias("reason"),
                 F.coalesce(F.sum(F.when(F.col("held"), 0).otherwise(1)), F.lit(0)).alias("row_count")),
    ).alias("a")).select(F.inline("a"))


def discards_versioned(log: DataFrame, inserted: DataFrame) -> DataFrame:
    """Log rows a satellite load left out because nothing changed: (reason, row_count)."""
    sides = (log.select(F.lit(1).alias("n")).unionByName(inserted.select(F.lit(-1).alias("n"))))
    return sides.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(
        F.lit("unchanged_hashdiff").alias("reason"), "row_count")


def load_arithmetic(loads: DataFrame, discards: DataFrame) -> DataFrame:
    """Every audit row with the verdict on its own sum: staged - accepted = what was discarded."""
    summed = discards.groupBy("job_run_id", "table_name").agg(F.sum("discarded").alias("discarded"))
    out = loads.join(summed, ["job_run_id", "table_name"], "left").withColumn(
        "discarded", F.coalesce("discarded", F.lit(0)))
    reason = (F.when(F.col("accepted") > F.col("staged"), "accepted more rows than were staged")
              .when(F.col("staged") - F.col("accepted") != F.col("discarded"),
                    "discards do not account for the rows not accepted"))
    return out.withColumn("reason", reason).withColumn("balanced", reason.isNull())


def refuse_imbalance(table: str, staged: int, accepted: int, discarded: int) -> None:
    """Staged rows must be accepted or counted as discarded, each by a count of its own."""
    if staged != accepted + discarded:
        raise ValueError(f"{table}: {staged} rows staged, {accepted} accepted and {discarded} discarded")


def refuse_duplicates(table: str, df: DataFrame, grain: Sequence[str]) -> None:
    """No grain may be stored twice."""
    if not duplicate_grain(df, grain).isEmpty():
        raise ValueError(f"{table}: {', '.join(grain)} stored more than once")


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Grains stored more than once."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
