"""Re-delivered rows: dropping them, choosing among them, and refusing where copies disagree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lodestrata.operators.ordered import first_per_key, large_keys, same, total_order

RUN_LOCAL = ("batch_id",)
FEW = 10_000  # keys that are collected and sent out again as literals
GRAIN = ("load_dts", "rec_src")


def drop_redelivered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Any one row per value of the columns; stateful on a stream."""
    return df.dropDuplicates(list(cols))


def latest_wins(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                tie: Sequence[str] = ()) -> DataFrame:
    """The newest row per key; ``tie`` must make the order total, or the survivor is arbitrary."""
    return first_per_key(df, keys, *[F.col(c).desc_nulls_last() for c in order_desc],
                         *[F.col(c).desc_nulls_last() for c in tie])


def first_write(df: DataFrame, hk: str, tie: Sequence[str | Column] = (), repeated: Sequence[int] | None | str = "probe") -> DataFrame:
    """First row per key by load time, then source, then ``tie``; the other columns decide what is left, so the
    survivor does not change between runs.

    A row whose key comes once is the first already. Where keys that come again are few, only their rows meet in a
    shuffle. ``repeated`` is what ``repeated_hashes`` found, where it was asked before; None is one window over all.
    """
    if isinstance(repeated, str):
        repeated = repeated_hashes(df, hk)
    rest = [c for c in df.columns if c not in (hk, "load_dts", "rec_src")]

    def first(rows: DataFrame) -> DataFrame:
        return first_per_key(rows, [hk], "load_dts", "rec_src", *tie, *total_order(df, rest))
    if repeated is None:
        return first(df)
    if not repeated:
        return df
    return with_hash_in(df, hk, repeated, "left_anti").unionByName(first(with_hash_in(df, hk, repeated, "left_semi")))


def repeated_hashes(df: DataFrame, hk: str | Sequence[str], few: int = FEW) -> list[int] | None:
    """64-bit hashes that come more than once among the keys, or None if they are more than ``few``. A key that comes
    again has such a hash; one that comes once has it by chance, and is then looked at with the others. Only hashes
    are shuffled. A key may have several columns."""
    again = df.select(_hash_of(df, hk).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    found = [r[0] for r in again.select("_hash").limit(few + 1).collect()]
    return None if len(found) > few else found


def with_hash_in(df: DataFrame, hk: str | Sequence[str], hashes: Sequence[int], how: str) -> DataFrame:
    """Rows whose key's hash is among the hashes (``left_semi``), or is not (``left_anti``)."""
    named = df.sparkSession.createDataFrame([(h,) for h in hashes], "_hash long")
    return df.join(F.broadcast(named), _hash_of(df, hk) == named["_hash"], how)


def _hash_of(df: DataFrame, hk: str | Sequence[str]) -> Column:
    return F.xxhash64(*[df[c] for c in ([hk] if isinstance(hk, str) else hk)])


def distinct_keys(df: DataFrame, keys: Sequence[str], repeated: Sequence[int] | None = None) -> DataFrame:
    """Each key once. ``repeated`` holds the hashes that ``repeated_hashes`` found among these keys, or among more
    rows than these: only keys with such a hash meet in a shuffle. None is a plain ``distinct`` of all."""
    rows = df.select(*keys)
    if repeated is None:
        return rows.distinct()
    if not repeated:
        return rows
    return with_hash_in(rows, keys, repeated, "left_anti").unionByName(with_hash_in(rows, keys, repeated, "left_semi").distinct())


def key_multiplicity(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct keys. Equal counts prove that no key is ambiguous."""
    per_key = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                       F.count(F.lit(1)).alias("distinct_keys"))


def with_group_size(df: DataFrame, grain: Sequence[str], name: str = "in_group",
                    probe_on: DataFrame | None = None, **skew) -> DataFrame:
    """``count(*) OVER (PARTITION BY grain)``, as a window while every group is small.

    A large group is not gathered in one task: counts combine before their shuffle, and the
    join back splits where one grain is large.
    """
    if large_keys(df if probe_on is None else probe_on, grain, **skew)[0] is None:
        return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*grain)))
    sizes = df.groupBy(*[F.col(c).alias("_g_" + c) for c in grain]).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, same(df, sizes, grain, "_g_")).select(*df.columns, name)


def ambiguous_groups(log: DataFrame, hk: str, ignore: Sequence[str] = RUN_LOCAL,
                     limit: int | None = None) -> DataFrame:
    """Rows of one key, load and source whose contents differ, whole groups first.

    Copies collapse before anything is counted. The report is whole unless ``limit`` bounds it.
    """
    grain = [hk, *GRAIN]
    rows = log.drop(*ignore).distinct()
    out = with_group_size(rows, grain, "variants", probe_on=log).where("variants > 1")
    rest = [c for c in rows.columns if c not in grain]
    return out.orderBy(*grain, *rest).limit(limit) if limit else out


class AmbiguousKeys(ValueError):
    """A log holds several versions of a key that must have one."""


def refuse_ambiguous(log: DataFrame, hk: str, ignore: Sequence[str] = RUN_LOCAL,
                     counted: Row | None = None) -> DataFrame:
    """The log itself, or a refusal naming some ambiguous keys.

    As many distinct keys as rows prove the probe empty, and it is skipped. ``counted`` is
    the row of ``key_multiplicity``, where it was taken before.
    """
    n = counted or key_multiplicity(log, [hk]).first()
    if n["total_rows"] > n["distinct_keys"]:
        some = ambiguous_groups(log, hk, ignore, limit=5).select(F.lower(F.hex(hk)).alias("k")).collect()
        if some:
            raise AmbiguousKeys(f"{hk}: contents differ for {sorted({r['k'] for r in some})}")
    return log


def divergent_groups(df: DataFrame, grain: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Groups whose copies disagree. Exact copies agree; a NULL and a value do not."""
    distinct = df.groupBy(*grain, *payload).agg(F.count(F.lit(1)).alias("copies"))
    return (distinct.groupBy(*grain)
            .agg(F.count(F.lit(1)).alias("variants"), F.sum("copies").alias("copies"))
            .where("variants > 1"))
