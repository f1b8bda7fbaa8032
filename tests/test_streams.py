"""Streams whose batches run again, checkpoints that are lost, and versions that come in any order."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import day, rows_of
from lodestrata.operators import load
from lodestrata.sources import feeds, sinks
from lodestrata.streaming import flows
from test_vault import log


def held(table):
    return [] if table is None else rows_of(table.select("hk", "hashdiff", F.dayofmonth("load_dts"), "sub_seq"))


def crash(monkeypatch, after):
    """The next folder is not published, or published and the batch then fails."""
    write_once, state = sinks.write_once, {"failed": False}

    def failing(df, table, folder, partition_by=()):
        if state["failed"]:
            return write_once(df, table, folder, partition_by)
        state["failed"] = True
        if after:
            write_once(df, table, folder, partition_by)
        else:
            df.write.parquet(f"{table}/_pending-of-a-lost-driver")
        raise RuntimeError("lost")
    monkeypatch.setattr(flows, "write_once", failing)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("kind", ["append", "keyed", "satellite"])
def test_a_crash_around_the_commit_shows_neither_loss_nor_copy(spark, tmp_path, monkeypatch, kind, after):
    root, path = str(tmp_path), f"{tmp_path}/data"
    log(spark, *[(f"k{i}", None, h, day(n), day(n)) for i in range(5) for h, n in (("A", 1), ("B", 2))]).write.parquet(f"{root}/in")
    run = {"append": lambda: flows.append_flow(feeds.stream(spark, f"{root}/in"), path, root, "f"),
           "keyed": lambda: flows.keyed_flow(feeds.stream(spark, f"{root}/in"), path, "hk", root, "f"),
           "satellite": lambda: flows.satellite_flow(feeds.stream(spark, f"{root}/in"), path, "hk", root, "f")}[kind]
    crash(monkeypatch, after)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    want = 5 if kind == "keyed" else 10
    seen = flows.stored(spark, path)
    assert (0 if seen is None else seen.count()) == (want if after else 0)
    for _ in range(2):
        run().awaitTermination()
        assert flows.read_batches(spark, path).count() == want
    assert not os.path.exists(f"{root}/_arrived")


def test_a_lost_checkpoint_of_the_same_generation_loses_nothing(spark, tmp_path):
    """Batches are counted from 0 again, and other files are in them."""
    root = str(tmp_path)
    for n in (1, 2, 3):
        log(spark, (f"k{n}", None, "A", day(n), day(n)), ("k", None, str(n), day(n), day(n))).coalesce(1).write.mode("append").parquet(f"{root}/in")
    for attempt, files in enumerate((1, 1000)):
        stream = feeds.stream(spark, f"{root}/in", max_files=files)
        flows.keyed_flow(stream, f"{root}/hub", "hk", f"{root}/c{attempt}", "hub").awaitTermination()
        flows.satellite_flow(stream, f"{root}/sat", "hk", f"{root}/c{attempt}", "sat").awaitTermination()
        assert sorted(r["hk"] for r in flows.read_batches(spark, f"{root}/hub").collect()) == ["k", "k1", "k2", "k3"]
        assert [r[1:3] for r in held(flows.read_batches(spark, f"{root}/sat")) if r[0] == "k"] == [("1", 1), ("2", 2), ("3", 3)]


def test_versions_in_pieces_and_replays_are_stored_once(spark):
    """Any pieces of a log in order of load, then any pieces in any order: what one load of the whole log stores."""
    draw = random.Random(3)
    rows = [(k, m, draw.choice("AB"), day(d), day(d, h)) for k in ("x", "y") for m in (None, "m") for d in range(1, 6) for h in range(3)]
    whole = load.load_satellite(log(spark, *rows), None, "hk", "mas_key")
    want = rows_of(whole.select("hk", "mas_key", "hashdiff", "load_dts", "applied_dts"))
    target = None
    pieces = [[r for r in rows if r[3] in days] for days in ((day(1),), (day(2), day(3)), (day(4), day(5)))]
    pieces += [draw.sample(rows, 12), rows, draw.sample(rows, 30) * 2]
    for n, piece in enumerate(pieces):
        new = load.load_out_of_order(log(spark, *piece), target, "hk", "mas_key")
        assert n < 3 or new.count() == 0
        kept = [tuple(r) for r in (new if target is None else target.unionByName(new)).collect()]
        target = spark.createDataFrame(kept, new.schema)
    assert rows_of(target.select("hk", "mas_key", "hashdiff", "load_dts", "applied_dts")) == want
    assert load.duplicate_grain(target, ["hk", "mas_key", "load_dts", "sub_seq"]).count() == 0


def test_late_versions_copies_and_clocks_that_are_missing(spark):
    target = load.load_out_of_order(log(spark, ("k", None, "A", day(1), None), ("k", None, "A", day(1), None), ("k", None, "C", day(5), day(5))), None, "hk")
    assert held(target) == [("k", "A", 1, 0), ("k", "C", 5, 0)]
    late = log(spark, ("k", None, "A", day(2), day(2)), ("k", None, "B", day(1), day(1)), ("k", None, "B", day(3), day(3)))
    assert held(load.load_out_of_order(late, target, "hk")) == [("k", "A", 2, 0), ("k", "B", 1, 1), ("k", "B", 3, 0)]
    assert load.load_out_of_order(late.limit(0), target, "hk").count() == 0 and load.load_out_of_order(late.limit(0), None, "hk").count() == 0


def test_large_keys_in_chunks_load_the_same(spark):
    draw = random.Random(5)
    rows = [(k, None, draw.choice("AB"), day(1 + i // 10), day(1 + i // 10, i % 10)) for k in "xy" for i in range(80 if k == "x" else 9)]
    target = load.load_out_of_order(log(spark, *rows[:40]), None, "hk")
    target = spark.createDataFrame([tuple(r) for r in target.collect()], target.schema)
    names = ["hk", "hashdiff", "load_dts", "applied_dts", "sub_seq"]
    for held_rows in (None, target):
        plain, cut = (rows_of(load.load_out_of_order(log(spark, *rows), held_rows, "hk", **skew).select(*names)) for skew in ({}, {"floor": 5, "probe": 1.0}))
        assert plain == cut and plain


@pytest.mark.parametrize("kind", ["append", "quarantine"])
def test_a_file_holds_a_parents_digest_once_and_a_digest_in_32_bytes(spark, tmp_path, kind):
    """Of 40,000 parents whose digests take more than 1 MB, three lines each, in no order."""
    root, n = str(tmp_path), 120_000
    digest = lambda c: F.unhex(F.sha2(c.cast("string"), 256))
    rows = spark.range(0, n, 1, 1).select(digest(F.col("id")).alias("hk"), digest(F.pmod(F.xxhash64("id"), F.lit(40_000))).alias("parent_hk"),
                                          F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    rows.write.parquet(f"{root}/in")
    feed, path = feeds.stream(spark, f"{root}/in"), f"{root}/data"
    run = {"append": lambda: flows.append_flow(feed, path, root, "f"),
           "quarantine": lambda: flows.quarantine_flow(feed, [("all", F.lit(True))], feed.columns, path, f"{root}/bad", root, "f")}[kind]
    run().awaitTermination()
    kept = flows.read_batches(spark, path)
    assert kept.exceptAll(rows).count() == 0 and kept.count() == n
    size = dict(duckdb.sql(f"SELECT path_in_schema, sum(total_compressed_size) FROM parquet_metadata('{path}/**/*.parquet') GROUP BY 1").fetchall())
    assert size["hk"] < 33 * n and size["parent_hk"] < 33 * 40_000 + 3 * n
