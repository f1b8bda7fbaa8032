"""Every registered query against its oracle, and the shape of the plans."""

import datetime
import re

import duckdb
import pytest

from conftest import DATA, TABLES, rows_of
import __spark_entry__ as entry
from lodestrata.operators import dedup
from lodestrata.plans import catalog, flagship

QUERIES, ORACLES = {k: q for k, q in entry.queries().items() if k in catalog.queries()}, catalog.oracles()
ROWS_ONLY = {"key9_xxhash64", "fn5_crc32", "agg27_crc32"}


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def canonical(rows, order):
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, key):
    df = QUERIES[key](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        assert key in ROWS_ONLY and got
        return
    cur = oracle.execute(ORACLES[key])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = cur.fetchall()
    mine = canonical(got, sorted(range(len(df.columns)), key=lambda i: df.columns[i]))
    assert mine == canonical(want, sorted(range(len(names)), key=lambda i: names[i]))


def test_the_inventory_is_covered():
    want = {f"{g}{i}" for g, n in dict(src=5, snk=3, prj=13, key=14, dq=23, ddp=7, vlt=16, jn=16, agg=32, win=8, srt=2, set=6, fn=9, rule=10, str=8).items()
            for i in range(1, n + 1)}
    assert want <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


STREAMED = {k for k in QUERIES if k.startswith(("str", "src2", "src3", "snk"))}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - STREAMED))
def test_plans_stay_in_the_engine(spark, key):
    text = plan(QUERIES[key](spark, DATA))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["prj1"](spark, DATA))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(value,10.0\)", text)
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string,value:double>", text)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan(QUERIES["agg13"](spark, DATA))


def test_a_satellite_load_shuffles_log_and_target_once(spark):
    from lodestrata.operators.load import load_satellite
    from lodestrata.plans.registry import Tables
    from lodestrata.plans.warehouse import user_log
    log = user_log(Tables(spark, DATA))
    text = plan(load_satellite(log, log, "hub_user_hk"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {(r.entity, r.status) for r in rows} == {("nhl_order_line", "PASSED"), ("hub_order", "PASSED")}


@pytest.mark.parametrize("key, shuffles", [("vlt2", 2), ("vlt3", 2), ("vlt4", 2), ("vlt8", 1), ("win5", 1)])
def test_loads_shuffle_each_side_once(spark, key, shuffles):
    """With joins by shuffle, as for tables too large to broadcast."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[key](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == shuffles


def test_a_small_log_leaves_a_large_target_where_it_is(spark, tmp_path):
    """Only the stored rows whose keys the log names are shuffled."""
    from lodestrata.operators.load import load_keyed, load_satellite
    from lodestrata.plans.registry import Tables
    from lodestrata.plans.warehouse import log_of
    t = Tables(spark, DATA)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)  # the scans' places in full
    for name, load in (("nhl_order_line", lambda log, target: load_keyed(log, target, "nhl_order_line_hk")),
                       ("sat_order", lambda log, target: load_satellite(log, target, "hub_order_hk"))):
        target = load(log_of(t, name), None)
        target.write.parquet(f"{tmp_path}/{name}")
        target = spark.read.parquet(f"{tmp_path}/{name}")
        target.limit(20).write.parquet(f"{tmp_path}/{name}_log")
        new = load(spark.read.parquet(f"{tmp_path}/{name}_log"), target)
        lines = plan(new).splitlines()
        at = next(i for i, x in enumerate(lines) if re.search(rf"{name}\]", x))
        above = next(x for x in reversed(lines[:at]) if re.search("Exchange|Join", x))
        assert re.search("BroadcastHashJoin.*LeftSemi", above)
        assert new.count() == 0
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_order_lines_meet_in_no_window_when_their_keys_come_once(spark):
    assert "Window" not in plan(QUERIES["flagship"](spark, DATA))


def test_order_lines_are_counted_without_a_shuffle_when_their_keys_come_once(spark):
    text = plan(QUERIES["flagship"](spark, DATA))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", text) == ["o_orderkey"]


def test_order_lines_that_come_again_are_counted_once(spark, tmp_path, monkeypatch):
    """Two lines are equal, two differ in what is no key, two in a key that is missing in one; one is quarantined, and its copy."""
    columns = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
               "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    at = datetime.datetime(1996, 1, 1)
    lines = [(1, 1, 1, 1, 5.0), (1, 1, 1, 1, 5.0), (1, 1, 1, 2, 5.0), (1, 1, 1, 2, 6.0), (2, 1, 1, 1, 5.0), (2, None, 1, 1, 5.0), (3, 1, 1, 1, 50.0), (3, 1, 1, 1, 50.0), (4, 1, 1, 1, 5.0)]
    spark.createDataFrame([(*x, 1.0, 0.0, 0.0, "N", "O", at) for x in lines], columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(n, 1, "O", 1.0, at, "1-URGENT") for n in (1, 2, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    want = [("hub_order", 3, 3, 0, 0), ("nhl_order_line", 6, 4, 3, 0)]
    asked = dedup.repeated_hashes
    for few in (10, 1):  # all hashes that come again are named, or are too many
        monkeypatch.setattr(flagship, "repeated_hashes", lambda df, hk: asked(df, hk, few))
        assert rows_of(QUERIES["flagship"](spark, str(tmp_path)).select("entity", "expected", "landed", "quarantined", "superseded")) == want


def test_lines_are_counted_by_number_before_their_keys_are_derived(spark, tmp_path):
    lines = [(1, 1, 1), (1, 1, 1), (2, 1, 1), (None, 1, 1), (3, 9, 1), (3, None, 1), (4, 1, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    found = QUERIES["key4"](spark, str(tmp_path))
    assert rows_of(found.select("line_count", "orders", "supplier_found", "part_found")) == [
        (1, 1, False, True), (1, 1, True, False), (1, 1, True, False), (4, 3, True, True)]
    assert found.select("hub_supplier_hk", "hub_part_hk").distinct().count() == 4
    first = [x for x in plan(QUERIES["key4"](spark, DATA)).splitlines() if "Exchange hashpartitioning" in x]
    assert any("l_orderkey" in x for x in first) and not any("hub_order_hk" in x for x in first)
