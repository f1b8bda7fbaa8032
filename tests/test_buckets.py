"""Tables in buckets: loads leave what is stored where it is."""

import re

import pytest

from conftest import DATA, rows_of
from lodestrata.operators.load import load_keyed, load_satellite, load_unambiguous
from lodestrata.plans.registry import Tables
from lodestrata.plans.warehouse import log_of, user_log
from lodestrata.sources.buckets import BucketedTable, stored_buckets


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def above(df, marker):
    """The operators between the bucketed scan and the first join above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(lines) if marker in x)
    found, indent = [], len(re.match(r"[ :+\-|]*", lines[at])[0])
    for line in reversed(lines[:at]):
        depth = len(re.match(r"[ :+\-|]*", line)[0])
        if depth < indent:
            found.append(line.strip(" :+-|"))
            indent = depth
            if "Join" in line:
                break
    return found


@pytest.mark.parametrize("name, key, loading", [("hub_order", "hub_order_hk", load_keyed), ("nhl_order_line", "nhl_order_line_hk", load_unambiguous), ("sat_order", "hub_order_hk", load_satellite)])
def test_a_large_log_leaves_the_store_in_place(spark, tmp_path, no_broadcast, name, key, loading):
    log = log_of(Tables(spark, DATA), name)
    table = BucketedTable(spark, f"{tmp_path}/{name}", key, 8)
    assert table.read() is None
    first = loading(log.where("pmod(xxhash64(" + key + "), 2) = 0"), None, key)
    table.append(first)
    new = loading(log, table.read(), key)
    path = above(new, "Bucketed: true")
    assert "Join" in path[-1] and "LeftSemi" in path[-1] and not any("Exchange" in x for x in path)
    held = spark.createDataFrame(first.collect(), first.schema)
    assert rows_of(new) == rows_of(loading(log, held, key)) and new.count() > 0
    table.append(new)
    assert loading(log, table.read(), key).count() == 0


def test_repeated_loads_and_small_logs(spark, tmp_path):
    log = user_log(Tables(spark, DATA))
    table = BucketedTable(spark, f"{tmp_path}/sat", "hub_user_hk", 4)
    table.append(load_satellite(log, None, "hub_user_hk"))
    before = table.read().count()
    table.append(load_satellite(log.limit(5), table.read(), "hub_user_hk"))
    assert load_satellite(log, table.read(), "hub_user_hk").count() == 0 and table.read().count() >= before
    assert stored_buckets(table.read().select("hub_user_hk", "hashdiff"), "hub_user_hk") == 4
    assert stored_buckets(table.read(), "hashdiff") is None and stored_buckets(log, "hub_user_hk") is None


def test_a_table_keeps_its_declaration(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    BucketedTable(spark, f"{tmp_path}/t", "k", 4).append(rows)
    spark.sql(f"DROP TABLE {BucketedTable(spark, f'{tmp_path}/t', 'k', 4).name}")  # another session does not know it
    again = BucketedTable(spark, f"{tmp_path}/t", "k", 4)
    again.append(rows.select("v", "k"))
    assert rows_of(again.read()) == [("a", 1), ("a", 1), (None, 2), (None, 2)]
    with pytest.raises(ValueError, match="4 buckets"):
        BucketedTable(spark, f"{tmp_path}/t", "k", 8).read()
    with pytest.raises(ValueError, match="other columns"):
        again.append(rows.withColumnRenamed("v", "w"))
