"""Deliveries that change their shape, and snapshots of which some are refused."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from lodestrata.operators import quality
from lodestrata.sources import schemalog
from lodestrata.sources.schemalog import SchemaLog, json_flow, parsed, read_logged, write_batch
from lodestrata.streaming import flows


@pytest.fixture
def feed(spark, tmp_path):
    """Lands lines and runs the flow to the end; returns the log's rows as dictionaries without what is empty."""
    log = SchemaLog(spark, f"{tmp_path}/schemas")
    landed = []

    def deliver(*lines, wider=schemalog.WIDER):
        os.makedirs(f"{tmp_path}/in", exist_ok=True)
        landed.append(lines)
        with open(f"{tmp_path}/in/{len(landed)}.json", "w") as f:
            f.write("\n".join(lines))
        json_flow(spark, f"{tmp_path}/in", f"{tmp_path}/data", str(tmp_path), "f", log, wider=wider).awaitTermination()
        rows = [{k: v for k, v in r.asDict().items() if v is not None} for r in read_logged(spark, f"{tmp_path}/data", log).collect()]
        return sorted(rows, key=str)
    deliver.log, deliver.root = log, tmp_path
    return deliver


def kinds(log):
    return {f.name: f.dataType.simpleString() for f in log.versions()[-1]}


def test_a_text_in_a_numeric_column_is_kept_beside_it(feed):
    assert feed('{"id": 1, "value": 5}') == [{"id": 1, "value": 5}]
    assert feed('{"id": 2, "value": "abc"}') == [{"id": 1, "value": 5}, {"id": 2, "_rescued": {"value": '"abc"'}}]
    assert kinds(feed.log) == {"id": "bigint", "value": "bigint"} and len(feed.log.versions()) == 2


def test_late_columns_and_declared_widening(feed):
    feed('{"id": 1, "v": 5}', '{"id": 2, "v": 9007199254740993}')
    got = feed('{"id": 3, "v": 2.5, "late": true}', '{"id": 4, "v": 9007199254740993}')
    assert kinds(feed.log) == {"id": "bigint", "v": "double", "late": "boolean"}
    assert got == sorted([{"id": 1, "v": 5.0}, {"id": 2, "_rescued": {"v": "9007199254740993"}}, {"id": 3, "v": 2.5, "late": True},
                          {"id": 4, "_rescued": {"v": "9007199254740993"}}], key=str)


def test_without_a_rule_no_type_changes(feed):
    feed('{"v": 5}')
    assert feed('{"v": 2.5}', wider={}) == [{"_rescued": {"v": "2.5"}}, {"v": 5}] and kinds(feed.log) == {"v": "bigint"}


def test_lines_that_are_no_objects_nested_values_and_clashing_names(feed):
    got = feed("no json", "[1]", "", '{"a": {"b": [1, 2]}, "n": null}', '{"a": "text"}', '{"A": 1}', '{"_rescued": 7, "mixed": 1}', '{"mixed": "x"}', '{"mixed": 1', '{"k": 1, "k": 2}')
    assert kinds(feed.log) == {"A": "bigint", "mixed": "string"}  # of two spellings the first in order is the column
    assert got == sorted([{"_rescued": {"_line": "no json"}}, {"_rescued": {"_line": "[1]"}}, {"_rescued": {"a": '{"b":[1,2]}'}}, {"_rescued": {"a": '"text"'}}, {"A": 1},
                          {"mixed": "1", "_rescued": {"_rescued": "7"}}, {"mixed": "x"}, {"_rescued": {"_line": '{"mixed": 1'}}, {"_rescued": {"_line": '{"k": 1, "k": 2}'}}], key=str)


def test_a_batch_that_runs_again_replaces_its_rows_and_reads_no_other(spark, feed):
    first = feed('{"id": 1}')
    lines = spark.createDataFrame([('{"id": 2, "x": 1}',)], "value string")
    path = flows.batch_path(f"{feed.root}/data", "f", 0, 1)
    assert [write_batch(lines, path, feed.log) for _ in range(2)] == [2, 2]
    assert rows_of(read_logged(spark, f"{feed.root}/data", feed.log).select("id", "x")) == [(1, None), (2, 1)] and first == [{"id": 1}]
    text = parsed(lines, feed.log.versions()[-1])._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in text


def test_columns_beyond_the_bound_are_rescued(feed, monkeypatch):
    monkeypatch.setattr(schemalog, "MOST_COLUMNS", 2)
    assert feed('{"a": 1, "b": 2, "c": 3}') == [{"a": 1, "b": 2, "_rescued": {"c": "3"}}]


def test_an_empty_feed_has_no_rows(spark, tmp_path):
    assert read_logged(spark, f"{tmp_path}/none", SchemaLog(spark, f"{tmp_path}/schemas")).count() == 0


def changes_of(spark, root, snapshots, fetched):
    """What comes out when the snapshots (name, {type: values}) arrive one after the other, each run twice."""
    taken = []
    for name, held in snapshots:
        name = f"2026-01-0{name} 00:00:00"
        rows = [(t, v, name) for t, values in held.items() for v in values] or [("none", "none", name)]
        spark.createDataFrame(rows, "type string, value string, taken string").write.mode("overwrite").parquet(flows.batch_path(f"{root}/kept", "s", 0, len(taken)))
        taken.append(name)
        for _ in range(2):
            flows.snapshot_changes(spark, f"{root}/kept", f"{root}/changes", "taken", taken, fetched)
    return rows_of(spark.read.parquet(f"{root}/changes").select(F.substring("taken", 10, 1).alias("taken"), "type", "value", "reference_status"))


def test_a_refused_snapshot_is_skipped_over(spark, tmp_path):
    got = changes_of(spark, tmp_path, [("1", {"A": "12", "B": "1"}), ("2", {"B": "1"}), ("3", {"A": "1", "B": "12"})], ["A", "B"])
    assert got == [("1", "A", "1", "OFFERED"), ("1", "A", "2", "OFFERED"), ("1", "B", "1", "OFFERED"), ("2", "A", None, "REFUSED"), ("3", "A", "2", "WITHDRAWN"), ("3", "B", "2", "OFFERED")]


def test_a_blank_value_is_refused_once_and_refusals_may_follow_each_other(spark, tmp_path):
    got = changes_of(spark, tmp_path, [("1", {"A": ["1"]}), ("2", {"A": ["1", " "]}), ("3", {}), ("4", {"A": ["1"]}), ("5", {"A": ["2"]})], ["A"])
    assert got == [("1", "A", "1", "OFFERED"), ("2", "A", None, "REFUSED"), ("3", "A", None, "REFUSED"), ("5", "A", "1", "WITHDRAWN"), ("5", "A", "2", "OFFERED")]


def test_a_snapshot_without_changes_is_compared_once(spark, tmp_path):
    changes_of(spark, tmp_path, [("1", {"A": "1"}), ("2", {"A": "1"})], ["A"])
    before = os.stat(f"{tmp_path}/changes/_snapshot=2026-01-02T000000").st_mtime_ns
    flows.snapshot_changes(spark, f"{tmp_path}/kept", f"{tmp_path}/changes", "taken", ["2026-01-01 00:00:00", "2026-01-02 00:00:00"], ["A"])
    assert os.stat(f"{tmp_path}/changes/_snapshot=2026-01-02T000000").st_mtime_ns == before


def test_a_probe_without_a_result_is_no_measurement(spark):
    required = spark.createDataFrame([("t", "a"), ("u", "a")], "table_name string, column_name string")
    present = required.withColumn("ordinal", F.lit(0))
    lossy = spark.createDataFrame([("t", "a", None), ("u", "a", 0)], "table_name string, column_name string, lost long")
    assert rows_of(quality.conformance(required, present, lossy).select("table_name", "status")) == [("t", "NOT_EVALUATED"), ("u", "CONFORMANT")]


def test_values_of_repeated_keys_are_no_survivors(spark):
    clear = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k int, v string")
    masked = spark.createDataFrame([(1, "b"), (1, "a"), (2, "*"), (3, "d")], "k int, v string")
    assert rows_of(quality.surviving_clear_values(clear, masked, ["k"], ["v"])) == [("v", 2, 1, 1)]
