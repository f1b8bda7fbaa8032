"""Loading behaviour on small traces."""

import pytest
from pyspark.sql import functions as F

from conftest import day, rows_of
from lodestrata.functions.keys import hash_key, zero_key
from lodestrata.model import Binding, Entity, Model, Parent, active_bindings, payload_grew
from lodestrata.operators import dedup, history, load, quality, reconcile, snapshots, unions
from lodestrata.operators.staging import declared_columns, mandatory_rules, narrow, project, stage
from lodestrata.sources import sinks

LOG = "hk string, mas_key string, hashdiff string, load_dts timestamp, applied_dts timestamp, sub_seq int, rec_src string, batch_id string"


def log(spark, *rows):
    return spark.createDataFrame([(k, m, h, d, a, 0, "s", "b") for k, m, h, d, a in rows], LOG)


def stored(df):
    return [(r.hk, r.hashdiff, r.load_dts.day, r.sub_seq) for r in df.orderBy("hk", "load_dts", "sub_seq").collect()]


def run(spark, target, staged, **kw):
    new = load.load_satellite(staged, target, "hk", **kw)
    return new if target is None else target.unionByName(new)


def test_a_b_a_stores_three_rows(spark):
    a, b, again = (("k", None, h, day(n), day(n)) for h, n in (("A", 1), ("B", 3), ("A", 4)))
    same = ("k", None, "A", day(2), day(2))
    target = run(spark, None, log(spark, a))
    target = run(spark, target, log(spark, a, same))
    assert stored(target) == [("k", "A", 1, 0)]
    target = run(spark, target, log(spark, a, same, b))
    target = run(spark, target, log(spark, a, same, b, again))
    assert stored(target) == [("k", "A", 1, 0), ("k", "B", 3, 0), ("k", "A", 4, 0)]
    assert load.load_satellite(log(spark, a, same, b, again), target, "hk").count() == 0


def test_a_log_of_later_loads_is_seeded_by_the_target(spark):
    target = run(spark, None, log(spark, ("k", None, "A", day(1), day(1))))
    later = log(spark, ("k", None, "A", day(2), day(2)), ("k", None, "B", day(3), day(3)))
    assert stored(load.load_satellite(load.without_earlier(later, "2026-01-01 00:00:00"), target, "hk")) == [("k", "B", 3, 0)]


def test_versions_of_one_load_are_ordered_by_the_source(spark):
    rows = log(spark, ("k", None, "C", day(1), day(1, 3)), ("k", None, "A", day(1), day(1, 1)), ("k", None, "B", day(1), day(1, 2)))
    assert stored(load.load_satellite(rows, None, "hk")) == [("k", "A", 1, 0), ("k", "B", 1, 1), ("k", "C", 1, 2)]


def test_siblings_of_a_multi_active_key_all_load(spark):
    rows = log(spark, *[("k", m, "A", day(1), day(1)) for m in ("x", "y", None)])
    got = load.load_satellite(rows, None, "hk", "mas_key")
    assert {r.mas_key for r in got.collect()} == {"x", "y", None}
    assert load.load_satellite(rows, got, "hk", "mas_key").count() == 0


def test_a_replayed_log_can_be_left_out(spark):
    first = [("k", None, "A", day(1), day(1)), ("k", None, "B", day(2), day(2))]
    again = [("k", None, h, day(9), a) for _, _, h, _, a in first]
    both = log(spark, *first, *again)
    assert len(stored(load.load_satellite(both, None, "hk"))) == 4
    assert stored(load.load_satellite(both, None, "hk", drop_replayed=True)) == [("k", "A", 1, 0), ("k", "B", 2, 0)]


def test_late_arrival_is_placed_by_its_own_clock(spark):
    sat = load.load_satellite(log(spark, ("k", None, "A", day(1), day(1)), ("k", None, "C", day(2), day(5)), ("k", None, "B", day(3), day(3))), None, "hk")
    got = [(r.hashdiff, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current) for r in history.type2(sat, "hk").orderBy("valid_from").collect()]
    assert got == [("A", 1, 3, False), ("B", 3, 5, False), ("C", 5, None, True)]
    assert [r.hashdiff for r in history.current(sat, "hk").collect()] == ["B"]


def test_one_current_row_where_clocks_are_missing(spark):
    sat = log(spark, ("k", None, "A", day(1), None), ("k", None, "B", day(2), None), ("j", None, "A", day(1), None))
    got = rows_of(history.type2(sat, "hk").select("hk", "hashdiff", "is_current"))
    assert got == [("j", "A", True), ("k", "A", False), ("k", "B", True)]


def test_one_open_edge_per_driving_key(spark):
    edges = spark.createDataFrame([("c", "p1", day(1), day(1)), ("c", "p2", day(2), day(2)), ("d", "p1", day(1), day(1))], "child string, parent string, applied_dts timestamp, load_dts timestamp")
    got = history.effectivity(edges, ["child"], ["parent"])
    assert rows_of(got.where("is_open").select("child", "parent")) == [("c", "p2"), ("d", "p1")]


def test_first_write_wins_and_loading_twice_is_loading_once(spark):
    rows = spark.createDataFrame([("k", day(2), "s", 2), ("k", day(1), "t", 1), ("k", day(1), "s", 0), ("j", day(1), "s", 3)], "hk string, load_dts timestamp, rec_src string, v int")
    first = load.load_keyed(rows, None, "hk", ["v"])
    assert rows_of(first.select("hk", "v")) == [("j", 3), ("k", 0)]
    assert load.load_keyed(rows, first, "hk").count() == 0


def test_ambiguous_keys_are_refused(spark):
    rows = spark.createDataFrame([(b"k", day(1), "s", 1, "b1"), (b"k", day(1), "s", 1, "b2"), (b"j", day(1), "s", 3, "b1")], "hk binary, load_dts timestamp, rec_src string, v int, batch_id string")
    assert load.load_unambiguous(rows, None, "hk").count() == 2
    worse = rows.unionByName(rows.where("v = 3").withColumn("v", F.lit(None).cast("int")))
    assert dedup.ambiguous_groups(worse, "hk").count() == 2
    with pytest.raises(dedup.AmbiguousKeys, match="6a"):
        load.load_unambiguous(worse, None, "hk")


def test_ghost_is_added_once(spark):
    table = spark.createDataFrame([(1, "x", 2.0)], "v int, note string, amount double").select(hash_key(["v"]).alias("a_hk"), "v", "note", F.col("amount").cast("decimal(18,2)").alias("amount"))
    once = load.with_ghost(table, "a_hk")
    twice = load.with_ghost(once, "a_hk")
    assert once.schema.simpleString() == table.schema.simpleString()
    assert once.count() == twice.count() == 2
    assert [tuple(r)[1:] for r in once.where(F.col("a_hk") == zero_key()).collect()] == [(None, None, None)]


MODEL = Model(
    Entity("hub_a", "hub", ("tenant", "code"), "SYS", tenant_keys=("tenant",), bindings=(
        Binding("f", "S1", {"code": "a"}, literals={"tenant": "t1"}), Binding("f", "S2", {"code": "b"}, literals={"tenant": "t2"}, active=False))),
    Entity("hub_b", "hub", ("code",), bindings=(Binding("f", "S1", {"code": "b"}),)),
    Entity("link_ab", "link", scope="SYS", parents=(Parent("hub_a"), Parent("hub_b")), bindings=(
        Binding("f", "S1", parent_keys={"hub_a": ("tenant_code", "a"), "hub_b": ("b",)}, derived={"tenant_code": "'t1'"}, cdc="op"),)))


def test_declarations_are_checked():
    with pytest.raises(ValueError, match="not declared"):
        Model(Entity("l", "link", parents=(Parent("x"), Parent("y"))))
    with pytest.raises(ValueError, match="tenant"):
        Model(Entity("h", "hub", ("code", "tenant"), tenant_keys=("tenant",)))
    with pytest.raises(ValueError, match="collide"):
        Model(Entity("h", "hub", ("load_dts",), bindings=(Binding("f", "S", {"load_dts": "a"}),)))
    with pytest.raises(ValueError, match="no payload"):
        Model(Entity("h", "hub", ("a",)), Entity("s", "sat", parents=(Parent("h"),), bindings=(Binding("f", "S", parent_keys={"h": ("a",)}),)))
    assert payload_grew(["a"], ["a", "b"]) and not payload_grew(["a", "b"], ["b", "a"])


def test_bindings_are_selected():
    assert [b.rec_src for b in active_bindings(MODEL)["hub_a"].bindings] == ["S1"]
    assert set(active_bindings(MODEL, ["hub_b/S1"])) == {"hub_b"}
    with pytest.raises(ValueError, match="S9"):
        active_bindings(MODEL, ["S9"])


def test_staging_derives_matching_keys_and_declared_shape(spark):
    feed = spark.createDataFrame([("1", "x", "d"), ("2", None, None)], "a string, b string, op string")
    link, hub = MODEL["link_ab"], MODEL["hub_a"]
    staged = stage(feed, MODEL, link, link.bindings[0], load_dts="2026-01-01 00:00:00", batch_id="b")
    hubs = stage(feed, MODEL, hub, hub.bindings[0], load_dts="2026-01-01 00:00:00")
    assert rows_of(staged.select("hub_a_hk")) == rows_of(hubs.select("hub_a_hk"))
    assert project(staged, link, link.bindings[0]).columns == ["link_ab_hk", "hub_a_hk", "hub_b_hk", "load_dts", "applied_dts", "rec_src", "batch_id", "manifest_id"]
    assert rows_of(staged.select("cdc_op")) == [("D",), ("I",)]
    valid, bad = quality.split(staged, mandatory_rules(link, link.bindings[0]))
    assert (valid.count(), [r.failure_rule for r in bad.collect()]) == (1, ["key_present_b"])
    assert "hub_a_bk" in declared_columns(hub, hub.bindings[0])


def test_rules_are_merged_in_place_and_split_is_complete(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    rules = quality.merge_rules([("a", F.expr("v > 0")), ("b", F.expr("v > 3"))], [("a", F.expr("v > 4")), ("c", F.lit(True))])
    assert [n for n, _ in rules] == ["a", "b", "c"]
    valid, bad = quality.split(df, rules)
    assert rows_of(valid) == [(5,)] and rows_of(bad.select("v", "failure_rule")) == [(1, "a"), (None, "a")]
    nothing, reason = quality.violation([])
    assert df.where(nothing).count() == 0 and df.select(reason.alias("r")).where("r IS NOT NULL").count() == 0


def test_feeds_of_one_entity_must_agree(spark):
    a, b = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([("x",)], "v string")
    with pytest.raises(ValueError):
        load.union_feeds([a, b])


def test_nothing_compared_is_never_a_pass(spark):
    empty = spark.createDataFrame([], "f string")
    refs = spark.createDataFrame([("T", "x")], "type string, value string")
    got = {r.rule: r.status for r in quality.validate_fields(empty, {"ISNUMERIC": ["f"], "M": ["f"]}, refs, {"M": "T"}).collect()}
    assert set(got.values()) == {"NOT_EVALUATED"}
    some = spark.createDataFrame([("x",), (" ",), ("y",)], "f string")
    got = {r.rule: (r.status, r.checks, r.problems) for r in quality.validate_fields(some, {"M": ["f"], "N": ["f"]}, refs, {"M": "T", "N": "U"}).collect()}
    assert got["M"] == ("FAIL", 2, 1) and got["N"] == ("NOT_EVALUATED", 0, 0) and got["MISSINGVALUE"][0] == "NOT_EVALUATED"
    none = reconcile.landing_variance(empty, ["f"], spark.createDataFrame([], "hk string, load_dts timestamp"), "hk", empty, empty).first()
    assert none.status == "NOT_EVALUATED"


def test_snapshots_refuse_types_that_came_back_empty(spark):
    s = "type string, value string"
    prev = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "1"), ("C", "1")], s)
    cur = spark.createDataFrame([("A", "2"), ("A", "3")], s)
    got = rows_of(snapshots.snapshot_effectivity(prev, cur, ["A", "B"], "2026-01-01 00:00:00").select("type", "value", "reference_status"))
    assert got == [("A", "1", "WITHDRAWN"), ("A", "3", "OFFERED"), ("B", None, "REFUSED")]


def test_unions_keep_copies_and_report_findings(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "b int, a string")
    b = spark.createDataFrame([(2.5,)], "c double")
    out = unions.aligned_union({"a": a, "b": b})
    assert out.columns == ["a", "b", "c"] and out.count() == 3
    assert narrow(out, ["C", "a"]).columns == ["a", "c"]
    inv = quality.inventory(spark, {"t1": a, "t2": b})
    assert rows_of(unions.union_findings(inv, "t%", ["A"], ["x", "X"]).select("finding", "table_name", "detail")) == [
        ("ALIAS_CLASH", None, "x"), ("MISSING_REQUIRED", "t2", "A")]
    assert rows_of(unions.union_findings(inv, "z%", ["A"], []).select("finding")) == [("NO_TABLES",)]


def test_export_refuses_unresolved_columns_even_without_rows(spark):
    with pytest.raises(ValueError, match="Cost"):
        sinks.export_columns(spark.createDataFrame([], "a string"), [("A", "a", sinks.MAPPED), ("Cost", None, sinks.UNRESOLVED)])


def test_derivation_verdict_prefers_the_most_serious(spark):
    old, new = "map('a', '1', 'b', '2')", "map('a', '9', 'c', '3')"
    df = spark.sql(f"""SELECT 'D' AS stored_digest, 'E' AS current_digest, {old} AS stored_map, {new} AS current_map, cast(null AS string) AS stored_text, true AS has_rows, array('b') AS at_risk
      UNION ALL SELECT 'D', 'E', {old}, {new}, null, true, null UNION ALL SELECT 'D', 'D', null, null, null, true, null UNION ALL SELECT 'D', 'E', null, {new}, null, true, null""")
    got = [(r.verdict, r.fails) for r in reconcile.derivation_verdict(df).collect()]
    assert sorted(got) == [("EXTENDED", False), ("MATCHED", False), ("RE_KEYED", True), ("UNMAPPED", True)]


def test_a_vault_loads_once_and_survives_a_bad_table(spark, tmp_path):
    from lodestrata.vault import Vault
    model = Model(
        Entity("hub_a", "hub", ("code",), "SYS", bindings=(Binding("f", "S1", {"code": "a"}),)),
        Entity("hub_b", "hub", ("code",), "SYS", bindings=(Binding("f", "S1", {"code": "b"}),)),
        Entity("link_ab", "link", scope="SYS", parents=(Parent("hub_a"), Parent("hub_b")), bindings=(
            Binding("f", "S1", parent_keys={"hub_a": ("a",), "hub_b": ("b",)}, manifest="m"),)),
        Entity("sat_a", "sat", parents=(Parent("hub_a"),), bindings=(
            Binding("f", "S1", parent_keys={"hub_a": ("a",)}, payload=("v",), applied="at"),)))
    vault = Vault(spark, str(tmp_path), model)
    schema = "a string, b string, m string, v string, at timestamp"
    rules = spark.createDataFrame([("hub_a", "short", "length(code) < 3", True, "drop")], "dataset string, rule_name string, rule_sql string, is_current boolean, severity string")
    vault.stage({"f": spark.createDataFrame([("1", "x", "m1", "p", day(1)), ("1", "x", "m1", "q", day(2)), ("long", None, "m1", "p", day(1))], schema)}, "2026-01-05 00:00:00", "b1", rules=rules)
    assert vault.load("r1", "2026-01-05 00:00:00") == {}
    counts = {r.table_name: r.row_count for r in vault.counts().collect()}
    assert counts == {"hub_a": 2, "hub_b": 2, "link_ab": 2, "sat_a_s1": 4}
    assert {r.table_name: r.row_count for r in vault.counts("qtn").collect()} == {"hub_a": 1, "hub_b": 1, "link_ab": 1, "sat_a_s1": 0}
    assert vault.load("r2", "2026-01-06 00:00:00") == {}
    assert vault.load("r2", "2026-01-06 00:00:00") == {}
    audit = load.load_arithmetic(spark.read.parquet(vault.path("audit", "aud_table_load")), spark.read.parquet(vault.path("audit", "aud_table_discard")))
    assert audit.count() == 8 and audit.where("not balanced").count() == 0 and audit.where("job_run_id = 'r2' AND accepted <> 0").count() == 0
    assert "sat_a_s1_v1" in vault.views() and spark.table("sat_a_s1_v1").where("is_current AND rec_src = 'S1'").count() == 2
    # A load of what is new since the last one finds the same as a load of the whole log.
    vault.stage({"f": spark.createDataFrame([("1", "x", "m1", "q", day(4)), ("1", "x", "m1", "r", day(5)), ("8", "x", "m1", "r", day(5))], schema)}, "2026-01-06 00:00:00", "b2", ["sat_a/S1", "hub_a/S1"])
    assert vault.load("r2b", "2026-01-06 12:00:00", ["sat_a/S1", "hub_a/S1"], since="2026-01-05 00:00:00") == {}
    assert {r.table_name: r.row_count for r in vault.counts().collect()} == {"hub_a": 3, "hub_b": 2, "link_ab": 2, "sat_a_s1": 6}
    assert vault.load("r2c", "2026-01-06 13:00:00", ["sat_a/S1", "hub_a/S1"]) == {}
    # The same link key with another manifest in one load is ambiguous; the other tables still load.
    vault.stage({"f": spark.createDataFrame([("1", "x", "m2", "z", day(3)), ("7", "y", "m2", "z", day(3))], schema)}, "2026-01-05 00:00:00", "b2")
    problems = vault.load("r3", "2026-01-07 00:00:00")
    assert set(problems) == {"link_ab"}
    assert {r.table_name: r.row_count for r in vault.counts().collect()}["hub_a"] == 4
    new = spark.read.parquet(vault.path("audit", "aud_table_load")).where("job_run_id IN ('r2b', 'r2c')")
    assert rows_of(new.select("job_run_id", "table_name", "staged", "accepted")) == [
        ("r2b", "hub_a", 3, 1), ("r2b", "sat_a_s1", 3, 2), ("r2c", "hub_a", 5, 0), ("r2c", "sat_a_s1", 6, 0)]
    runs = spark.read.parquet(vault.path("audit", "aud_load_run"))
    assert rows_of(runs.where("job_run_id = 'r3'").select("phase")) == [("opened",)]


def test_declared_order_picks_one_survivor(spark):
    entity = Entity("hub_a", "hub", ("code",), bindings=(Binding("f", "S", {"code": "a"}, dedup_by=("a",), dedup_order=("n",)),))
    feed = spark.createDataFrame([("1", 1, "x"), ("1", 2, "y"), ("1", 2, "z"), ("2", None, "w")], "a string, n int, v string")
    got = [rows_of(stage(feed.repartition(p), Model(entity), entity, entity.bindings[0], load_dts="2026-01-01 00:00:00").select("a", "n", "v")) for p in (1, 3)]
    assert got[0] == got[1] and [r[:2] for r in got[0]] == [("1", 2), ("2", None)]


@pytest.mark.parametrize("gate", ["refuse_duplicates", "refuse_imbalance"])
def test_a_failed_gate_leaves_no_visible_row(spark, tmp_path, monkeypatch, gate):
    """And the same run loads once it passes; a run that published and then stopped finds its own rows."""
    import lodestrata.vault as module
    model = Model(Entity("hub_a", "hub", ("code",), "SYS", bindings=(Binding("f", "S1", {"code": "a"}),)))
    vault = module.Vault(spark, str(tmp_path), model)
    vault.stage({"f": spark.createDataFrame([("1",), ("2",)], "a string")}, "2026-01-05 00:00:00", "b1")

    def refuse(*_, **__):
        raise ValueError("refused")
    with monkeypatch.context() as m:
        m.setattr(module, gate, refuse)
        assert vault.load("r=1", "2026-01-05 00:00:00") == {"hub_a": "refused"}
        assert vault.stored("hub_a").count() == 1 and vault.audit("aud_table_load", module.AUDIT_LOAD).count() == 0  # the ghost
    with monkeypatch.context() as m:
        m.setattr(vault, "_record", refuse)
        with pytest.raises(ValueError):
            vault.load("r1", "2026-01-05 00:00:00")
    assert vault.stored("hub_a").count() == 3
    assert vault.load("r1", "2026-01-05 00:00:00") == {} and vault.stored("hub_a").count() == 3
    assert rows_of(vault.audit("aud_table_load", module.AUDIT_LOAD).select("staged", "accepted")) == [(2, 2)]


def test_a_vault_counts_only_the_keys_its_log_names_where_none_is_broadcast(spark, tmp_path):
    from lodestrata.vault import AUDIT_DISCARD, Vault
    model = Model(Entity("hub_a", "hub", ("code",), "SYS", bindings=(Binding("f", "S1", {"code": "a"}),)))
    vault, limit = Vault(spark, str(tmp_path), model), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vault.stage({"f": spark.createDataFrame([("1",), ("2",), ("2",)], "a string")}, "2026-01-05 00:00:00", "b1")
        assert vault.load("r1", "2026-01-05 00:00:00") == {}
        vault.stage({"f": spark.createDataFrame([("2",), ("3",)], "a string")}, "2026-01-06 00:00:00", "b2")
        assert vault.load("r2", "2026-01-06 00:00:00", since="2026-01-05 00:00:00") == {}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lost = vault.audit("aud_table_discard", AUDIT_DISCARD).select("job_run_id", "discard_reason", "discarded")
    assert rows_of(lost) == [("r1", "already_present", 0), ("r1", "duplicate_in_batch", 1), ("r2", "already_present", 1), ("r2", "duplicate_in_batch", 0)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_log_whose_keys_come_once_is_not_shuffled(spark):
    columns = "hk string, load_dts timestamp, rec_src string, v int"
    once = spark.createDataFrame([("k", day(2), "s", 2), ("j", day(1), "t", 1), (None, day(1), "s", 0)], columns)
    first = load.load_unambiguous(once, None, "hk")
    assert "Exchange" not in plan(first) and "Window" not in plan(first) and rows_of(first) == rows_of(once)
    again = once.unionByName(spark.createDataFrame([("k", day(1), "s", 7), (None, day(1), "a", 8), (None, day(1), "a", 6)], columns))
    want = [("j", 1), ("k", 7), (None, 6)]
    for known in ("probe", None, dedup.repeated_hashes(again, "hk", few=2)):
        assert rows_of(dedup.first_write(again, "hk", repeated=known).select("hk", "v")) == want
    assert len(dedup.repeated_hashes(again, "hk")) == 2 and dedup.repeated_hashes(again, "hk", few=1) is None


def test_a_log_that_comes_again_is_told_apart_by_its_keys(spark, tmp_path):
    """Without broadcasts, as for tables too large for them."""
    columns = "hk string, load_dts timestamp, rec_src string, v int"
    rows = spark.createDataFrame([("k", day(2), "s", 2), ("j", day(1), "s", 3)], columns)
    more = rows.unionByName(spark.createDataFrame([("n", day(2), "s", 5), ("n", day(1), "s", 4), (None, day(1), "s", 6)], columns))
    rows.write.parquet(f"{tmp_path}/held")
    held, limit = spark.read.parquet(f"{tmp_path}/held"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        none = load.load_again(rows, held, "hk")
        assert "Exchange" not in plan(none) and none.count() == 0 and none.columns == rows.columns
        for few in (10, 2, 1):  # all new keys named, at the limit, above it
            assert rows_of(load.load_again(more, held, "hk", few=few).select("hk", "v")) == [("n", 4), (None, 6)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_load_without_large_keys_asks_for_no_cuts(spark, monkeypatch):
    rows = log(spark, ("k", None, "A", day(1), day(1)), ("k", None, "B", day(2), day(2)))
    want = stored(load.load_out_of_order(rows, rows.limit(1), "hk"))
    monkeypatch.setattr(load, "split_points", None)
    assert stored(load.load_out_of_order(rows, rows.limit(1), "hk")) == want
