"""The chunked plan for large keys must equal the window plan, row for row."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import day, rows_of
from lodestrata.operators import dedup, hierarchy, history, ledger, load
from lodestrata.operators.ordered import first_per_key, large_keys, ordered_scan, split_points

# Small enough that a test's largest key is cut into many chunks.
SKEW = {"floor": 60, "probe": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a tenth under another, one NULL key, the rest spread."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else "warm" if i % 10 == 1 else None if i % 50 == 2 else f"k{rng.randrange(300)}"
        rows.append((key, rng.randrange(2000), i, rng.randrange(100), rng.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "k string, at int, id int, n int, v string").repartition(7).persist()


def test_no_large_key_means_no_cut(skewed):
    assert split_points(skewed, ["k"], ["at", "id"]) is None
    keys, _ = large_keys(skewed, ["k"], floor=1500, probe=1.0)
    assert [r[0] for r in keys.collect()] == ["hot"]


def test_cuts_are_in_order_and_many(skewed):
    points = split_points(skewed, ["k"], ["at", "id"], **SKEW)
    cuts = {r["_k_k"]: [tuple(c) for c in r["_cuts"]] for r in points.collect()}
    assert {"hot", "warm"} <= set(cuts)
    assert len(cuts["hot"]) >= 20 and all(c == sorted(c) for c in cuts.values())


def test_chunked_scan_equals_window(skewed):
    ask = dict(sums={"total": F.col("n"), "nr": F.lit(1)}, maxima={"most": F.struct("n", "id")},
               prev={"before": F.col("v"), "before_id": F.col("id")}, following={"after": F.col("v"), "after_id": F.col("id")})
    plain = ordered_scan(skewed, ["k"], ["at", "id"], points=None, **ask)
    cut = ordered_scan(skewed, ["k"], ["at", "id"], points=split_points(skewed, ["k"], ["at", "id"], **SKEW), **ask)
    assert plain.columns == cut.columns and plain.schema.simpleString() == cut.schema.simpleString()
    assert rows_of(plain) == rows_of(cut)


def test_chunked_scan_with_a_null_in_the_order(spark):
    rows = [("h", None if i % 5 == 0 else i % 97, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, at int, id int")
    ask = dict(sums={"nr": F.lit(1)}, prev={"before": F.col("id")})
    points = split_points(df, ["k"], ["at", "id"], **SKEW)
    assert points is not None
    assert rows_of(ordered_scan(df, ["k"], ["at", "id"], points=None, **ask)) == rows_of(ordered_scan(df, ["k"], ["at", "id"], points=points, **ask))


def test_more_cuts_than_one_block(spark):
    df = spark.range(20000).select(F.lit("h").alias("k"), F.col("id").alias("at"))
    points = split_points(df, ["k"], ["at"], floor=41, probe=1.0)
    assert len(points.first()["_cuts"]) > 128
    out = ordered_scan(df, ["k"], ["at"], sums={"nr": F.lit(1)}, prev={"p": F.col("at")}, points=points)
    assert out.where("nr <> at + 1 OR NOT p <=> nullif(at - 1, -1)").count() == 0 and out.count() == 20000


def test_first_per_key_limits_before_the_shuffle(skewed):
    plan = first_per_key(skewed, ["k"], "at", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def satellite_log(spark, mas=False):
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(60)}"
        value = rng.choice("abc")
        rows.append((key, rng.choice(["m1", "m2", None]) if mas else "", value, day(1 + rng.randrange(5)), day(1, rng.randrange(24)), 0, rng.choice(["s1", "s2"]), "b"))
    rows += rows[:1500]
    return spark.createDataFrame(rows, "hk string, mas_key string, hashdiff string, load_dts timestamp, applied_dts timestamp, sub_seq int, rec_src string, batch_id string")


@pytest.mark.parametrize("mas", [None, "mas_key"])
def test_satellite_load_with_large_keys(spark, mas):
    log = satellite_log(spark, bool(mas)).persist()
    early = log.where(F.col("load_dts") < F.lit(day(3)))
    stored = load.load_satellite(early, None, "hk", mas).persist()
    for target in (None, stored):
        plain = load.load_satellite(log, target, "hk", mas)
        large = load.load_satellite(log, target, "hk", mas, **SKEW)
        assert plain.columns == large.columns == log.columns
        assert rows_of(plain) == rows_of(large)
    both = stored.unionByName(load.load_satellite(log, stored, "hk", mas))
    assert load.load_satellite(log, both, "hk", mas).count() == 0
    assert load.load_satellite(log, both, "hk", mas, **SKEW).count() == 0


def test_copies_of_a_version_with_a_map(spark):
    """The two plans store the same copy, whatever the types of its columns."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 9}", "", "abc"[i % 3 * (i % 2)], day(1 + i % 2), day(1, i % 5), 0, "s", f"b{i % 4}", {"n": i % 7}) for i in range(900)]
    log = spark.createDataFrame(rows, "hk string, mas_key string, hashdiff string, load_dts timestamp, applied_dts timestamp, sub_seq int, rec_src string, batch_id string, m map<string,int>")
    plain, large = (load.load_satellite(log.repartition(n), None, "hk", **kw) for n, kw in ((3, {}), (5, SKEW)))
    assert rows_of(plain) == rows_of(large) and plain.count()


def test_one_version_copied_many_times(spark):
    """A third of all rows are one row: no cut can separate them."""
    rows = [("hot", "", "a", day(1), day(1), 0, "s", "b")] * 500 + [("hot", "", "b", day(1), day(1, 2), 0, "s", "b"), ("k", "", "a", day(1), day(1), 0, "s", "b")]
    log = spark.createDataFrame(rows, "hk string, mas_key string, hashdiff string, load_dts timestamp, applied_dts timestamp, sub_seq int, rec_src string, batch_id string")
    want = [("hot", "a", 0), ("hot", "b", 500), ("k", "a", 0)]
    assert rows_of(load.load_satellite(log, None, "hk").select("hk", "hashdiff", "sub_seq")) == want
    assert rows_of(load.load_satellite(log, None, "hk", **SKEW).select("hk", "hashdiff", "sub_seq")) == want


def test_type2_and_group_size_with_large_keys(spark, skewed):
    sat = load.load_satellite(satellite_log(spark), None, "hk").persist()
    points = split_points(sat, ["hk"], history.HISTORY_ORDER, **SKEW)
    assert points is not None
    assert rows_of(history.type2(sat, "hk", points=None)) == rows_of(history.type2(sat, "hk", points=points))
    assert rows_of(dedup.with_group_size(skewed, ["k"])) == rows_of(dedup.with_group_size(skewed, ["k"], **SKEW))


def test_point_in_time_with_large_keys(spark):
    sat = load.load_satellite(satellite_log(spark), None, "hk").persist()
    spine = history.snapshot_spine(sat, "hk", "2026-01-01 00:00:00", "2026-01-02 00:00:00", 1)
    spine = spine.unionByName(spine.select("hk", (F.col("snapshot_dts") + F.expr("interval 7 hours")).alias("snapshot_dts")))
    got = history.point_in_time(spine, {"s": sat}, "hk", points=None)
    facts = [(r.hk, r.applied_dts, r.load_dts, r.sub_seq) for r in sat.collect()]
    want = []
    for r in spine.distinct().collect():
        best = max((f[1:] for f in facts if f[0] == r.hk and f[1] <= r.snapshot_dts), default=(None, None, None))
        want.append((r.hk, r.snapshot_dts, best[1], best[2]))
    assert rows_of(got) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def edges_and_questions(spark):
    rng = random.Random(9)
    edges, asked = [], []
    for i in range(1500):
        child = "hot" if i % 3 == 0 else f"c{rng.randrange(150)}"
        start = rng.randrange(1, 400)
        length = rng.choice([0, 1, 3, 400, None])
        if child != "hot" and rng.random() < 0.02:
            length = -2
        edges.append((child, rng.choice(["p1", "p2", "p3", " ", None]), None if rng.random() < 0.05 and child != "hot" else start,
                      None if length is None or child == "hot" and length == 400 else start + length))
        asked.append((child, rng.randrange(0, 420)))
    edges = [(c, p, s, e if c != "hot" else (s + 1)) for c, p, s, e in edges]
    to_date = [F.col("child"), F.col("parent"), F.expr("date_add(date'2026-01-01', a)").alias("from"), F.expr("date_add(date'2026-01-01', b)").alias("to")]
    e = spark.createDataFrame(edges, "child string, parent string, a int, b int")
    q = spark.createDataFrame(asked, "child string, d int")
    return edges, asked, e.select(*to_date), q.select("child", F.expr("date_add(date'2026-01-01', d)").alias("when"), "d")


def parent_then(edges, child, when):
    mine = [e for e in edges if e[0] == child]
    if any(a is not None and b is not None and a > b for _, _, a, b in mine):
        return None, "backwards"
    hits = [p for _, p, a, b in mine if (a is None or when >= a) and (b is None or when < b)]
    if not hits:
        return None, "none"
    if len(hits) > 1:
        return None, "ambiguous"
    return (None, "blank_parent") if hits[0] is None or not hits[0].strip() else (hits[0], "ok")


@pytest.mark.parametrize("chunked", [False, True])
def test_parent_as_of_against_brute_force(spark, chunked, monkeypatch):
    edges, asked, e, q = edges_and_questions(spark)
    if chunked:
        monkeypatch.setattr("lodestrata.operators.ordered.split_points.__kwdefaults__", {**SKEW, "known": None})
    got = hierarchy.parent_as_of(e, q).select("child", F.datediff("when", F.lit("2026-01-01").cast("date")), "parent", "status")
    want = {(c, w, *parent_then(edges, c, w)) for c, w in asked}
    assert rows_of(got) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert {"ok", "none", "ambiguous", "blank_parent", "backwards"} == {w[3] for w in want}


@pytest.mark.parametrize("chunked", [False, True])
def test_issue_lines_against_brute_force(spark, chunked, monkeypatch):
    if chunked:
        monkeypatch.setattr("lodestrata.operators.ordered.split_points.__kwdefaults__", {**SKEW, "known": None})
    rng = random.Random(4)
    lines, held = [], []
    refs = {}
    for i in range(900):
        inv = "hot" if i % 3 == 0 else f"i{rng.randrange(40)}"
        refs.setdefault(inv, []).append(f"r{i:04d}")
    for inv, names in refs.items():
        given = rng.choice([1, None])
        lines += [(inv, r, given) for r in names]
        for n, r in enumerate(rng.sample(names, rng.randrange(0, len(names)))):
            held.append((inv, r, n + 1, 1))
    lines += [("dup", "a", 1), ("dup", "a", 1), ("late", "a", 2), ("late", "b", 2), ("two", "a", None), ("two", "c", None), (" ", "a", 1), (None, "a", 1)]
    held += [("late", "a", 1, 1), ("two", "a", 1, 1), ("two", "b", 2, 2)]
    ls = spark.createDataFrame(lines, "inv string, ref string, d int").select("inv", "ref", F.expr("date_add(date'2026-01-01', d)").alias("day"))
    ld = spark.createDataFrame(held, "inv string, line_reference string, line_number int, d int").select(
        "inv", "line_reference", "line_number", F.expr("date_add(date'2026-01-01', d)").alias("invoice_date"))
    got = {(r.inv, r.line_reference, r.line_number) for r in ledger.issue_lines(ls, ld, ["inv"], "ref", "day").collect()}
    want = set()
    for inv, names in refs.items():
        mine = {r: n for i, r, n, _ in held if i == inv}
        if not mine and all(d is None for i, _, d in lines if i == inv):
            continue
        for n, r in enumerate(sorted(set(names) - set(mine))):
            want.add((inv, r, max(mine.values(), default=0) + 1 + n))
    assert got == want
    why = {r.inv: r.refusal for r in ledger.invoice_verdicts(ls, ld, ["inv"], "ref", "day").collect()}
    assert why["dup"] == "duplicate line reference" and why["late"].startswith("supplied date") and why["two"] == "several issued dates"
    assert why[" "] == why[None] == "blank invoice key"
