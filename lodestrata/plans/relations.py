"""Joins and hierarchies."""

from pyspark.sql import functions as F

from lodestrata.functions.keys import zero_key
from lodestrata.operators import hierarchy, history, invoices, ledger, load, reconcile
from lodestrata.operators.ordered import ordered_scan
from lodestrata.plans.registry import Tables, query, s_money
from lodestrata.plans.loading import CODING, S_CODED, coded_lines
from lodestrata.plans.warehouse import (
    HALF, S_LINE_ORDER, S_USER_LOG, before_half, log_of, s_load, staged, user_log,
)


@query("jn1", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def jn1(t: Tables):
    held = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(held, "c_custkey", "left_anti")


@query("jn2", """
WITH a AS (SELECT event_id, user_id, nullif(event_type, 'view') AS kind, date_trunc('day', ts) AS d FROM events),
x AS (SELECT user_id, nullif(event_type, 'view') AS kind, date_trunc('day', ts) AS d FROM events WHERE value > 60)
SELECT event_id FROM a WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.user_id = a.user_id AND x.d = a.d AND x.kind IS NOT DISTINCT FROM a.kind)""")
def jn2(t: Tables):
    rows = t.events.select("event_id", "user_id", F.nullif("event_type", F.lit("view")).alias("kind"), F.to_date("ts").alias("d"), "value")
    return load.absent_from(rows, rows.where("value > 60"), ["user_id", "d", "kind"]).select("event_id")


@query("jn3", f"""
WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'stored', f"load_dts < timestamp '{HALF}' AND tier = 'high'")},
latest AS (SELECT hk, hd FROM stored QUALIFY row_number() OVER (PARTITION BY hk ORDER BY load_dts DESC, sub_seq DESC) = 1)
SELECT ulog.hk AS hub_user_hk, cast(applied_dts as varchar) AS applied_dts, latest.hd AS latest_hashdiff FROM ulog LEFT JOIN latest ON latest.hk = ulog.hk""")
def jn3(t: Tables):
    """Every log row beside the stored latest version of its key, where there is one."""
    held = load.load_satellite(before_half(user_log(t)).where("tier = 'high'"), None, "hub_user_hk")
    latest = load.latest_version(held, ["hub_user_hk"])
    return history.seeded_by_latest(user_log(t).select("hub_user_hk", "applied_dts"), latest, ["hub_user_hk"], "hashdiff")


S_CODED_FULL = S_CODED.replace(" AS rule_version", " AS rule_version, l_orderkey, l_linenumber, l_extendedprice")


@query("jn4", f"""
WITH {S_CODED_FULL} SELECT hk AS nhl_order_line_hk, {', '.join(CODING)}, l_linenumber, cast({s_money('l_extendedprice')} as double) AS l_extendedprice, cast(l_orderkey as varchar) AS order_key
FROM coded WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def jn4(t: Tables):
    """Computed values, their line and its order."""
    computed = coded_lines(t).select("nhl_order_line_hk", *CODING, "load_dts", "sub_seq")
    lines = log_of(t, "nhl_order_line").select("nhl_order_line_hk", "hub_order_hk", "l_linenumber", "l_extendedprice")
    hub = log_of(t, "hub_order").select("hub_order_hk", "order_key")
    return invoices.star(computed, lines, hub, "nhl_order_line_hk", "hub_order_hk").drop("hub_order_hk")


# Half of the lines are issued already; a line is named by its part and supplier within its order.
S_REF = "concat(l_linenumber, '-', l_partkey, '-', l_suppkey)"
S_LINES = f"SELECT concat('T', l_orderkey % 4) AS tenant, l_orderkey AS invoice, {S_REF} AS line_reference, cast(strftime(l_shipdate, '%Y') || '-01-31' as date) AS day, l_linestatus, l_shipdate FROM lineitem"
S_LEDGER = f"SELECT tenant, invoice, line_reference, cast(row_number() OVER (PARTITION BY tenant, invoice ORDER BY line_reference) as int) AS line_number, date '2002-01-31' AS invoice_date FROM ({S_LINES}) WHERE l_linestatus = 'F'"
INVOICE = ["tenant", "invoice"]


def invoice_lines(t: Tables, *more: str):
    return t.lineitem.select(
        F.concat(F.lit("T"), F.col("l_orderkey") % 4).alias("tenant"), F.col("l_orderkey").alias("invoice"), F.expr(S_REF).alias("line_reference"),
        F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(31)).alias("day"), "l_linestatus", "l_shipdate", *more)


def issued_ledger(t: Tables):
    held = invoice_lines(t).where("l_linestatus = 'F'").select(*INVOICE, "line_reference")
    numbered = ordered_scan(held, INVOICE, ["line_reference"], sums={"line_number": F.lit(1)})
    return numbered.withColumns({"line_number": F.col("line_number").cast("int"), "invoice_date": F.make_date(F.lit(2002), F.lit(1), F.lit(31))})


@query("jn5", f"""
SELECT tenant, invoice, line_reference, line_number, CASE WHEN line_number IS NULL THEN 'not issued' ELSE 'issued' END AS issuance
FROM ({S_LINES}) LEFT JOIN ({S_LEDGER}) USING (tenant, invoice, line_reference)""")
def jn5(t: Tables):
    return invoices.with_ledger(invoice_lines(t), issued_ledger(t), [*INVOICE, "line_reference"]).select(
        *INVOICE, "line_reference", "line_number", "issuance")


@query("jn6", f"SELECT tenant, invoice, line_reference FROM ({S_LINES}) l ANTI JOIN ({S_LEDGER}) USING (tenant, invoice, line_reference)")
def jn6(t: Tables):
    return ledger.unissued(invoice_lines(t).select(*INVOICE, "line_reference"), issued_ledger(t), [*INVOICE, "line_reference"])


# Manifests: one per customer, approving its orders; 'P' orders were rejected, some of those superseded.
S_MANIFEST = "SELECT cast(c_custkey as varchar) AS manifest_id, c_custkey % 20 AS approved_count FROM customer WHERE c_acctbal > 0"
S_SIDES = """landed AS (SELECT cast(o_custkey as varchar) AS manifest_id FROM orders WHERE o_orderstatus <> 'P'),
rejected AS (SELECT cast(o_custkey as varchar) AS manifest_id FROM orders WHERE o_orderstatus = 'P'),
superseded AS (SELECT cast(o_custkey as varchar) AS manifest_id FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 400000)"""
S_COUNTS = f"""counts AS (SELECT m.*, (SELECT count(*) FROM landed x WHERE x.manifest_id = m.manifest_id) AS landed,
 (SELECT count(*) FROM rejected x WHERE x.manifest_id = m.manifest_id) AS quarantined, (SELECT count(*) FROM superseded x WHERE x.manifest_id = m.manifest_id) AS superseded FROM manifest m)"""
S_MANIFESTS = f"manifest AS ({S_MANIFEST}), {S_SIDES}, {S_COUNTS}"


def manifests(t: Tables):
    o = t.orders.withColumn("manifest_id", F.col("o_custkey").cast("string"))
    manifest = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("manifest_id"), (F.col("c_custkey") % 20).alias("approved_count"))
    return (manifest, o.where("o_orderstatus <> 'P'").select("manifest_id"), o.where("o_orderstatus = 'P'").select("manifest_id"),
            o.where("o_orderpriority = '1-URGENT' OR o_totalprice > 400000").select("manifest_id"))


@query("jn7", f"WITH {S_MANIFESTS} SELECT * FROM counts")
def jn7(t: Tables):
    return reconcile.manifest_counts(*manifests(t))


@query("jn8", f"""
WITH {S_SIDES}, r AS (SELECT manifest_id, count(*) AS n FROM rejected GROUP BY 1), s AS (SELECT manifest_id, count(*) AS n FROM superseded GROUP BY 1)
SELECT coalesce(r.manifest_id, s.manifest_id) AS manifest_id, coalesce(r.n, 0) AS quarantined, coalesce(s.n, 0) AS superseded FROM r FULL JOIN s ON r.manifest_id = s.manifest_id""")
def jn8(t: Tables):
    _, _, rejected, superseded = manifests(t)
    return reconcile.superseded_against_rejected(rejected, superseded)


# Two ledgers of the same business: lines by brand and year, orders as the journal.
S_DETAIL = "SELECT p_brand AS account, year(l_shipdate) AS period, sum(cast(l_extendedprice as decimal(18,2))) AS detail_amount FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 3 GROUP BY 1, 2"
S_JOURNAL = """SELECT p_brand AS account, year(l_shipdate) AS period, sum(CASE WHEN p_size > 40 AND year(l_shipdate) = 1997 THEN cast(0 as decimal(18,2)) ELSE cast(l_extendedprice as decimal(18,2)) END) AS journal_amount
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 3 AND NOT (p_brand = 'Brand#3' AND year(l_shipdate) = 1999) GROUP BY 1, 2
UNION ALL SELECT 'Brand#99', 1998, sum(cast(o_totalprice as decimal(18,2))) FROM orders"""
BUCKET = ["account", "period"]


def two_ledgers(t: Tables):
    """(detail, classification, journal): the journal drops some amounts, lacks one bucket and holds one more."""
    detail = t.lineitem.select("l_partkey", F.year("l_shipdate").alias("period"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    classification = t.part.where("p_size > 3").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("account"), "p_size")
    booked = detail.join(classification, "l_partkey").where("NOT (account = 'Brand#3' AND period = 1999)").select(
        *BUCKET, F.when((F.col("p_size") > 40) & (F.col("period") == 1997), F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount")).alias("booked"))
    extra = t.orders.select(F.lit("Brand#99").alias("account"), F.lit(1998).alias("period"), F.col("o_totalprice").cast("decimal(18,2)").alias("booked"))
    return detail, classification.drop("p_size"), booked.unionByName(extra)


@query("jn9", f"SELECT account, cast(period as int) AS period, cast(detail_amount as double) AS detail_amount FROM ({S_DETAIL})")
def jn9(t: Tables):
    detail, classification, _ = two_ledgers(t)
    return reconcile.rollup_detail(detail, classification, "l_partkey", BUCKET, "amount")


@query("jn10", f"""
SELECT account, cast(period as int) AS period, cast(journal_amount as double) AS journal_amount, cast(detail_amount as double) AS detail_amount, cast(journal_amount - coalesce(detail_amount, 0) as double) AS difference
FROM ({S_JOURNAL}) LEFT JOIN ({S_DETAIL}) USING (account, period) WHERE detail_amount IS NULL OR abs(journal_amount - detail_amount) > 0.05""")
def jn10(t: Tables):
    detail, classification, journal = two_ledgers(t)
    sums = journal.groupBy(*BUCKET).agg(F.sum("booked").alias("journal_amount"))
    return reconcile.compare_buckets(sums, reconcile.rollup_detail(detail, classification, "l_partkey", BUCKET, "amount"), BUCKET)


@query("jn11", f"SELECT account, cast(period as int) AS period, cast(detail_amount as double) AS detail_amount FROM ({S_DETAIL}) d ANTI JOIN ({S_JOURNAL}) USING (account, period)")
def jn11(t: Tables):
    detail, classification, journal = two_ledgers(t)
    return reconcile.orphan_buckets(journal, reconcile.rollup_detail(detail, classification, "l_partkey", BUCKET, "amount"), BUCKET)


@query("jn12", f"""
WITH m AS ({S_MANIFEST}), o AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN cast(o_custkey as varchar) END AS manifest_id FROM orders)
SELECT manifest_id, count(*) AS row_count FROM o WHERE manifest_id IS NULL OR manifest_id NOT IN (SELECT manifest_id FROM m) GROUP BY 1""")
def jn12(t: Tables):
    rows = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("manifest_id"))
    return reconcile.unaccounted(rows, manifests(t)[0])


# Dated edges: a customer's parent is the priority of its last order, until the next one. Some
# edges are open at the start, some have no parent, some customers have a backwards edge, and
# orders of one customer on one day make two parents for that day.
S_EDGES = """SELECT o_custkey AS child, CASE WHEN o_orderkey % 40 = 0 THEN ' ' ELSE o_orderpriority END AS parent,
  CASE WHEN o_custkey % 9 = 0 AND before IS NULL THEN NULL ELSE day END AS from_day, CASE WHEN o_orderkey % 1500 = 3 THEN day - 1 WHEN o_orderkey % 30 = 1 THEN day + 400 ELSE after END AS to_day
FROM (SELECT *, cast(o_orderdate as date) AS day, lag(o_orderkey) OVER w AS before, lead(cast(o_orderdate as date)) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""
S_ANSWERS = f"""edges AS ({S_EDGES}), asked AS (SELECT DISTINCT o_custkey AS child, cast(l_shipdate as date) AS day FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
backs AS (SELECT DISTINCT child FROM edges WHERE from_day > to_day),
hits AS (SELECT a.child, a.day, count(e.child) AS n, min(e.parent) AS parent FROM asked a LEFT JOIN edges e ON e.child = a.child AND (e.from_day IS NULL OR a.day >= e.from_day) AND (e.to_day IS NULL OR a.day < e.to_day) GROUP BY 1, 2),
answers AS (SELECT child, day, CASE WHEN child IN (SELECT child FROM backs) THEN 'backwards' WHEN n = 0 THEN 'none' WHEN n > 1 THEN 'ambiguous' WHEN trim(parent) = '' THEN 'blank_parent' ELSE 'ok' END AS status, parent AS found FROM hits)"""


def dated_edges(t: Tables):
    o = t.orders.withColumn("day", F.to_date("o_orderdate")).withColumn("one", F.lit(1))
    seq = ordered_scan(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], prev={"before": F.col("one")}, following={"after": F.col("day")})
    return seq.select(
        F.col("o_custkey").alias("child"), F.when(F.expr("o_orderkey % 40 = 0"), " ").otherwise(F.col("o_orderpriority")).alias("parent"),
        F.when(F.expr("o_custkey % 9 = 0 AND before IS NULL"), None).otherwise(F.col("day")).alias("from"),
        F.expr("CASE WHEN o_orderkey % 1500 = 3 THEN date_sub(day, 1) WHEN o_orderkey % 30 = 1 THEN date_add(day, 400) ELSE after END").alias("to"))


def dated_facts(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("child"))
    return t.lineitem.select("l_orderkey", F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")).join(orders, "l_orderkey")


@query("jn13", f"WITH {S_ANSWERS} SELECT child, cast(day as varchar) AS day, CASE WHEN status = 'ok' THEN found END AS parent, status FROM answers")
def jn13(t: Tables):
    return hierarchy.parent_as_of(dated_edges(t), dated_facts(t), "child", "day")


@query("jn14", f"""
WITH {S_ANSWERS}, facts AS (SELECT o_custkey AS child, cast(l_shipdate as date) AS day, {s_money('l_extendedprice')} AS amount FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT CASE WHEN status = 'ok' THEN found WHEN status = 'none' THEN cast(child as varchar) END AS rollup_key, status AS parent_status, count(*) AS fact_count, cast(sum(amount) as double) AS amount
FROM facts JOIN answers USING (child, day) GROUP BY 1, 2""")
def jn14(t: Tables):
    """Line amounts by group on the day of the line; unsafe answers stay apart."""
    return hierarchy.rollup_sums(dated_edges(t), dated_facts(t), "child", "day", ["amount"])


@query("jn15", """
SELECT DISTINCT o_custkey AS child, o_orderpriority AS parent FROM orders WHERE o_orderstatus = 'F' INTERSECT
SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'""")
def jn15(t: Tables):
    edges = t.orders.select(F.col("o_custkey").alias("child"), F.col("o_orderpriority").alias("parent"), "o_orderstatus")
    return hierarchy.edge_overlap(edges.where("o_orderstatus = 'F'"), edges.where("o_orderstatus = 'O'"))


@query("jn16", """
SELECT count(*) AS line_count, 'hub_order_hk' AS parent, count(*) FILTER (l_linenumber = 7) AS ghosts FROM lineitem UNION ALL
SELECT count(*), 'hub_part_hk', cast(0 as bigint) FROM lineitem""")
def jn16(t: Tables):
    """Lines whose order is not known yet resolve to the zero key."""
    lines = staged(t, "nhl_order_line").withColumn(
        "hub_order_hk", F.when(F.col("l_linenumber") == 7, zero_key()).otherwise(F.col("hub_order_hk")))
    return reconcile.ghost_parents(lines, ["hub_order_hk", "hub_part_hk"])


@query("jn16_orphans", f"""
SELECT {S_LINE_ORDER} AS hub_order_hk, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def jn16_orphans(t: Tables):
    """Lines whose order has not arrived in the hub."""
    hub = staged(t, "hub_order").where("o_orderstatus <> 'P'")
    return reconcile.orphan_lines(staged(t, "nhl_order_line"), hub, "hub_order_hk").select("hub_order_hk", "l_linenumber", "l_partkey")
