"""Windows, ordering and set operations, each in its bare shape."""

from pyspark.sql import functions as F

from lodestrata.functions.keys import hash_key
from lodestrata.operators import dedup, ledger, reports, unions
from lodestrata.operators.ordered import first_per_key, ordered_scan
from lodestrata.operators.quality import inventory
from lodestrata.plans.quality import S_RESULTS, conformance_results
from lodestrata.plans.registry import Tables, query, s_key
from lodestrata.plans.relations import INVOICE, S_LEDGER, S_LINES, invoice_lines, issued_ledger

EVENT_ORDER = ["ts", "event_id"]


@query("win1", """
SELECT 'first' AS which, user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 UNION ALL
SELECT 'last', user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def win1(t: Tables):
    e = t.events.select("user_id", "event_id", "ts")
    first = first_per_key(e, ["user_id"], *EVENT_ORDER).select(F.lit("first").alias("which"), "user_id", "event_id")
    last = first_per_key(e, ["user_id"], *[F.desc(c) for c in EVENT_ORDER]).select(F.lit("last").alias("which"), "user_id", "event_id")
    return first.unionByName(last)


@query("win2", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) - 1 AS sub_seq FROM events")
def win2(t: Tables):
    e = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    return ordered_scan(e, ["user_id", "day"], EVENT_ORDER, sums={"n": F.lit(1)}).select(
        "event_id", "user_id", (F.col("n") - 1).alias("sub_seq"))


@query("win3", "SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events")
def win3(t: Tables):
    return ordered_scan(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], EVENT_ORDER,
                        prev={"before": F.col("event_type")}).select("event_id", "user_id", "before")


@query("win4", """
SELECT event_id, user_id, cast(lead(ts) OVER w as varchar) AS valid_to, lead(event_id) OVER w IS NULL AS is_open FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win4(t: Tables):
    out = ordered_scan(t.events.select("event_id", "user_id", "ts"), ["user_id"], EVENT_ORDER,
                       following={"valid_to": F.col("ts"), "more": F.lit(True)})
    return out.select("event_id", "user_id", "valid_to", F.col("more").isNull().alias("is_open"))


@query("win5", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS in_group FROM lineitem")
def win5(t: Tables):
    return dedup.with_group_size(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"])


@query("win6", f"SELECT target, contract_table, job_run_id, status FROM ({S_RESULTS}) QUALIFY row_number() OVER (PARTITION BY target, contract_table ORDER BY recorded_at DESC) = 1")
def win6(t: Tables):
    return reports.latest_conformance(conformance_results(t)).select("target", "contract_table", "job_run_id", "status")


# Two thirds of the invoices carry one date; the others state several, and a ledger date conflicts.
S_NAMED = "CASE WHEN invoice % 17 = 5 AND l_partkey % 3 = 0 THEN NULL ELSE line_reference END"
S_DAY = "CASE WHEN invoice % 3 = 0 THEN day WHEN invoice % 3 = 1 THEN date '2002-01-31' END"
S_OFFERED = f"SELECT tenant, invoice, {S_NAMED} AS line_reference, {S_DAY} AS day, l_linestatus FROM ({S_LINES.replace('l_shipdate FROM', 'l_shipdate, l_partkey FROM')})"
S_HELD = f"SELECT *, CASE WHEN invoice % 10 = 3 AND line_number = 2 THEN date '2003-01-31' ELSE invoice_date END AS d FROM ({S_LEDGER})"
S_VERDICTS = f"""offered AS ({S_OFFERED}), held AS ({S_HELD}),
o AS (SELECT tenant, invoice, min(day) AS lo, max(day) AS hi, count(*) > count(DISTINCT line_reference) AS doubled, count(*) > count(line_reference) AS unnamed FROM offered GROUP BY 1, 2),
h AS (SELECT tenant, invoice, min(d) AS first, max(d) AS final, max(line_number) AS last_number FROM held GROUP BY 1, 2),
verdicts AS (SELECT tenant, invoice, coalesce(first, lo) AS frozen_date, coalesce(last_number, 0) AS last_number, CASE WHEN unnamed THEN 'blank line reference' WHEN doubled THEN 'duplicate line reference' WHEN first <> final THEN 'several issued dates'
  WHEN first IS NULL AND lo <> hi THEN 'several supplied dates' WHEN first IS NOT NULL AND (lo <> first OR hi <> first) THEN 'supplied date differs from the issued date' WHEN coalesce(first, lo) IS NULL THEN 'no invoice date' END AS refusal FROM o LEFT JOIN h USING (tenant, invoice))"""


def offered_lines(t: Tables):
    rows = invoice_lines(t, "l_partkey").withColumn("line_reference", F.expr(S_NAMED)).drop("l_partkey")
    return rows.withColumn("day", F.expr("CASE WHEN invoice % 3 = 0 THEN day WHEN invoice % 3 = 1 THEN date'2002-01-31' END"))


def held_ledger(t: Tables):
    return issued_ledger(t).withColumn("invoice_date", F.expr(
        "CASE WHEN invoice % 10 = 3 AND line_number = 2 THEN date'2003-01-31' ELSE invoice_date END"))


@query("win7", f"""
WITH {S_VERDICTS} SELECT tenant, invoice, o.line_reference, cast(v.last_number + row_number() OVER (PARTITION BY tenant, invoice ORDER BY o.line_reference) as int) AS line_number, cast(frozen_date as varchar) AS invoice_date
FROM offered o ANTI JOIN held h ON h.tenant = o.tenant AND h.invoice = o.invoice AND h.line_reference = o.line_reference JOIN verdicts v USING (tenant, invoice) WHERE refusal IS NULL""")
def win7(t: Tables):
    return ledger.issue_lines(offered_lines(t), held_ledger(t), INVOICE, "line_reference", "day")


@query("win8", f"WITH {S_VERDICTS} SELECT tenant, invoice, cast(frozen_date as varchar) AS frozen_date, last_number, refusal FROM verdicts")
def win8(t: Tables):
    return ledger.invoice_verdicts(offered_lines(t), held_ledger(t), INVOICE, "line_reference", "day")


@query("srt1", "SELECT o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 100")
def srt1(t: Tables):
    """Ordered before it is cut, so groups stay whole but for the last."""
    return t.orders.select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey").limit(100)


@query("srt2", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, o_orderkey")
def srt2(t: Tables):
    """Problems first."""
    return reports.problems_first(t.orders.select("o_orderkey", "o_orderstatus"), F.col("o_orderstatus") == "F", "o_orderkey")


@query("set1", """
SELECT cast(NULL as double) AS c_acctbal, NULL AS c_mktsegment, s_name AS name, s_nationkey AS nation, s_acctbal, 'supplier' AS origin FROM supplier UNION ALL
SELECT c_acctbal, c_mktsegment, c_name, c_nationkey, NULL, 'customer' FROM customer""")
def set1(t: Tables):
    return unions.aligned_union({
        "supplier": t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), "s_acctbal"),
        "customer": t.customer.select("c_mktsegment", F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"), "c_acctbal")}, "origin")


# An inventory out of the tables: each nation a table, each market segment a column, some under another name.
COLUMN = "CASE WHEN (c_nationkey + length(c_mktsegment)) % 4 = 0 THEN concat('OLD_', c_mktsegment) WHEN c_nationkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END"
S_INVENTORY = f"SELECT concat('n', c_nationkey) AS table_name, {COLUMN} AS column_name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 7 THEN 'int' ELSE 'string' END AS data_type FROM customer GROUP BY ALL"


def segment_inventory(t: Tables):
    return t.customer.select(
        F.concat(F.lit("n"), "c_nationkey").alias("table_name"), F.expr(f"{COLUMN} AS column_name"),
        F.expr("CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 7 THEN 'int' ELSE 'string' END AS data_type")).distinct()


@query("set2", f"""
SELECT lower(column_name) AS column_name, string_agg(DISTINCT data_type, ';' ORDER BY data_type) AS types FROM ({S_INVENTORY}) GROUP BY 1 HAVING count(DISTINCT data_type) > 1""")
def set2(t: Tables):
    return unions.mixed_types(segment_inventory(t))


@query("set3", f"""
WITH i AS ({S_INVENTORY}) SELECT 'MISSING_REQUIRED' AS finding, table_name, r AS detail FROM (SELECT DISTINCT table_name FROM i WHERE table_name LIKE 'n1%') CROSS JOIN (VALUES ('Building'), ('FURNITURE')) v(r)
WHERE concat(table_name, '/', lower(r)) NOT IN (SELECT concat(table_name, '/', lower(column_name)) FROM i)
UNION ALL SELECT 'ALIAS_CLASH', NULL, lower(a) FROM (VALUES ('buyer'), ('Buyer'), ('rate'), ('Machinery')) v(a) GROUP BY 3 HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'ALIAS_CLASH', table_name, lower(column_name) FROM i WHERE table_name LIKE 'n1%' AND lower(column_name) IN ('buyer', 'rate', 'machinery')
UNION ALL SELECT 'NO_TABLES', NULL, 'z%' FROM (SELECT count(*) AS n FROM i) WHERE n > 0""")
def set3(t: Tables):
    """One union over the tables of a pattern, and one whose pattern matches none."""
    inv = segment_inventory(t)
    return unions.union_findings(inv, "n1%", ["Building", "FURNITURE"], ["buyer", "Buyer", "rate", "Machinery"]).unionByName(
        unions.union_findings(inv, "z%", ["Building"], []))


@query("set4", "SELECT o_custkey, o_orderstatus FROM orders UNION ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def set4(t: Tables):
    """Copies stay."""
    o = t.orders.select("o_custkey", "o_orderstatus")
    return o.unionByName(o.where("o_orderstatus = 'F'"))


@query("set5", """
SELECT 'gone' AS side, k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') UNION ALL
SELECT 'both', k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def set5(t: Tables):
    f, o = (t.orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "FO")
    return f.subtract(o).select(F.lit("gone").alias("side"), "k").unionByName(f.intersect(o).select(F.lit("both").alias("side"), "k"))


@query("set6", f"SELECT DISTINCT {s_key(['l_orderkey', 'l_suppkey'], 'SALES')} AS hk FROM lineitem")
def set6(t: Tables):
    return t.lineitem.select(hash_key(["l_orderkey", "l_suppkey"], "SALES").alias("hk")).distinct()


@query("set_inventory", """
SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, n FROM (SELECT count(*) AS n FROM orders) UNION ALL SELECT 'orders', 'o_custkey', n FROM (SELECT count(*) AS n FROM orders) UNION ALL
SELECT 'customer', 'c_custkey', n FROM (SELECT count(*) AS n FROM customer)""")
def set_inventory(t: Tables):
    """The column inventory of two tables beside the rows each holds."""
    frames = {"orders": t.orders.select("o_orderkey", "o_custkey"), "customer": t.customer.select("c_custkey")}
    held = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n") for n, df in frames.items()]
    return inventory(t.spark, frames).join(held[0].unionByName(held[1]), "table_name").select("table_name", "column_name", "n")
