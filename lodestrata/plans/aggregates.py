"""Reconciliation, audit reports, invoices, fingerprints and drift."""

from pyspark.sql import functions as F

from lodestrata.functions.keys import hash_key, row_digest
from lodestrata.operators import fingerprint, invoices, reconcile, reports, snapshots
from lodestrata.operators.load import ghost
from lodestrata.plans.loading import S_DISCARDS, S_LOADS, audit_discards, audit_loads
from lodestrata.plans.registry import Tables, query, s_diff, s_key, s_money
from lodestrata.plans.relations import (
    BUCKET, S_DETAIL, S_JOURNAL, S_MANIFESTS, S_SIDES, manifests, two_ledgers,
)
from lodestrata.plans.warehouse import S_LINE_ORDER, S_ORDER, staged

# Lines as journal lines: returned and kept goods are debits, the rest credits.
S_DC = f"""SELECT l_orderkey AS journal, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN {s_money('l_extendedprice')} END AS debit,
  CASE WHEN l_returnflag = 'N' THEN {s_money('l_extendedprice')} END AS credit FROM lineitem"""


def journal_lines(t: Tables):
    amount, flag = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_returnflag")
    return t.lineitem.select(F.col("l_orderkey").alias("journal"), "l_linenumber",
                             F.when(flag != "N", amount).alias("debit"), F.when(flag == "N", amount).alias("credit"))


@query("agg1", f"""
SELECT journal, cast(sum(debit) as double) AS debit, cast(sum(credit) as double) AS credit, count(*) AS line_count,
  cast(coalesce(sum(debit), 0) - coalesce(sum(credit), 0) as double) AS difference FROM ({S_DC}) GROUP BY 1 HAVING abs(coalesce(sum(debit), 0) - coalesce(sum(credit), 0)) > 0.005""")
def agg1(t: Tables):
    return reconcile.unbalanced(journal_lines(t), "journal", "debit", "credit")


@query("agg2", f"""
WITH half AS (SELECT l_orderkey AS journal, sum({s_money('l_extendedprice')}) / 2 AS half_turnover FROM lineitem GROUP BY 1),
head AS (SELECT o_orderkey AS journal, CASE WHEN o_orderkey % 3 = 0 THEN half_turnover WHEN o_orderkey % 7 > 0 THEN {s_money('o_totalprice')} END AS control_total FROM orders LEFT JOIN half ON journal = o_orderkey)
SELECT journal, cast(half_turnover as double) AS half_turnover, cast(control_total as double) AS control_total FROM half JOIN head USING (journal) WHERE control_total IS NOT NULL AND abs(control_total - half_turnover) > 0.005""")
def agg2(t: Tables):
    """Control totals against half the turnover, for the current version of each header."""
    half = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")) / 2).alias("half"))
    heads = t.orders.join(half, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("journal"), F.when(F.expr("o_orderkey % 3 = 0"), F.col("half")).when(
            F.expr("o_orderkey % 7 > 0"), F.col("o_totalprice").cast("decimal(18,2)")).alias("control_total"), F.lit(2).alias("sub_seq"))
    older = heads.withColumns({"control_total": F.lit(1).cast("decimal(38,6)"), "sub_seq": F.lit(1)})
    both = heads.unionByName(older).withColumn("load_dts", F.lit("2026-01-01").cast("timestamp"))
    return reconcile.control_totals(journal_lines(t), both, "journal", "debit", "credit", "control_total")


# Line numbers as text; some are missing and some are no numbers.
NUMBER = "CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 2 THEN NULL WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 'first' ELSE cast(l_linenumber as {text}) END"


@query("agg3", f"""
SELECT journal, count(*) AS line_count, count(DISTINCT n) AS distinct_numbers, max(n) AS highest FROM (SELECT l_orderkey AS journal, try_cast({NUMBER.format(text='varchar')} as int) AS n FROM lineitem) GROUP BY 1
HAVING count(*) <> count(DISTINCT n) OR coalesce(max(n), 0) <> count(*)""")
def agg3(t: Tables):
    """Beside the journals stands the ghost, which has no number and is no line."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("journal"), F.expr(NUMBER.format(text="string")).alias("number"), F.lit("SALES").alias("rec_src"))
    ghost = t.spark.range(1).select(F.lit(-1).cast("long").alias("journal"), F.lit(None).cast("string").alias("number"), F.lit("SYSTEM").alias("rec_src"))
    return reconcile.line_gaps(lines.unionByName(ghost), "journal", "number")


@query("agg4", """
SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders WHERE o_totalprice < 5000) AS violations FROM orders WHERE o_totalprice < 5000 ORDER BY o_orderkey LIMIT 25""")
def agg4(t: Tables):
    """All violations are counted, a bounded ordered sample of them is shown."""
    return reconcile.violations(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), F.col("o_totalprice") < 5000, ["o_orderkey"]).drop("o_totalprice")


@query("agg5", f"""
WITH b AS (SELECT *, coalesce(journal_amount, 0) - coalesce(detail_amount, 0) AS d FROM ({S_JOURNAL}) FULL JOIN ({S_DETAIL}) USING (account, period))
SELECT account, cast(period as int) AS period, cast(journal_amount as double) AS journal_amount, cast(detail_amount as double) AS detail_amount, cast(d as double) AS difference,
  CASE WHEN journal_amount IS NULL THEN 'ORPHAN_DETAIL' WHEN detail_amount IS NULL THEN 'NO_DETAIL' ELSE 'VARIANCE' END AS finding
FROM b WHERE journal_amount IS NULL OR detail_amount IS NULL OR abs(d) > 0.05""")
def agg5(t: Tables):
    detail, classification, journal = two_ledgers(t)
    return reconcile.reconcile_aggregate(detail, classification, journal, "l_partkey", BUCKET, "amount", "booked")


@query("agg6", f"WITH {S_MANIFESTS} SELECT *, landed + quarantined - superseded - approved_count AS variance FROM counts WHERE landed + quarantined - superseded <> approved_count")
def agg6(t: Tables):
    return reconcile.manifest_identity(*manifests(t))


@query("agg7", f"""
WITH {S_SIDES}, r AS (SELECT manifest_id, count(*) AS n FROM rejected GROUP BY 1), s AS (SELECT manifest_id, count(*) AS n FROM superseded GROUP BY 1)
SELECT s.manifest_id, coalesce(r.n, 0) AS quarantined, s.n AS superseded FROM s LEFT JOIN r ON r.manifest_id = s.manifest_id WHERE s.n > coalesce(r.n, 0)""")
def agg7(t: Tables):
    _, _, rejected, superseded = manifests(t)
    return reconcile.over_subtracted(rejected, superseded)


@query("agg8", f"""
WITH e AS (SELECT count(*) AS expected FROM (SELECT DISTINCT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') FROM lineitem)),
l AS (SELECT count(DISTINCT {S_LINE_ORDER}) AS landed FROM lineitem), q AS (SELECT count(*) AS quarantined FROM lineitem WHERE l_quantity < 3), s AS (SELECT count(*) AS superseded FROM lineitem WHERE l_quantity < 2)
SELECT *, expected - (landed + quarantined - superseded) AS variance, CASE WHEN expected = 0 THEN 'NOT_EVALUATED' WHEN expected = landed + quarantined - superseded THEN 'PASSED' ELSE 'FAILED' END AS status FROM e, l, q, s""")
def agg8(t: Tables):
    """Keys the feed holds against those that arrived; the ghost row does not count."""
    feed = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    landed = staged(t, "nhl_order_line").select("hub_order_hk", "load_dts")
    return reconcile.landing_variance(feed, ["l_orderkey", "l_linenumber", "flag"], landed.unionByName(ghost(landed)), "hub_order_hk",
                                      t.lineitem.where("l_quantity < 3"), t.lineitem.where("l_quantity < 2"))


@query("agg9", "SELECT count(*) AS expected FROM (SELECT DISTINCT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END FROM orders)")
def agg9(t: Tables):
    """Joined as text, (NULL, x) and (x, NULL) would be one key."""
    rows = t.orders.select("o_custkey", F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS a"), F.expr("CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS b"))
    return reconcile.expected_keys(rows, ["o_custkey", "a", "b"])


# Landed, rejected and pending rows of the same content: the digest covers customer, year and priority.
S_DIGEST = s_diff([S_ORDER.replace("o_orderkey", "o_custkey"), "year(o_orderdate)", "o_orderpriority"])
S_DIGESTS = f"""d AS (SELECT CASE WHEN o_custkey % 13 > 0 THEN cast(o_custkey % 50 as varchar) END AS manifest_id, {S_DIGEST} AS digest, o_orderstatus, o_totalprice FROM orders),
landed AS (SELECT manifest_id, digest, count(*) AS landed FROM d WHERE o_orderstatus = 'F' GROUP BY 1, 2), quarantined AS (SELECT manifest_id, digest, count(*) AS quarantined FROM d WHERE o_orderstatus = 'O' GROUP BY 1, 2),
recorded AS (SELECT manifest_id, digest, count(*) FILTER (o_totalprice < 300000) AS recorded, count(*) FILTER (o_totalprice >= 300000) AS stale FROM d WHERE o_totalprice > 200000 GROUP BY 1, 2)"""


def digests(t: Tables):
    """(landed, quarantined, recorded) counts per manifest and digest."""
    rows = t.orders.select(
        F.when(F.expr("o_custkey % 13 > 0"), (F.col("o_custkey") % 50).cast("string")).alias("manifest_id"),
        hash_key(["o_custkey"], "SALES").alias("hk"), F.year("o_orderdate").alias("year"), "o_orderpriority", "o_orderstatus", "o_totalprice")
    cols, hks = ["year", "o_orderpriority"], ["hk"]
    records = rows.where("o_totalprice > 200000").select("manifest_id", row_digest(cols, hks).alias("digest"), F.when(
        F.expr("o_totalprice >= 300000"), "1").otherwise("2").alias("rulebook_version"))
    return (reconcile.digest_counts(rows.where("o_orderstatus = 'F'"), cols, hks, "landed"),
            reconcile.digest_counts(rows.where("o_orderstatus = 'O'"), cols, hks, "quarantined"), reconcile.current_records(records, "2"))


@query("agg10", f"""
WITH {S_DIGESTS} SELECT q.manifest_id, q.digest, least(l.landed, q.quarantined) - coalesce(r.recorded, 0) AS shortfall FROM quarantined q
JOIN landed l ON l.manifest_id IS NOT DISTINCT FROM q.manifest_id AND l.digest = q.digest LEFT JOIN recorded r ON r.manifest_id IS NOT DISTINCT FROM q.manifest_id AND r.digest = q.digest
WHERE least(l.landed, q.quarantined) > coalesce(r.recorded, 0)""")
def agg10(t: Tables):
    return reconcile.supersede_shortfall(*digests(t))


@query("agg11", f"""
WITH {S_DIGESTS} SELECT r.manifest_id, r.digest, r.recorded, coalesce(q.quarantined, 0) AS quarantined FROM recorded r
LEFT JOIN quarantined q ON r.manifest_id IS NOT DISTINCT FROM q.manifest_id AND r.digest = q.digest WHERE r.recorded > coalesce(q.quarantined, 0)""")
def agg11(t: Tables):
    _, quarantined, recorded = digests(t)
    return reconcile.orphaned_records(recorded, quarantined)


@query("agg12", f"WITH {S_DIGESTS} SELECT manifest_id, digest, recorded, stale FROM recorded")
def agg12(t: Tables):
    return digests(t)[2]


@query("agg16", f"""
WITH d AS (SELECT job_run_id, table_name, sum(discarded) AS discarded FROM ({S_DISCARDS}) GROUP BY 1, 2)
SELECT job_run_id, table_name, staged, accepted, cast(coalesce(discarded, 0) as bigint) AS discarded FROM ({S_LOADS}) LEFT JOIN d USING (job_run_id, table_name) WHERE staged - accepted <> coalesce(discarded, 0)""")
def agg16(t: Tables):
    return reports.unbalanced_audit(audit_loads(t), audit_discards(t))


# Run phases: a run per day and user, opened by clicks and views, completed by purchases.
S_RUNS = """SELECT concat('run', dayofyear(ts), '/', user_id) AS job_run_id, concat('t', user_id % 3) AS target, CASE WHEN event_type = 'purchase' THEN 'completed' ELSE 'opened' END AS phase, ts AS recorded_at
FROM events WHERE event_type IN ('click', 'view', 'purchase')"""
S_RUN_LOADS = "SELECT DISTINCT concat('run', dayofyear(ts), '/', user_id) AS job_run_id FROM events"


def run_of_event():
    return F.concat(F.lit("run"), F.dayofyear("ts"), F.lit("/"), "user_id")


def run_phases(t: Tables):
    return t.events.where(F.col("event_type").isin("click", "view", "purchase")).select(
        run_of_event().alias("job_run_id"), F.concat(F.lit("t"), F.col("user_id") % 3).alias("target"),
        F.when(F.col("event_type") == "purchase", "completed").otherwise("opened").alias("phase"), F.col("ts").alias("recorded_at"))


@query("agg17", f"""
WITH r AS ({S_RUNS}), l AS ({S_RUN_LOADS}),
m AS (SELECT job_run_id, concat_ws(';', CASE WHEN job_run_id NOT IN (SELECT job_run_id FROM r WHERE phase = 'completed') THEN 'completed' END, CASE WHEN job_run_id NOT IN (SELECT job_run_id FROM r WHERE phase = 'opened') THEN 'opened' END) AS missing_phases FROM l)
SELECT * FROM m WHERE missing_phases <> ''""")
def agg17(t: Tables):
    return reports.unclosed_runs(t.events.select(run_of_event().alias("job_run_id")), run_phases(t))


@query("agg18", """
WITH last AS (SELECT user_id AS k, max(ts) AS last_loaded FROM events GROUP BY 1), sla AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_custkey % 48 + 1 END AS sla_hours FROM customer)
SELECT concat('t', k) AS table_name, cast(sla_hours as bigint) AS sla_hours, cast(last_loaded as varchar) AS last_loaded, CASE WHEN sla_hours = 0 THEN 'EXEMPT' WHEN sla_hours IS NULL OR last_loaded IS NULL THEN 'NOT_EVALUATED'
  WHEN epoch(date_trunc('second', timestamp '2024-01-31 00:00:00')) - epoch(date_trunc('second', last_loaded)) > sla_hours * 3600 THEN 'STALE' ELSE 'FRESH' END AS status FROM sla LEFT JOIN last USING (k)""")
def agg18(t: Tables):
    """Every customer's table; those without an event were never loaded, and some declare no SLA."""
    audit = t.events.select(F.concat(F.lit("t"), "user_id").alias("table_name"), F.col("ts").alias("recorded_at"))
    sla = t.customer.select(F.concat(F.lit("t"), "c_custkey").alias("table_name"), F.expr("CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_custkey % 48 + 1 END AS sla_hours"))
    return reports.freshness(audit, sla, "2024-01-31 00:00:00").drop("age_seconds")


@query("agg19", f"SELECT job_run_id, table_name, 'loader' AS written_by, staged, accepted, staged - accepted AS not_accepted, cast(recorded_at as varchar) AS recorded_at FROM ({S_LOADS})")
def agg19(t: Tables):
    return reports.load_volume(audit_loads(t))


@query("agg20", f"SELECT table_name, discard_reason, cast(sum(discarded) as bigint) AS discarded, count(DISTINCT job_run_id) AS runs FROM ({S_DISCARDS}) GROUP BY 1, 2")
def agg20(t: Tables):
    return reports.discards_by_reason(audit_discards(t))


S_EMPTY_RUNS = f"SELECT table_name, CASE WHEN table_name = 'view' THEN 0 ELSE staged END AS staged, CASE WHEN table_name = 'view' THEN 0 ELSE accepted END AS accepted FROM ({S_LOADS})"


@query("agg21", f"""
SELECT table_name, cast(sum(staged) as bigint) AS denominator, cast(sum(accepted) as bigint) AS accepted, CASE WHEN sum(staged) > 0 THEN cast(sum(accepted) as double) / cast(sum(staged) as double) END AS accept_rate,
  CASE WHEN sum(staged) = 0 THEN 'not evaluated' ELSE 'evaluated' END AS state FROM ({S_EMPTY_RUNS}) GROUP BY 1""")
def agg21(t: Tables):
    return reports.acceptance_rate(quiet_loads(t))


def quiet_loads(t: Tables):
    """Loads in which one table staged nothing."""
    quiet = F.col("table_name") == "view"
    return audit_loads(t).withColumns({c: F.when(quiet, 0).otherwise(F.col(c)) for c in ("staged", "accepted")})


@query("agg22", f"""
SELECT job_run_id, target, cast(max(CASE WHEN phase = 'opened' THEN recorded_at END) as varchar) AS opened_at FROM ({S_RUNS}) GROUP BY 1, 2 HAVING sum(CASE WHEN phase = 'completed' THEN 1 ELSE 0 END) = 0""")
def agg22(t: Tables):
    return reports.incomplete_runs(run_phases(t))


@query("agg23", """
SELECT cast(o_custkey as varchar) AS manifest_id, 'orders' AS table_name, o_orderpriority AS superseded_by, o_orderstatus AS reason, cast(o_orderdate as varchar) AS recorded_at FROM orders WHERE o_orderstatus = 'P'""")
def agg23(t: Tables):
    control = t.orders.where("o_orderstatus = 'P'").select(
        F.col("o_custkey").cast("string").alias("manifest_id"), F.lit("orders").alias("table_name"), F.col("o_orderpriority").alias("superseded_by"),
        F.col("o_orderstatus").alias("reason"), F.col("o_orderdate").alias("recorded_at"))
    return reports.newest_first(control, "manifest_id", "table_name", "superseded_by", "reason", "recorded_at", by="recorded_at")


@query("agg23_manifest", """
SELECT cast(o_orderkey as varchar) AS manifest_id, o_orderpriority AS source_system, o_custkey AS approved_count, cast(o_orderdate as varchar) AS approved_at, o_orderstatus AS approved_by FROM orders""")
def agg23_manifest(t: Tables):
    control = t.orders.select(F.col("o_orderkey").cast("string").alias("manifest_id"), F.col("o_orderpriority").alias("source_system"),
                              F.col("o_custkey").alias("approved_count"), F.col("o_orderdate").alias("approved_at"), F.col("o_orderstatus").alias("approved_by"))
    return reports.newest_first(control, *control.columns, by="approved_at")


@query("agg24", f"""
SELECT table_name, cast(sum(staged) as bigint) AS denominator, cast(sum(accepted) as bigint) AS accepted, CASE WHEN sum(staged) > 0 THEN cast(sum(accepted) as double) / cast(sum(staged) as double) END AS publish_rate,
  CASE WHEN sum(staged) = 0 THEN 'not evaluated' ELSE 'evaluated' END AS state FROM ({S_EMPTY_RUNS}) GROUP BY 1""")
def agg24(t: Tables):
    return reports.acceptance_rate(quiet_loads(t), "publish_rate")


@query("agg24_runs", f"SELECT count(DISTINCT job_run_id) AS runs_recorded, count(*) AS rows_recorded, cast(max(recorded_at) as varchar) AS last_recorded_at FROM ({S_LOADS})")
def agg24_runs(t: Tables):
    return reports.runs_recorded(audit_loads(t))


@query("agg24_volume", f"SELECT job_run_id, table_name, 'loader' AS written_by, staged, accepted, staged - accepted AS not_published, cast(recorded_at as varchar) AS recorded_at FROM ({S_LOADS})")
def agg24_volume(t: Tables):
    return reports.load_volume(audit_loads(t), "not_published")


# Invoices: the gross of a third is the sum of the lines, of the others the order's total; some have two.
# Some lines have no amount, some orders no gross, some a gross and none.
AMOUNT = "CASE WHEN l_orderkey % 29 = 0 OR l_orderkey % 12 = 0 AND l_linenumber = 1 THEN NULL ELSE l_extendedprice END"
S_GROSS = f"""sums AS (SELECT l_orderkey AS inv, sum({s_money(AMOUNT)}) AS line_total, count(*) AS line_count, count({AMOUNT}) AS amounts FROM lineitem GROUP BY 1),
heads AS (SELECT o_orderkey AS inv, CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN coalesce(line_total, 1) ELSE {s_money('o_totalprice')} END AS gross FROM orders LEFT JOIN sums ON inv = o_orderkey
  UNION ALL SELECT o_orderkey, 7.00 FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 21 = 0)"""


def invoice_heads(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("inv"), F.expr(AMOUNT).cast("decimal(18,2)").alias("amount"))
    sums = lines.groupBy("inv").agg(F.sum("amount").cast("decimal(18,2)").alias("total"))
    heads = t.orders.withColumn("inv", F.col("o_orderkey")).join(sums, "inv", "left").select("inv", F.when(F.expr("inv % 31 = 0"), F.lit(None)).when(
        F.expr("inv % 3 = 0"), F.coalesce("total", F.lit(1).cast("decimal(18,2)"))).otherwise(F.col("o_totalprice").cast("decimal(18,2)")).alias("gross"))
    return lines, heads.unionByName(t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("inv"), F.lit("7.00").cast("decimal(18,2)").alias("gross"))).unionByName(
            t.orders.where("o_orderkey % 21 = 0").select(F.col("o_orderkey").alias("inv"), F.lit(None).cast("decimal(18,2)").alias("gross")))


@query("agg25", f"""
WITH {S_GROSS}, h AS (SELECT inv, count(DISTINCT gross) + max(CASE WHEN gross IS NULL THEN 1 ELSE 0 END) AS gross_values, min(gross) AS gross FROM heads GROUP BY 1),
r AS (SELECT h.*, line_total, coalesce(line_count, 0) AS line_count, CASE WHEN line_count IS NULL THEN 'no lines' WHEN gross_values > 1 THEN 'several gross values' WHEN gross IS NULL THEN 'no gross value'
  WHEN amounts = 0 THEN 'no line amounts' WHEN amounts < line_count THEN 'a line without an amount' WHEN line_total <> gross THEN 'lines do not sum to gross' END AS reason FROM h LEFT JOIN sums USING (inv))
SELECT inv, gross_values, cast(gross as double) AS gross, cast(line_total as double) AS line_total, line_count, reason, reason IS NULL AS released FROM r""")
def agg25(t: Tables):
    lines, heads = invoice_heads(t)
    return invoices.invoice_release(lines, heads, ["inv"], "amount", "gross")


S_FILES = """h AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN ' ' WHEN o_orderkey % 41 = 0 THEN 'X1' ELSE cast(o_orderkey as varchar) END AS inv FROM orders WHERE o_orderstatus <> 'P'),
l AS (SELECT CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE cast(l_orderkey as varchar) END AS inv, CASE WHEN l_partkey % 97 = 0 THEN '' ELSE cast(l_linenumber as varchar) END AS ref FROM lineitem),
hn AS (SELECT trim(inv) AS inv, count(*) AS n FROM h GROUP BY 1), ln AS (SELECT coalesce(trim(inv), '') AS inv, trim(ref) AS ref, count(*) AS n FROM l GROUP BY 1, 2),
li AS (SELECT inv, cast(sum(n) as bigint) AS n, sum(CASE WHEN ref <> '' THEN n END) AS named FROM ln GROUP BY 1)"""


@query("agg26", f"""
WITH {S_FILES} SELECT 'HEADER_WITHOUT_ID' AS finding, inv AS invoice, cast(NULL as varchar) AS line_reference, n AS row_count FROM hn WHERE inv = '' UNION ALL
SELECT 'DUPLICATE_HEADER', inv, NULL, n FROM hn WHERE inv <> '' AND n > 1 UNION ALL SELECT 'LINE_WITHOUT_ID', inv, ref, n FROM ln WHERE inv = '' UNION ALL
SELECT 'ORPHAN_LINE', inv, NULL, n FROM li WHERE inv <> '' AND inv NOT IN (SELECT inv FROM hn) UNION ALL SELECT 'BLANK_LINE_REFERENCE', inv, NULL, n FROM ln WHERE ref = '' UNION ALL
SELECT 'DUPLICATE_LINE_REFERENCE', inv, ref, n FROM ln WHERE ref <> '' AND n > 1 UNION ALL
SELECT 'HEADER_WITHOUT_LINES', inv, NULL, 1 FROM hn WHERE inv <> '' AND inv NOT IN (SELECT inv FROM li WHERE named > 0)""")
def agg26(t: Tables):
    headers = t.orders.where("o_orderstatus <> 'P'").select(F.expr("CASE WHEN o_orderkey % 50 = 0 THEN ' ' WHEN o_orderkey % 41 = 0 THEN 'X1' ELSE cast(o_orderkey AS string) END AS inv"))
    lines = t.lineitem.select(
        F.expr("CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE cast(l_orderkey AS string) END AS inv"), F.expr("CASE WHEN l_partkey % 97 = 0 THEN '' ELSE cast(l_linenumber AS string) END AS ref"))
    return invoices.join_findings(headers, lines, "inv", "ref")


S_EXPORT = f"""h AS (SELECT cast(o_orderkey as varchar) AS inv, {s_money('o_totalprice')} AS gross FROM orders),
l AS (SELECT cast(l_orderkey as varchar) AS inv, cast(l_linenumber as varchar) AS ref, {s_money('l_extendedprice')} AS amount, CASE WHEN l_partkey % 50 = 0 THEN ' ' ELSE l_returnflag END AS flag FROM lineitem)"""


@query("agg25_gate", f"""
WITH {S_EXPORT}, n AS (SELECT inv, ref, count(*) AS n FROM l GROUP BY 1, 2), s AS (SELECT inv, sum(amount) AS total, count(*) AS n FROM l GROUP BY 1)
SELECT 'DUPLICATE_LINE_REFERENCE' AS finding, inv AS invoice, ref AS line_reference, n AS row_count FROM n WHERE n > 1 UNION ALL
SELECT 'HEADER_WITHOUT_LINES', inv, NULL, 1 FROM h ANTI JOIN s USING (inv) UNION ALL SELECT 'ORPHAN_LINE', inv, NULL, n FROM s ANTI JOIN h USING (inv) UNION ALL
SELECT 'MISSING_FIELD: flag', inv, ref, count(*) FROM l WHERE trim(flag) = '' GROUP BY 2, 3 UNION ALL
SELECT 'NOT_ISSUED', inv, ref, n FROM n WHERE ref = '7' UNION ALL
SELECT 'NOT_RELEASED: ' || CASE WHEN s.n IS NULL THEN 'no lines' ELSE 'lines do not sum to gross' END, inv, NULL, coalesce(s.n, 0) FROM h LEFT JOIN s USING (inv) WHERE s.n IS NULL OR total <> gross""")
def agg25_gate(t: Tables):
    """One gate before an export: seventh lines are not issued, some flags are blank."""
    headers = t.orders.select(F.col("o_orderkey").cast("string").alias("inv"), F.col("o_totalprice").cast("decimal(18,2)").alias("gross"))
    lines = t.lineitem.select(F.col("l_orderkey").cast("string").alias("inv"), F.col("l_linenumber").cast("string").alias("ref"),
                              F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"), F.expr("CASE WHEN l_partkey % 50 = 0 THEN ' ' ELSE l_returnflag END AS flag"))
    return invoices.gate_findings(headers, lines, lines.where("ref <> '7'"), "inv", "ref", "amount", "gross", ["flag", "ref"])


S_MD5 = "cast(cast(concat('0x', substr(md5(upper(hk)), 1, 15)) as bigint) as hugeint)"


@query("agg27", f"""
WITH k AS (SELECT {S_LINE_ORDER} AS hk FROM lineitem), d AS (SELECT DISTINCT hk FROM k)
SELECT count(*) AS n_rows, count(DISTINCT hk) AS n_distinct, cast(sum({S_MD5}) as varchar) AS md5sum_all, min(upper(hk)) AS min_hk, max(upper(hk)) AS max_hk,
  (SELECT cast(sum({S_MD5}) as varchar) FROM d) AS md5sum_distinct FROM k""")
def agg27(t: Tables):
    """Without the checksum the oracle's engine does not have."""
    return fingerprint.fingerprint(staged(t, "nhl_order_line"), "hub_order_hk").drop("sum_all")


@query("agg27_crc32")
def agg27_crc32(t: Tables):
    return fingerprint.fingerprint(staged(t, "nhl_order_line"), "hub_order_hk")


@query("agg28", f"""
WITH k AS (
  SELECT 'orders' AS t, 'b' AS side, {S_ORDER} AS hk FROM orders UNION ALL SELECT 'orders', 'a', {S_ORDER} FROM orders WHERE o_orderkey <> 1 UNION ALL
  SELECT 'lines', 'b', {S_LINE_ORDER} FROM lineitem UNION ALL SELECT 'lines', 'a', {S_LINE_ORDER} FROM lineitem UNION ALL SELECT 'lines', 'a', {S_LINE_ORDER} FROM lineitem UNION ALL
  SELECT 'customers', unnest(['b', 'a']), {s_key(['c_custkey'], 'CRM')} FROM customer UNION ALL SELECT 'parts', 'b', {s_key(['p_partkey'])} FROM part),
f AS (SELECT t, side, count(*) AS n, count(DISTINCT hk) AS d, sum({S_MD5}) AS s, min(upper(hk)) AS lo, max(upper(hk)) AS hi, sum(DISTINCT {S_MD5}) AS sd FROM k GROUP BY 1, 2),
x AS (SELECT coalesce(b.t, a.t) AS table_name, b.t IS NULL AS added, a.t IS NULL AS gone, concat_ws(';', CASE WHEN a.n <> b.n THEN 'n_rows' END, CASE WHEN a.d <> b.d THEN 'n_distinct' END,
  CASE WHEN a.s <> b.s THEN 'sum_all;md5sum_all' END, CASE WHEN a.lo <> b.lo THEN 'min_hk' END, CASE WHEN a.hi <> b.hi THEN 'max_hk' END, CASE WHEN a.sd <> b.sd THEN 'md5sum_distinct' END) AS differs
  FROM (FROM f WHERE side = 'b') b FULL JOIN (FROM f WHERE side = 'a') a ON a.t = b.t)
SELECT table_name, differs, CASE WHEN added THEN 'ONLY_AFTER' WHEN gone THEN 'ONLY_BEFORE' WHEN differs <> '' THEN 'DIFFERENT' ELSE 'IDENTICAL' END AS verdict FROM x""")
def agg28(t: Tables):
    """One order lost, lines delivered twice, customers untouched, parts dropped."""
    cols = {"orders": "hub_order_hk", "lines": "hub_order_hk", "customers": "hub_customer_hk", "parts": "hub_part_hk"}
    before = {"orders": staged(t, "hub_order"), "lines": staged(t, "nhl_order_line"), "customers": staged(t, "hub_customer"), "parts": staged(t, "hub_part")}
    after = {"orders": before["orders"].where("o_orderkey <> 1"), "lines": before["lines"].unionByName(before["lines"]), "customers": before["customers"]}
    return fingerprint.compare_fingerprints(fingerprint.stack(before, cols), fingerprint.stack(after, cols))


@query("agg29", """
SELECT l_orderkey AS inv, tenant, l_linenumber, l_partkey FROM (SELECT *, CASE WHEN l_suppkey % 20 = 0 THEN ' ' WHEN l_suppkey % 21 = 0 THEN NULL ELSE concat('T', l_orderkey % 3) END AS tenant FROM lineitem) WHERE trim(tenant) <> ''
QUALIFY row_number() OVER (PARTITION BY l_orderkey, tenant ORDER BY concat(l_linenumber, '/', l_partkey, '/', l_suppkey)) = 1""")
def agg29(t: Tables):
    rows = t.lineitem.select(F.col("l_orderkey").alias("inv"), F.expr("CASE WHEN l_suppkey % 20 = 0 THEN ' ' WHEN l_suppkey % 21 = 0 THEN NULL ELSE concat('T', l_orderkey % 3) END AS tenant"),
                             "l_linenumber", "l_partkey", F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey").alias("ref"))
    return invoices.one_per_invoice(rows, ["inv", "tenant"], "ref")[0].drop("ref")


@query("agg30", """
SELECT 'order' AS key_name, count(*) AS row_count, cast(0 as bigint) AS rows_moved, cast(0 as bigint) AS keys_moved, 'MATCHED' AS verdict FROM orders UNION ALL
SELECT 'customer', count(*), count(*), count(DISTINCT o_custkey), 'RE_KEYED' FROM orders UNION ALL
SELECT 'status', count(*), count(*) FILTER (o_orderstatus = 'P'), 1, 'RE_KEYED' FROM orders""")
def agg30(t: Tables):
    """Three keys under the stored and the declared rule: one as it was, one in another key
    space, one whose literal for pending orders changed."""
    pending = F.when(F.col("o_orderstatus") == "P", "PENDING").otherwise(F.col("o_orderstatus"))
    return reconcile.key_diff(t.orders, {
        "order": (hash_key(["o_orderkey"], "SALES"), hash_key([F.concat(F.lit(" "), "o_orderkey")], "sales")),
        "customer": (hash_key(["o_custkey"], "CRM"), hash_key(["o_custkey"], "CRM2")),
        "status": (hash_key(["o_orderstatus"]), hash_key([pending]))})


# Recorded key derivations: one target per customer, two keys each, in every state a record can be in.
S_TEXT = "concat('a=', c_nationkey, ';b=', c_mktsegment)"
S_STATE = """CASE WHEN c_custkey % 8 IN (0, 1) THEN CASE WHEN c_custkey % 8 = 0 THEN 'FIRST_LOAD' ELSE 'UNRECORDED' END WHEN c_custkey % 8 = 2 THEN 'CORRUPT_RECORD' WHEN c_custkey % 8 = 3 THEN 'MATCHED'
  WHEN c_custkey % 8 = 4 THEN 'UNMAPPED' WHEN c_custkey % 8 = 5 THEN 'RE_KEYED' ELSE 'EXTENDED' END"""


@query("agg30_verdict", f"""
SELECT c_custkey, verdict, CASE WHEN c_custkey % 8 IN (5, 6) THEN 'a' ELSE '' END AS moved, CASE WHEN c_custkey % 8 IN (5, 6) THEN 'b' ELSE '' END AS removed,
  CASE WHEN c_custkey % 8 IN (5, 6, 7) THEN 'c' ELSE '' END AS added, verdict IN ('UNRECORDED', 'RE_KEYED', 'UNMAPPED', 'CORRUPT_RECORD') AS fails
FROM (SELECT *, {S_STATE} AS verdict FROM customer)""")
def agg30_verdict(t: Tables):
    state = F.col("c_custkey") % 8
    text = F.expr(S_TEXT)
    a, b = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    old = F.create_map(F.lit("a"), a, F.lit("b"), b)
    moved = F.create_map(F.lit("a"), F.concat(a, F.lit("!")), F.lit("c"), b)
    grown = F.create_map(F.lit("a"), a, F.lit("b"), b, F.lit("c"), b)
    kept = state.isin(2, 3, 5, 6, 7)
    records = t.customer.select(
        "c_custkey", (state != 0).alias("has_rows"),
        F.when(state >= 2, F.when(state == 2, "edited").otherwise(F.sha2(text, 256))).alias("stored_digest"),
        F.when(state == 3, F.sha2(text, 256)).otherwise(F.sha2(F.concat(text, F.lit("+")), 256)).alias("current_digest"),
        F.when(kept, text).alias("stored_text"), F.when(kept, old).alias("stored_map"),
        F.when(state.isin(5, 6), moved).when(state == 7, grown).otherwise(old).alias("current_map"),
        F.when(state == 5, F.array(F.lit("a"))).alias("at_risk"))
    return reconcile.derivation_verdict(records).select("c_custkey", "verdict", "moved", "removed", "added", "fails")


@query("agg31", """
WITH s AS (SELECT c_nationkey AS table_name, c_mktsegment AS column_name, cast(min(c_custkey) % 4 as int) AS ordinal, concat('t', max(c_custkey) % 2) AS data_type FROM customer WHERE c_nationkey <> 4 AND (c_nationkey + length(c_mktsegment)) % 7 <> 0 GROUP BY 1, 2),
d AS (SELECT c_nationkey AS table_name, c_mktsegment AS column_name, cast((min(c_custkey) + CASE WHEN c_nationkey % 5 = 1 THEN 1 ELSE 0 END) % 4 as int) AS ordinal, concat('t', (max(c_custkey) + CASE WHEN c_nationkey % 6 = 0 THEN 1 ELSE 0 END) % 2) AS data_type
  FROM customer WHERE c_nationkey <> 9 AND (c_nationkey + length(c_mktsegment)) % 5 <> 0 GROUP BY 1, 2),
b AS (SELECT coalesce(s.table_name, d.table_name) AS table_name, coalesce(s.column_name, d.column_name) AS column_name, s.ordinal AS so, d.ordinal AS dord, s.data_type AS st, d.data_type AS dt FROM s FULL JOIN d ON s.table_name = d.table_name AND s.column_name = d.column_name),
f AS (SELECT *, CASE WHEN table_name NOT IN (SELECT table_name FROM s) THEN 'MISSING_TABLE' WHEN table_name NOT IN (SELECT table_name FROM d) THEN 'EXTRA_TABLE' WHEN so IS NULL THEN 'MISSING_COLUMN' WHEN dord IS NULL THEN 'EXTRA_COLUMN' WHEN st <> dt THEN 'TYPE_CHANGED' WHEN so <> dord THEN 'ORDER_CHANGED' END AS finding FROM b)
SELECT DISTINCT table_name, CASE WHEN finding LIKE '%TABLE' THEN '*' ELSE column_name END AS column_name, finding FROM f WHERE finding IS NOT NULL""")
def agg31(t: Tables):
    """Tables and columns are absent, moved and retyped by nation and segment, so every finding occurs."""
    def inventory(condition, moved="false", retyped="false"):
        shift = [F.when(F.expr(e.replace("c_nationkey", "table_name")), 1).otherwise(0) for e in (moved, retyped)]
        return t.customer.where(condition).groupBy(F.col("c_nationkey").alias("table_name"), F.col("c_mktsegment").alias("column_name")).agg(
            F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi")).select(
            "table_name", "column_name", ((F.col("lo") + shift[0]) % 4).cast("int").alias("ordinal"), F.concat(F.lit("t"), (F.col("hi") + shift[1]) % 2).alias("data_type"))
    return reconcile.schema_drift(inventory("c_nationkey <> 4 AND (c_nationkey + length(c_mktsegment)) % 7 <> 0"),
                                  inventory("c_nationkey <> 9 AND (c_nationkey + length(c_mktsegment)) % 5 <> 0", "c_nationkey % 5 = 1", "c_nationkey % 6 = 0"))


# Two snapshots of (type, value): the users seen per event type in either half of the month. 'view' has values
# only before, 'signup' has blank ones now and 'error' had some before; a tenth of the users comes, a tenth goes.
S_SNAPSHOTS = """prev AS (SELECT DISTINCT event_type AS type, CASE WHEN event_type = 'error' AND user_id % 7 = 3 THEN ' ' ELSE cast(user_id as varchar) END AS value FROM events WHERE (day(ts) < 16 OR event_type = 'view') AND user_id % 10 <> 1),
cur AS (SELECT DISTINCT event_type AS type, CASE WHEN event_type = 'signup' AND user_id % 7 = 3 THEN ' ' ELSE cast(user_id as varchar) END AS value FROM events WHERE day(ts) >= 16 AND event_type <> 'view' AND user_id % 10 <> 2),
blank AS (SELECT type, max(now) AS now FROM (SELECT type, value, 1 AS now FROM cur UNION ALL SELECT type, value, 0 FROM prev) WHERE trim(value) = '' GROUP BY 1)"""


@query("agg32", f"""
WITH {S_SNAPSHOTS}, ok AS (SELECT DISTINCT type FROM cur WHERE type <> 'purchase' AND type NOT IN (SELECT type FROM blank))
SELECT type, value, 'OFFERED' AS reference_status, cast(NULL as varchar) AS reason, '2026-02-01 00:00:00' AS effective_from FROM cur c WHERE type IN (SELECT type FROM ok) AND NOT EXISTS (SELECT 1 FROM prev p WHERE p.type = c.type AND p.value = c.value) UNION ALL
SELECT type, value, 'WITHDRAWN', NULL, '2026-02-01 00:00:00' FROM prev p WHERE type IN (SELECT type FROM ok) AND NOT EXISTS (SELECT 1 FROM cur c WHERE p.type = c.type AND p.value = c.value) UNION ALL
SELECT 'view', NULL, 'REFUSED', 'no values', '2026-02-01 00:00:00' FROM (SELECT count(*) AS n FROM cur) WHERE n > 0 UNION ALL
SELECT type, NULL, 'REFUSED', CASE WHEN now = 1 THEN 'blank value' ELSE 'blank value before' END, '2026-02-01 00:00:00' FROM blank""")
def agg32(t: Tables):
    """'purchase' was not fetched and is left alone; 'view' came back empty and is refused."""
    e = t.events.select(F.col("event_type").alias("type"), F.col("user_id").cast("string").alias("value"), F.dayofmonth("ts").alias("day"))
    blank = "CASE WHEN type = '{}' AND cast(value AS int) % 7 = 3 THEN ' ' ELSE value END"
    cur = e.where("day >= 16 AND type <> 'view' AND cast(value AS int) % 10 <> 2").withColumn("value", F.expr(blank.format("signup")))
    prev = e.where("(day < 16 OR type = 'view') AND cast(value AS int) % 10 <> 1").withColumn("value", F.expr(blank.format("error")))
    return snapshots.snapshot_effectivity(prev, cur, ["click", "signup", "error", "view"], "2026-02-01 00:00:00")
