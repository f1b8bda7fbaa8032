"""Deduplication, vault loading and history."""

from pyspark.sql import functions as F

from lodestrata.functions.keys import hash_key, hashdiff
from lodestrata.operators import dedup, history, load
from lodestrata.plans.registry import Tables, query, s_diff, s_key, s_money
from lodestrata.sources import sinks
from lodestrata.sources.buckets import BucketedTable
from lodestrata.plans.warehouse import (
    HALF, LOAD, S_ACTIVITY_LOG, S_CUSTOMER, S_LINE, S_LINE_ORDER, S_LINK, S_ORDER, S_USER_LOG,
    activity_log, before_half, log_of, s_load, staged, stored_users, user_log,
)

PAIR = ["l_orderkey", "l_linenumber"]
# Line rows are told apart by these.
TIE = ["l_partkey", "l_suppkey"]


@query("ddp1", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def ddp1(t: Tables):
    """The survivor is arbitrary, so only the columns it was chosen by are compared."""
    return dedup.drop_redelivered(t.lineitem.select(*PAIR, "l_partkey"), PAIR).select(*PAIR)


@query("ddp2", """
SELECT * EXCLUDE (l_shipdate), cast(l_shipdate as varchar) AS l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def ddp2(t: Tables):
    return dedup.latest_wins(t.lineitem, PAIR, ["l_shipdate", "l_extendedprice"], TIE)


@query("ddp3", f"SELECT DISTINCT {s_key(['l_orderkey', 'l_linenumber'], 'SALES')} AS hk FROM lineitem")
def ddp3(t: Tables):
    rows = t.lineitem.select(hash_key(PAIR, "SALES").alias("hk"), "l_partkey")
    return dedup.drop_redelivered(rows, ["hk"]).select("hk")


@query("ddp4", f"""
SELECT {S_CUSTOMER} AS hub_customer_hk, cast(o_orderdate as varchar) AS load_dts, o_orderpriority AS rec_src, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderpriority, o_orderkey) = 1""")
def ddp4(t: Tables):
    log = staged(t, "hub_customer", "SALES").select(
        "hub_customer_hk", F.col("o_orderdate").alias("load_dts"), F.col("o_orderpriority").alias("rec_src"), "o_orderkey")
    return dedup.first_write(log, "hub_customer_hk", ["o_orderkey"])


def ambiguous_log(t: Tables):
    """Lines keyed by order and line number only, which does not tell them apart."""
    return t.lineitem.select(
        hash_key(PAIR, "SALES").alias("hk"), F.lit(LOAD).alias("load_dts"), F.lit("SALES").alias("rec_src"),
        "l_partkey", "l_suppkey", F.monotonically_increasing_id().cast("string").alias("batch_id"))


S_AMBIGUOUS = f"""SELECT * FROM (SELECT DISTINCT {s_key(['l_orderkey', 'l_linenumber'], 'SALES')} AS hk, '{LOAD}' AS load_dts, 'SALES' AS rec_src, l_partkey, l_suppkey FROM lineitem)"""


@query("ddp5", f"""
SELECT *, count(*) OVER (PARTITION BY hk, load_dts, rec_src) AS variants FROM ({S_AMBIGUOUS}) QUALIFY variants > 1""")
def ddp5(t: Tables):
    return dedup.ambiguous_groups(ambiguous_log(t), "hk")


@query("ddp5_all", f"SELECT *, count(*) OVER (PARTITION BY hk, load_dts, rec_src) AS variants FROM ({S_AMBIGUOUS}) QUALIFY variants > 1")
def ddp5_all(t: Tables):
    """Every ambiguous row, without the report's bound."""
    return dedup.ambiguous_groups(ambiguous_log(t), "hk", limit=None)


@query("ddp6", """
SELECT 'pair' AS key_name, count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys FROM lineitem UNION ALL
SELECT 'full', count(*), count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) FROM lineitem""")
def ddp6(t: Tables):
    return (dedup.key_multiplicity(t.lineitem, PAIR).select(F.lit("pair").alias("key_name"), "*")
            .unionByName(dedup.key_multiplicity(t.lineitem, [*PAIR, *TIE]).select(F.lit("full").alias("key_name"), "*")))


@query("ddp7", """
SELECT l_orderkey, l_linenumber, count(DISTINCT (flag, l_linestatus)) AS variants, count(*) AS copies
FROM (SELECT *, nullif(l_returnflag, 'N') AS flag FROM lineitem) GROUP BY 1, 2 HAVING count(DISTINCT (flag, l_linestatus)) > 1""")
def ddp7(t: Tables):
    rows = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return dedup.divergent_groups(rows, PAIR, ["flag", "l_linestatus"])


def customer_union(t: Tables):
    return load.union_feeds([log_of(t, "hub_customer", s) for s in ("CRM", "SALES")])


S_CUSTOMER_UNION = f"""SELECT {s_key(['c_custkey'], 'CRM')} AS hub_customer_hk, cast(c_custkey as varchar) AS customer_code, 'CRM' AS rec_src FROM customer
UNION ALL SELECT {S_CUSTOMER}, cast(o_custkey as varchar), 'SALES' FROM orders"""


@query("vlt1", S_CUSTOMER_UNION)
def vlt1(t: Tables):
    return customer_union(t).select("hub_customer_hk", "customer_code", "rec_src")


@query("vlt2", f"""
SELECT * FROM ({S_CUSTOMER_UNION}) WHERE hub_customer_hk NOT IN (SELECT {s_key(['c_custkey'], 'CRM')} FROM customer WHERE c_mktsegment = 'BUILDING')
QUALIFY row_number() OVER (PARTITION BY hub_customer_hk ORDER BY rec_src) = 1""")
def vlt2(t: Tables):
    """Two feeds into one hub that holds one segment of the customers already."""
    held = staged(t, "hub_customer", "CRM").where("c_mktsegment = 'BUILDING'").select("hub_customer_hk")
    return load.load_keyed(customer_union(t), held, "hub_customer_hk").select("hub_customer_hk", "customer_code", "rec_src")


def in_buckets(t: Tables, held, key: str):
    """The rows as a table stored in buckets by the key."""
    table = BucketedTable(t.spark, sinks.run_folder(t.spark, "bucketed"), key, 8)
    table.append(held)
    return table


@query("vlt2_bucketed", f"SELECT DISTINCT hub_customer_hk, customer_code, 'CRM' AS rec_src FROM ({S_CUSTOMER_UNION})")
def vlt2_bucketed(t: Tables):
    """Two loads into a hub stored in buckets; the second one brings every key again, and finds the first one's."""
    new = ["hub_customer_hk", "customer_code"]
    hub = in_buckets(t, staged(t, "hub_customer", "CRM").where("c_mktsegment = 'BUILDING'").select("hub_customer_hk", F.col("c_custkey").cast("string").alias("customer_code")), "hub_customer_hk")
    for _ in range(2):
        hub.append(load.load_keyed(customer_union(t), hub.read(), "hub_customer_hk").select(*new))
    return hub.read().withColumn("rec_src", F.lit("CRM"))


@query("vlt3", f"""
SELECT {S_LINK} AS link_order_customer_hk, {S_ORDER} AS hub_order_hk, {S_CUSTOMER} AS hub_customer_hk FROM orders WHERE o_orderstatus <> 'F'""")
def vlt3(t: Tables):
    """Each order delivered twice, the finished ones loaded already."""
    log = log_of(t, "link_order_customer")
    held = staged(t, "link_order_customer").where("o_orderstatus = 'F'").select("link_order_customer_hk")
    return load.load_unambiguous(load.union_feeds([log, log]), held, "link_order_customer_hk").select(
        "link_order_customer_hk", "hub_order_hk", "hub_customer_hk")


@query("vlt3_nhl", f"""
SELECT {S_LINE} AS nhl_order_line_hk, {S_LINE_ORDER} AS hub_order_hk, l_linenumber, cast({s_money('l_extendedprice')} as double) AS l_extendedprice FROM lineitem""")
def vlt3_nhl(t: Tables):
    return load.load_unambiguous(log_of(t, "nhl_order_line"), None, "nhl_order_line_hk").select(
        "nhl_order_line_hk", "hub_order_hk", "l_linenumber", "l_extendedprice")


S_SAT_OUT = "SELECT hk AS hub_user_hk, hd AS hashdiff, event_type, tier, cast(load_dts as varchar) AS load_dts, cast(applied_dts as varchar) AS applied_dts, sub_seq FROM {}"
SAT_OUT = ["hub_user_hk", "hashdiff", "event_type", "tier", "load_dts", "applied_dts", "sub_seq"]
S_STORED = f"{S_USER_LOG}, {s_load('ulog', 'hk', 'stored', f'load_dts < timestamp {chr(39)}{HALF}{chr(39)}')}"


@query("vlt4", f"WITH {S_STORED}, {s_load('ulog', 'hk', 'added', target='stored')} {S_SAT_OUT.format('added')}")
def vlt4(t: Tables):
    """The whole log against a satellite that holds its first half."""
    return load.load_satellite(user_log(t), stored_users(t), "hub_user_hk").select(*SAT_OUT)


@query("vlt4_bucketed", f"WITH {S_STORED}, {s_load('ulog', 'hk', 'added', target='stored')} {S_SAT_OUT.format('added')}")
def vlt4_bucketed(t: Tables):
    """``vlt4`` with the satellite stored in buckets by its parent's key."""
    return load.load_satellite(user_log(t), in_buckets(t, stored_users(t), "hub_user_hk").read(), "hub_user_hk").select(*SAT_OUT)


@query("vlt4_first", f"WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'added')} {S_SAT_OUT.format('added')}")
def vlt4_first(t: Tables):
    return load.load_satellite(user_log(t), None, "hub_user_hk").select(*SAT_OUT)


@query("vlt4_replayed", f"WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'added')} {S_SAT_OUT.format('added')}")
def vlt4_replayed(t: Tables):
    """A log read twice, the second time under a later load, stores what it stored once."""
    log = user_log(t)
    again = log.withColumn("load_dts", F.lit("2026-06-01 00:00:00").cast("timestamp"))
    return load.load_satellite(load.union_feeds([log, again]), None, "hub_user_hk", drop_replayed=True).select(*SAT_OUT)


def stored_activity(t: Tables):
    return load.load_satellite(before_half(activity_log(t)), None, "hub_user_hk", "mas_key")


@query("vlt5", f"""
WITH {S_ACTIVITY_LOG}, {s_load('alog', 'hk, mas_key', 'stored', f'load_dts < timestamp {chr(39)}{HALF}{chr(39)}')},
{s_load('alog', 'hk, mas_key', 'added', target='stored')}
SELECT hk AS hub_user_hk, mas_key, hd AS hashdiff, tier, cast(load_dts as varchar) AS load_dts, sub_seq FROM added""")
def vlt5(t: Tables):
    return load.load_satellite(activity_log(t), stored_activity(t), "hub_user_hk", "mas_key").select(
        "hub_user_hk", "mas_key", "hashdiff", "tier", "load_dts", "sub_seq")


# The relation of a customer to the priority of its orders; the driving key is the customer.
S_EDGE_LOG = f"""elog AS (SELECT {s_key(['o_custkey', 'o_orderpriority'], 'SALES')} AS hk, {S_CUSTOMER} AS driving, {s_diff(['o_orderstatus'])} AS hd, o_orderstatus,
  o_custkey, o_orderpriority, cast(date_trunc('month', o_orderdate) as timestamp) AS load_dts, o_orderdate AS applied_dts
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderdate ORDER BY o_orderkey) = 1)"""


def edge_log(t: Tables):
    rows = dedup.latest_wins(t.orders.withColumn("rank", -F.col("o_orderkey")), ["o_custkey", "o_orderpriority", "o_orderdate"], ["rank"])
    return rows.select(
        hash_key(["o_custkey", "o_orderpriority"], "SALES").alias("hk"), hash_key(["o_custkey"], "CRM").alias("driving"),
        hashdiff(["o_orderstatus"]).alias("hashdiff"), "o_orderstatus", "o_custkey", "o_orderpriority",
        F.date_trunc("month", "o_orderdate").alias("load_dts"), F.col("o_orderdate").cast("timestamp").alias("applied_dts"),
        F.lit(0).alias("sub_seq"), F.lit("SALES").alias("rec_src"))


def edge_sat(t: Tables):
    return load.load_satellite(edge_log(t), None, "hk")


@query("vlt6", f"""
WITH {S_EDGE_LOG}, {s_load('elog', 'hk', 'added')}
SELECT hk, hd AS hashdiff, o_orderstatus, cast(load_dts as varchar) AS load_dts, cast(applied_dts as varchar) AS applied_dts, sub_seq FROM added""")
def vlt6(t: Tables):
    return edge_sat(t).select("hk", "hashdiff", "o_orderstatus", "load_dts", "applied_dts", "sub_seq")


@query("vlt7", f"""
WITH {S_EDGE_LOG}, {s_load('elog', 'hk', 'added')}
SELECT driving, hk, cast(applied_dts as varchar) AS effective_from, cast(lead(applied_dts) OVER w as varchar) AS effective_to, lead(hk) OVER w IS NULL AS is_open
FROM added WINDOW w AS (PARTITION BY driving ORDER BY applied_dts, load_dts, hk)""")
def vlt7(t: Tables):
    """At most one open edge per customer."""
    return history.effectivity(edge_sat(t), ["driving"], ["hk"], probe_on=edge_log(t)).select("driving", "hk", "effective_from", "effective_to", "is_open")


S_TYPE2 = "cast(applied_dts as varchar) AS valid_from, cast(lead(applied_dts) OVER w as varchar) AS valid_to, lead(load_dts) OVER w IS NULL AS is_current"


@query("vlt8", f"""
WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'added')}
SELECT hk AS hub_user_hk, event_type, tier, sub_seq, {S_TYPE2} FROM added WINDOW w AS (PARTITION BY hk ORDER BY applied_dts, load_dts, sub_seq)""")
def vlt8(t: Tables):
    sat = load.load_satellite(user_log(t), None, "hub_user_hk")
    return history.type2(sat, "hub_user_hk", probe_on=user_log(t)).select("hub_user_hk", "event_type", "tier", "sub_seq", "valid_from", "valid_to", "is_current")


@query("vlt8_multi_active", f"""
WITH {S_ACTIVITY_LOG}, {s_load('alog', 'hk, mas_key', 'added')}
SELECT hk AS hub_user_hk, mas_key, tier, {S_TYPE2} FROM added WINDOW w AS (PARTITION BY hk, mas_key ORDER BY applied_dts, load_dts, sub_seq)""")
def vlt8_multi_active(t: Tables):
    sat = load.load_satellite(activity_log(t), None, "hub_user_hk", "mas_key")
    return history.type2(sat, "hub_user_hk", "mas_key", probe_on=activity_log(t)).select("hub_user_hk", "mas_key", "tier", "valid_from", "valid_to", "is_current")


@query("vlt9", f"""
WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'added')}
SELECT hk AS hub_user_hk, event_type, tier, cast(load_dts as varchar) AS load_dts, sub_seq FROM added
QUALIFY row_number() OVER (PARTITION BY hk ORDER BY load_dts DESC, sub_seq DESC) = 1""")
def vlt9(t: Tables):
    return history.current(load.load_satellite(user_log(t), None, "hub_user_hk"), "hub_user_hk").select(
        "hub_user_hk", "event_type", "tier", "load_dts", "sub_seq")


LINE_TYPE = "CASE l_returnflag WHEN 'A' THEN 'TS' WHEN 'R' THEN ' es' ELSE CASE WHEN l_linestatus = 'O' THEN 'MI' ELSE 'Tax' END END"
CODES = {"task_ts": "concat('T|', l_partkey, ')')", "task_es": "concat('E', l_suppkey)", "task_mi": "concat(' M|x|', l_linenumber, ')) ')",
         "org_ts": "concat('ts', l_partkey % 9)", "org_es": "concat('es', l_partkey % 9)", "org_mi": "cast(null as {s})"}


def coded_lines(t: Tables):
    rows = staged(t, "nhl_order_line").withColumns(
        {"line_code": F.expr(LINE_TYPE), **{k: F.expr(v.format(s="string")) for k, v in CODES.items()}})
    return history.line_coding(rows, "line_code", {
        "task_number": ["task_ts", "task_es", "task_mi"], "expenditure_organization": ["org_ts", "org_es", "org_mi"]})


CODING = ("line_type", "task_number", "expenditure_organization", "rule_version")
S_CODED = f"""coded AS (SELECT {S_LINE} AS hk, CASE WHEN m = 'TAX' THEN 'TAX' ELSE 'ITEM' END AS line_type,
  CASE m WHEN 'TS' THEN cast(l_partkey as varchar) WHEN 'ES' THEN concat('E', l_suppkey) WHEN 'MI' THEN concat('x|', l_linenumber) END AS task_number,
  CASE m WHEN 'TS' THEN concat('ts', l_partkey % 9) WHEN 'ES' THEN concat('es', l_partkey % 9) END AS expenditure_organization, '1.0.0' AS rule_version
  FROM (SELECT *, upper(trim({LINE_TYPE})) AS m FROM lineitem))"""


@query("vlt10", f"WITH {S_CODED} SELECT hk AS nhl_order_line_hk, {s_diff(CODING)} AS hashdiff, {', '.join(CODING)}, 0 AS sub_seq FROM coded")
def vlt10(t: Tables):
    """Computed satellite of the lines, loaded like any other."""
    log = coded_lines(t).select("nhl_order_line_hk", hashdiff(CODING).alias("hashdiff"), *CODING, "load_dts", "applied_dts", "sub_seq", "rec_src")
    return load.load_satellite(log, None, "nhl_order_line_hk").select("nhl_order_line_hk", "hashdiff", *CODING, "sub_seq")


@query("vlt11", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_brand, 'UNMAPPED') AS code_class, CASE WHEN l_linestatus = 'F' THEN 'EMPLOYER' ELSE 'WORKER' END AS liability_party,
  CASE WHEN l_linestatus = 'F' THEN cast(cast(l_extendedprice as decimal(18,2)) as double) END AS employer_amount,
  CASE WHEN l_linestatus <> 'F' THEN cast(cast(l_extendedprice as decimal(18,2)) as double) END AS worker_amount, p_type AS mapped_account
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON p_partkey = l_partkey""")
def vlt11(t: Tables):
    mapping = t.part.where("p_size > 5").select(F.col("p_partkey").alias("code"), F.col("p_brand").alias("code_class"), F.col("p_type").alias("mapped_account"))
    lines = t.lineitem.withColumns({"amount": F.col("l_extendedprice").cast("decimal(18,2)"),
                                    "indicator": F.when(F.col("l_linestatus") == "F", "er ").otherwise("EE")})
    return history.classify_payroll(lines, mapping, "l_partkey", "indicator", "amount").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "code_class", "liability_party", "employer_amount", "worker_amount", "mapped_account")


FIELDS = ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def key_values(t: Tables, ids=IDS, fields=FIELDS):
    rows = t.lineitem.withColumns({
        "hk": hash_key(["l_orderkey", "l_partkey", F.lit("srm"), "l_suppkey", "l_linenumber", "l_shipdate"], "SALES"),
        "l_quantity": F.col("l_quantity").cast("decimal(18,2)"), "l_extendedprice": F.col("l_extendedprice").cast("decimal(18,2)"),
        "l_returnflag": F.nullif("l_returnflag", F.lit("N"))})
    return history.unpivot_fields(rows, ids, fields)


@query("vlt12", f"""
SELECT {S_LINE} AS hk, cast({s_money('l_quantity')} as double) AS quantity, l_linestatus AS status, cast(NULL as int) AS flag_number,
       CASE WHEN l_quantity IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN l_linestatus IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN try_cast(nullif(l_returnflag, 'N') as int) IS NOT NULL THEN 1 ELSE 0 END AS promoted_fields FROM lineitem""")
def vlt12(t: Tables):
    """Registered fields back as typed columns; a value that is not of the type is not promoted."""
    registry = {"l_quantity": ("quantity", "decimal(18,2)"), "l_linestatus": ("status", "string"), "l_returnflag": ("flag_number", "int")}
    return history.promote_fields(key_values(t, ["hk"], list(registry)), registry, "hk")


@query("vlt13", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest(['l_quantity', 'l_extendedprice', 'l_returnflag', 'l_linestatus']) AS field_name,
  unnest([cast(cast(l_quantity as decimal(18,2)) as varchar), cast(cast(l_extendedprice as decimal(18,2)) as varchar), l_returnflag, l_linestatus]) AS field_value
FROM lineitem WHERE l_returnflag <> 'N' UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest(['l_quantity', 'l_extendedprice', 'l_linestatus']),
  unnest([cast(cast(l_quantity as decimal(18,2)) as varchar), cast(cast(l_extendedprice as decimal(18,2)) as varchar), l_linestatus]) FROM lineitem WHERE l_returnflag = 'N'""")
def vlt13(t: Tables):
    return key_values(t)


@query("vlt14", f"""
SELECT hk, cast(load_dts as varchar) AS load_dts, l_partkey, l_suppkey FROM (
  SELECT {s_key(['l_orderkey', 'l_linenumber'], 'SALES')} AS hk, l_shipdate AS load_dts, l_partkey, l_suppkey FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY hk ORDER BY load_dts DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def vlt14(t: Tables):
    """Open and closed lines as two tables, one row per key."""
    rows = t.lineitem.select(hash_key(PAIR, "SALES").alias("hk"), F.col("l_shipdate").alias("load_dts"), *TIE, "l_linestatus")
    return history.newest_of([rows.where("l_linestatus = 'O'").drop("l_linestatus"), rows.where("l_linestatus = 'F'").drop("l_linestatus")], "hk", TIE)


@query("vlt15", f"""
SELECT {S_CUSTOMER} AS hub_customer_hk, o_custkey, cast(o_orderdate as varchar) AS effective_from FROM (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WHERE o_orderstatus <> 'F'""")
def vlt15(t: Tables):
    hub = t.customer.select(hash_key(["c_custkey"], "CRM").alias("hub_customer_hk"), F.col("c_custkey").alias("o_custkey"))
    effect = t.orders.select(
        hash_key(["o_custkey"], "CRM").alias("hub_customer_hk"), F.when(F.col("o_orderstatus") != "F", "OFFERED").otherwise("WITHDRAWN").alias("reference_status"),
        F.col("o_orderdate").alias("applied_dts"), F.col("o_orderkey").alias("load_dts"))
    return history.offered_values(hub, effect, "hub_customer_hk").select("hub_customer_hk", "o_custkey", F.col("applied_dts").alias("effective_from"))


@query("vlt16", f"""
WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'usat')}, {S_ACTIVITY_LOG.replace('upper(event_type)', "'ALL'")},
{s_load('alog', 'hk, mas_key', 'asat')},
spine AS (SELECT h.hk, d.snapshot_dts FROM (SELECT DISTINCT hk FROM ulog) h, (SELECT DISTINCT load_dts AS snapshot_dts FROM ulog WHERE day(load_dts) % 7 = 1) d),
u AS (SELECT s.*, x.load_dts AS u_load, x.sub_seq AS u_seq FROM spine s LEFT JOIN usat x ON x.hk = s.hk AND x.applied_dts <= s.snapshot_dts
  QUALIFY row_number() OVER (PARTITION BY s.hk, snapshot_dts ORDER BY x.applied_dts DESC NULLS LAST, x.load_dts DESC, x.sub_seq DESC) = 1),
a AS (SELECT s.*, x.load_dts AS a_load, x.sub_seq AS a_seq FROM spine s LEFT JOIN asat x ON x.hk = s.hk AND x.applied_dts <= s.snapshot_dts
  QUALIFY row_number() OVER (PARTITION BY s.hk, snapshot_dts ORDER BY x.applied_dts DESC NULLS LAST, x.load_dts DESC, x.sub_seq DESC) = 1)
SELECT hk AS hub_user_hk, cast(snapshot_dts as varchar) AS snapshot_dts, cast(u_load as varchar) AS user_load_dts, u_seq AS user_sub_seq,
  cast(a_load as varchar) AS activity_load_dts, a_seq AS activity_sub_seq FROM u JOIN a USING (hk, snapshot_dts)""")
def vlt16(t: Tables):
    """Weekly point-in-time rows of every user over two satellites."""
    users = user_log(t)
    tiers = activity_log(t).withColumn("mas_key", F.lit("ALL"))
    spine = history.snapshot_spine(users, "hub_user_hk", "2024-01-01 00:00:00", "2024-01-29 00:00:00", 7)
    return history.point_in_time(spine, {
        "user": load.load_satellite(users, None, "hub_user_hk"),
        "activity": load.load_satellite(tiers, None, "hub_user_hk", "mas_key")}, "hub_user_hk", probe_on={"user": users, "activity": tiers})


@query("agg13", f"""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def agg13(t: Tables):
    return load.duplicate_grain(t.lineitem, PAIR)


@query("agg13_satellite", f"""
WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'added')} SELECT hk AS hub_user_hk, cast(load_dts as varchar) AS load_dts, count(*) AS copies FROM added GROUP BY hk, load_dts HAVING count(*) > 1""")
def agg13_satellite(t: Tables):
    """Versions of a key within one load; with ``sub_seq`` the grain is unique, without it is not."""
    sat = load.load_satellite(user_log(t), None, "hub_user_hk")
    full = load.duplicate_grain(sat, ["hub_user_hk", "load_dts", "sub_seq"]).select("hub_user_hk", "load_dts", "copies")
    return load.duplicate_grain(sat, ["hub_user_hk", "load_dts"]).unionByName(full)


# Audit rows: a run per day and a table per event type; accepted and discards from the events.
S_LOADS = """SELECT concat('run', dayofyear(ts)) AS job_run_id, event_type AS table_name, count(*) AS staged, count(*) FILTER (value < 50 OR user_id = 7) AS accepted,
  max(ts) AS recorded_at FROM events GROUP BY 1, 2"""
S_DISCARDS = """SELECT concat('run', dayofyear(ts)) AS job_run_id, event_type AS table_name, CASE WHEN value > 100 THEN 'already_present' ELSE 'duplicate_in_batch' END AS discard_reason,
  count(*) AS discarded FROM events WHERE value >= 50 GROUP BY 1, 2, 3"""


def audit_loads(t: Tables):
    return t.events.groupBy(F.concat(F.lit("run"), F.dayofyear("ts")).alias("job_run_id"), F.col("event_type").alias("table_name")).agg(
        F.count(F.lit(1)).alias("staged"), F.count_if(F.expr("value < 50 OR user_id = 7")).alias("accepted"), F.max("ts").alias("recorded_at")
    ).withColumn("written_by", F.lit("loader"))


def audit_discards(t: Tables):
    return t.events.where("value >= 50").groupBy(
        F.concat(F.lit("run"), F.dayofyear("ts")).alias("job_run_id"), F.col("event_type").alias("table_name"),
        F.when(F.col("value") > 100, "already_present").otherwise("duplicate_in_batch").alias("discard_reason")).agg(F.count(F.lit(1)).alias("discarded"))


@query("agg14", f"""
WITH l AS ({S_LOADS}), d AS (SELECT job_run_id, table_name, sum(discarded) AS discarded FROM ({S_DISCARDS}) GROUP BY 1, 2)
SELECT job_run_id, table_name, staged, accepted, cast(coalesce(discarded, 0) as bigint) AS discarded, staged - accepted = coalesce(discarded, 0) AS balanced,
  CASE WHEN staged - accepted <> coalesce(discarded, 0) THEN 'discards do not account for the rows not accepted' END AS reason
FROM l LEFT JOIN d USING (job_run_id, table_name)""")
def agg14(t: Tables):
    return load.load_arithmetic(audit_loads(t), audit_discards(t)).select(
        "job_run_id", "table_name", "staged", "accepted", "discarded", "balanced", "reason")


@query("agg15", f"""
WITH k AS (SELECT o_custkey AS k, count(*) AS n, any_value(c_mktsegment) = 'BUILDING' AS held FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT 'duplicate_in_batch' AS reason, cast(sum(n - 1) as bigint) AS row_count FROM k UNION ALL
SELECT 'already_present', cast(sum(CASE WHEN held THEN 1 ELSE 0 END) as bigint) FROM k UNION ALL
SELECT 'accepted', cast(sum(CASE WHEN held THEN 0 ELSE 1 END) as bigint) FROM k""")
def agg15(t: Tables):
    held = staged(t, "hub_customer", "CRM").where("c_mktsegment = 'BUILDING'").select("hub_customer_hk")
    return load.discards_keyed(log_of(t, "hub_customer", "SALES"), held, "hub_customer_hk")


@query("agg15_satellite", f"""
WITH {S_USER_LOG}, {s_load('ulog', 'hk', 'added')}
SELECT 'unchanged_hashdiff' AS reason, (SELECT count(*) FROM ulog) - (SELECT count(*) FROM added) AS row_count""")
def agg15_satellite(t: Tables):
    """Log rows a satellite load leaves out because nothing changed."""
    log = user_log(t)
    return load.discards_versioned(log, load.load_satellite(log, None, "hub_user_hk"))
