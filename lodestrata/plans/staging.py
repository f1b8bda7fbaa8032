"""Sources, sinks, projection and staging."""

from pyspark.sql import functions as F

from lodestrata.model import active_bindings
from lodestrata.operators.load import empty_like, load_keyed, union_feeds
from lodestrata.operators.snapshots import land_membership
from lodestrata.operators.staging import cast_declared, conform, kept_operations, narrow, sub_key, system_columns
from lodestrata.operators.unions import aligned_union
from lodestrata.plans.registry import Tables, query, s_key, s_norm
from lodestrata.plans.warehouse import (
    LINE_PAYLOAD, LOAD, MODEL, S_CUSTOMER, S_LINE, S_LINE_MONEY, S_LINE_ORDER, S_LINE_SUPPLIER, S_ORDER, log_of, staged,
)
from lodestrata.functions.rules import module_value
from lodestrata.sources import feeds, sinks


@query("src1", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src1(t: Tables):
    return feeds.scan(t.spark, t.path("orders")).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("src4", f"""
SELECT event_id, '2026-01-01 06:00:00' AS _ingest_ts, '2026-01-01' AS ingest_date, 'WEB' AS _source_system, 'b7' AS _batch_id,
       cast(NULL as boolean) AS _dup_flag FROM events""")
def src4(t: Tables):
    return feeds.landed(t.events, "WEB", "b7", "2026-01-01 06:00:00").select(
        "event_id", "_ingest_ts", "ingest_date", "_source_system", "_batch_id", "_dup_flag")


@query("src5", """
WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem)
SELECT concat('S', s) AS group_reference_id, concat('P', p) AS member_reference_id, 'includes' AS relation,
       '2026-01-01' AS effective_from, 'active' AS relationship_status, 'T1' AS tenant FROM e
UNION ALL
SELECT concat('P', p), concat('S', s), 'included_in', '2026-01-01', 'active', 'T1' FROM e""")
def src5(t: Tables):
    """Suppliers as organisations: the parts they deliver are members and, the other way, groups."""
    pairs = t.lineitem.select(F.concat(F.lit("S"), "l_suppkey").alias("reference_id"),
                              F.concat(F.lit("P"), "l_partkey").alias("other")).distinct()
    # The snapshot delivers a bounded slice of its edges per row.
    rows = pairs.groupBy("reference_id", F.pmod(F.xxhash64("other"), F.lit(1024)).alias("slice")).agg(
        F.collect_set("other").alias("included"))
    rows = rows.select("reference_id", "included", F.col("included").alias("included_in"), F.lit("2026-01-01").alias("effective_from"))
    return land_membership(rows, {"tenant": "T1"})


@query("snk1", "SELECT o_orderstatus, o_orderkey, 'b1' AS batch FROM orders UNION ALL SELECT o_orderstatus, o_orderkey, 'b2' FROM orders")
def snk1(t: Tables):
    path = sinks.run_folder(t.spark, "snk1")
    for batch in ("b1", "b2"):
        sinks.append(t.orders.select("o_orderkey", "o_orderstatus", F.lit(batch).alias("batch")), path, ["o_orderstatus"])
    return feeds.scan(t.spark, path)


@query("snk2", f"""
SELECT {S_ORDER} AS hub_order_hk, cast(o_orderkey as varchar) AS order_key, '{LOAD}' AS load_dts, 8 AS target_columns FROM orders""")
def snk2(t: Tables):
    """A target created by its log's shape holds no row, so a load into it inserts every key."""
    log = log_of(t, "hub_order")
    target = empty_like(log)
    return load_keyed(log, target, "hub_order_hk").select(
        "hub_order_hk", "order_key", "load_dts", F.lit(len(target.columns)).alias("target_columns"))


EXPORT = [("Invoice", "l_orderkey", sinks.MAPPED), ("Line", "l_linenumber", sinks.MAPPED),
          ("Amount", "l_extendedprice", sinks.MAPPED), ("Cost Centre", None, sinks.UNMAPPED), ("Flag", "l_returnflag", sinks.MAPPED)]


@query("snk3", """
SELECT cast(l_orderkey as varchar) AS "Invoice", cast(l_linenumber as varchar) AS "Line",
       cast(cast(l_extendedprice as decimal(18,2)) as varchar) AS "Amount", '' AS "Cost Centre", l_returnflag AS "Flag" FROM lineitem""")
def snk3(t: Tables):
    """Line-grain file, written and read back."""
    path = sinks.run_folder(t.spark, "snk3")
    sinks.write_csv(cast_declared(t.lineitem, {"l_extendedprice": "decimal(18,2)"}), EXPORT, path)
    schema = ", ".join(f"`{h}` string" for h, _, _ in EXPORT)
    return t.spark.read.schema(schema).option("header", True).csv(path).na.fill("")


@query("snk3_invoice", """
SELECT cast(o_orderkey as varchar) AS "Invoice", cast(cast(o_totalprice as decimal(18,2)) as varchar) AS "Gross", '' AS "Memo" FROM orders""")
def snk3_invoice(t: Tables):
    """Invoice-grain file."""
    columns = [("Invoice", "o_orderkey", sinks.MAPPED), ("Gross", "o_totalprice", sinks.MAPPED), ("Memo", None, sinks.UNMAPPED)]
    return sinks.export_columns(cast_declared(t.orders, {"o_totalprice": "decimal(18,2)"}), columns)


@query("prj1", """
SELECT event_id, lower(event_type) AS kind, value * 2 AS doubled FROM events WHERE value > 10 AND event_type <> 'error'""")
def prj1(t: Tables):
    return conform(t.events, "value > 10 AND event_type <> 'error'", {"kind": "lower(event_type)", "doubled": "value * 2"}
                   ).select("event_id", "kind", "doubled")


TEST_ROWS = """lang = 'en' AND doc_id IS NOT NULL AND trim(text) <> '' AND lower(coalesce(source, '')) <> 'src1'
AND coalesce(nullif(source, 'src2'), '') <> '' AND lower(coalesce(text, '')) NOT LIKE '%test%'"""


@query("prj2", f"SELECT doc_id, lang, source, n_chars FROM documents WHERE {TEST_ROWS}")
def prj2(t: Tables):
    return conform(t.documents, TEST_ROWS).select("doc_id", "lang", "source", "n_chars")


EDGE = "parent IS NOT NULL AND parent <> '' AND child IS NOT NULL AND child <> ''"
S_EDGE_SOURCE = "CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN NULL ELSE cast(c_nationkey as {}) END"


@query("prj3", f"""
SELECT child AS child_code, parent AS parent_code, 'ASSERTED' AS relationship_status
FROM (SELECT c_name AS child, {S_EDGE_SOURCE.format('varchar')} AS parent FROM customer) WHERE {EDGE}""")
def prj3(t: Tables):
    source = t.customer.select(F.col("c_name").alias("child"), F.expr(S_EDGE_SOURCE.format("string")).alias("parent"))
    return source.where(EDGE).select(F.col("child").alias("child_code"), F.col("parent").alias("parent_code"),
                                     F.lit("ASSERTED").alias("relationship_status"))


@query("prj4", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_extendedprice as decimal(18,2)) as double) AS l_extendedprice,
       cast(cast(l_quantity as int) as int) AS l_quantity FROM lineitem""")
def prj4(t: Tables):
    return cast_declared(t.lineitem, {"l_extendedprice": "decimal(18,2)", "l_quantity": "int"}).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


S_OP = "CASE event_type WHEN 'error' THEN 'd' WHEN 'click' THEN 'u' END"


@query("prj5", f"""
SELECT event_id, '{LOAD}' AS load_dts, cast(ts as varchar) AS applied_dts, 0 AS sub_seq, 'WEB' AS rec_src, 'b1' AS batch_id,
       event_type AS manifest_id, coalesce(upper({S_OP}), 'I') AS cdc_op FROM events""")
def prj5(t: Tables):
    return system_columns(t.events.withColumn("op", F.expr(S_OP)), "WEB", LOAD, "b1", "ts", "event_type", "op").select(
        "event_id", "load_dts", "applied_dts", "sub_seq", "rec_src", "batch_id", "manifest_id", "cdc_op")


@query("prj6", f"""
SELECT {S_LINE} AS nhl_order_line_hk, {S_LINE_ORDER} AS hub_order_hk, {s_key(['l_partkey'])} AS hub_part_hk,
       {S_LINE_SUPPLIER} AS hub_supplier_hk, l_linenumber, cast(l_shipdate as varchar) AS l_shipdate,
       {', '.join(f'cast({e} as double) AS {c}' if 'decimal' in e else c for c, e in zip(LINE_PAYLOAD, S_LINE_MONEY))},
       '{LOAD}' AS load_dts, cast(l_shipdate as varchar) AS applied_dts, 'SALES' AS rec_src, 'b1' AS batch_id, l_returnflag AS manifest_id
FROM lineitem""")
def prj6(t: Tables):
    return log_of(t, "nhl_order_line")


@query("prj7", f"""
SELECT 'srm' AS system, cast(s_suppkey as varchar) AS supplier_code, {s_key(["'srm'", 's_suppkey'])} AS hub_supplier_hk FROM supplier""")
def prj7(t: Tables):
    return staged(t, "hub_supplier").select("system", "supplier_code", "hub_supplier_hk")


@query("prj8", f"SELECT concat_ws('||', {s_norm('c_mktsegment')}, {s_norm('c_custkey')}) AS hub_account_bk FROM customer")
def prj8(t: Tables):
    return staged(t, "hub_account").select("hub_account_bk")


@query("prj9", f"""
SELECT event_id, concat_ws('|', {s_norm('event_type')}, {s_norm("nullif(props, '{\"k\": 9}')")}) AS mas_key FROM events""")
def prj9(t: Tables):
    return t.events.select("event_id", sub_key(["event_type", F.nullif("props", F.lit('{"k": 9}'))]).alias("mas_key"))


@query("prj10", """
SELECT NULL AS event_type, o_custkey AS o_custkey, o_orderkey AS o_orderkey, cast(NULL as bigint) AS user_id FROM orders UNION ALL
SELECT event_type, NULL, NULL, user_id FROM events""")
def prj10(t: Tables):
    """Only what consumers read of a wide union; the scans below read those columns only."""
    wide = aligned_union({"orders": t.orders, "events": t.events})
    return narrow(wide, ["user_id", "EVENT_TYPE", "o_orderkey", "o_custkey"])


@query("prj11", f"""
SELECT event_id, event_type, coalesce(upper({S_OP}), 'I') AS cdc_op FROM events WHERE coalesce(upper({S_OP}), 'I') IN ('I', 'U')""")
def prj11(t: Tables):
    return kept_operations(staged(t, "sat_user")).select("event_id", "event_type", "cdc_op")


@query("prj12", f"""
SELECT {S_CUSTOMER} AS hub_customer_hk, 'SALES' AS rec_src FROM orders UNION ALL
SELECT {s_key(['c_custkey'], 'CRM')}, 'CRM' FROM customer""")
def prj12(t: Tables):
    """The active bindings of one hub; the inactive one stays out."""
    entity = active_bindings(MODEL, ["hub_customer/CRM", "hub_customer/SALES"])["hub_customer"]
    return union_feeds([log_of(t, "hub_customer", b.rec_src).select("hub_customer_hk", "rec_src") for b in entity.bindings])


S_MODULE = "CASE l_returnflag WHEN 'A' THEN ' ts' WHEN 'R' THEN 'ES ' WHEN 'N' THEN CASE WHEN l_linestatus = 'O' THEN 'MI' ELSE 'tax' END END"


@query("prj13", f"""
SELECT l_orderkey, l_linenumber, CASE upper(trim({S_MODULE})) WHEN 'TS' THEN l_partkey WHEN 'ES' THEN l_suppkey WHEN 'MI' THEN l_orderkey END AS routed
FROM lineitem""")
def prj13(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", module_value(
        F.expr(S_MODULE), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")).alias("routed"))
