"""Keys and digests."""

from pyspark.sql import functions as F

from lodestrata.functions.keys import (
    hash_key, hashdiff, line_reference, link_key, norm, row_digest, zero_key,
)
from lodestrata.operators.load import ghost, with_ghost
from lodestrata.operators.ordered import same
from lodestrata.operators.staging import hash_columns
from lodestrata.plans.registry import Tables, query, s_diff, s_key, s_money, s_norm, s_text
from lodestrata.plans.warehouse import (
    LOAD, MODEL, S_LINE, S_LINE_ORDER, S_LINE_SUPPLIER, S_LINK, S_ORDER, log_of, staged,
)


@query("key1", f"""
SELECT doc_id, {s_norm('lang')} AS lang_key, {s_norm("nullif(source, 'src1')")} AS source_key,
       {s_norm("concat('  ', source, ' ')", False)} AS source_text, sha256({s_norm('text', False)}) AS text_digest
FROM documents""")
def key1(t: Tables):
    return t.documents.select(
        "doc_id", norm("lang").alias("lang_key"), norm(F.nullif("source", F.lit("src1"))).alias("source_key"),
        norm(F.concat(F.lit("  "), "source", F.lit(" ")), upper=False).alias("source_text"),
        F.sha2(norm("text", upper=False), 256).alias("text_digest"))


@query("key2", f"""
SELECT o_orderkey, {S_ORDER} AS federated, {s_key(['o_orderkey'])} AS authored,
       {s_key(['o_orderpriority', 'o_custkey'], 'SALES')} AS composite FROM orders""")
def key2(t: Tables):
    return t.orders.select("o_orderkey", hash_key(["o_orderkey"], "sales").alias("federated"),
                           hash_key(["o_orderkey"]).alias("authored"),
                           hash_key(["o_orderpriority", "o_custkey"], "SALES").alias("composite"))


@query("key3", f"""
SELECT c_mktsegment AS tenant, cast(c_custkey as varchar) AS account, {s_key(['c_mktsegment', 'c_custkey'], 'FIN')} AS hub_account_hk
FROM customer""")
def key3(t: Tables):
    return staged(t, "hub_account").select("tenant", "account", "hub_account_hk")


@query("key4", f"""
WITH child AS (SELECT {S_LINE_SUPPLIER} AS s, {S_LINE_ORDER} AS o, {s_key(['l_partkey'])} AS p FROM lineitem)
SELECT s AS hub_supplier_hk, p AS hub_part_hk, count(*) AS line_count, count(DISTINCT o) AS orders,
       s IN (SELECT {s_key(["'srm'", 's_suppkey'])} FROM supplier) AS supplier_found,
       p IN (SELECT {s_key(['p_partkey'])} FROM part) AS part_found
FROM child GROUP BY s, p""")
def key4(t: Tables):
    """A child's parent keys are the hubs' own. The parents' numbers tell lines apart as their keys do, so lines are
    counted by number, each number's key is looked for once, and a pair carries its keys only when it is done."""
    line = MODEL["nhl_order_line"]
    keys, number = hash_columns(MODEL, line, line.bindings[0]), {k: c for k, (c,) in line.bindings[0].parent_keys.items()}
    pair = [number["hub_supplier"], number["hub_part"]]
    lines = (t.lineitem.groupBy(*pair, number["hub_order"]).agg(F.count(F.lit(1)).alias("_lines"))
             .groupBy(*pair).agg(F.sum("_lines").alias("line_count"), F.count(F.lit(1)).alias("orders")))
    for hub, flag in (("hub_supplier", "supplier_found"), ("hub_part", "part_found")):
        hk, named = f"{hub}_hk", number[hub]
        own = staged(t, hub).select(hk).withColumn(flag, F.lit(True))
        looked = t.lineitem.select(named).distinct().withColumn(hk, keys[hk]).join(own, hk, "left").na.fill(False, [flag])
        looked = looked.select(F.col(named).alias("_n_" + named), flag)
        lines = lines.join(looked, same(lines, looked, [named], "_n_")).drop("_n_" + named)
    return lines.select(keys["hub_part_hk"].alias("hub_part_hk"), keys["hub_supplier_hk"].alias("hub_supplier_hk"),
                        "line_count", "orders", "supplier_found", "part_found")


@query("key5", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {S_LINE} AS nhl_order_line_hk FROM lineitem""")
def key5(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        link_key([["l_orderkey"], ["l_partkey"], [F.lit("srm"), "l_suppkey"]], ["l_linenumber", "l_shipdate"], "SALES")
        .alias("nhl_order_line_hk"))


S_GROUP = "cast(c_custkey // 10 as bigint)"


@query("key6", f"""
SELECT c_custkey, {s_key([S_GROUP], 'CRM')} AS parent_hub_customer_hk, {s_key(['c_custkey'], 'CRM')} AS child_hub_customer_hk,
       {s_key([S_GROUP, 'c_custkey'], 'CRM')} AS hal_customer_group_hk FROM customer""")
def key6(t: Tables):
    return staged(t, "hal_customer_group").select(
        "c_custkey", "parent_hub_customer_hk", "child_hub_customer_hk", "hal_customer_group_hk")


@query("key7", f"""
SELECT o_orderkey, {S_LINK} AS link_order_customer_hk, {s_diff(['o_orderstatus', 'o_orderpriority'])} AS hashdiff FROM orders""")
def key7(t: Tables):
    """A link-parented satellite derives the link's key from the same components."""
    return t.orders.select("o_orderkey", link_key([["o_orderkey"], ["o_custkey"]], scope="SALES").alias("link_order_customer_hk"),
                           hashdiff(["o_orderstatus", "o_orderpriority"]).alias("hashdiff"))


S_SPARSE = "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END"


@query("key8", f"""
SELECT o_orderkey, {s_diff(['o_orderstatus', s_money('o_totalprice'), S_SPARSE])} AS hashdiff,
       {s_diff(['o_orderstatus', s_money('o_totalprice'), S_SPARSE])} AS grown,
       {s_diff([S_SPARSE, 'o_orderstatus'])} AS reordered FROM orders""")
def key8(t: Tables):
    """Appended NULL columns leave a digest as it was."""
    rows = t.orders.withColumns({"price": F.col("o_totalprice").cast("decimal(18,2)"), "sparse": F.expr(S_SPARSE)})
    none = F.lit(None).cast("string")
    return rows.select("o_orderkey", hashdiff(["o_orderstatus", "price", "sparse"]).alias("hashdiff"),
                       hashdiff(["o_orderstatus", "price", "sparse", none, none]).alias("grown"),
                       hashdiff(["sparse", "o_orderstatus"]).alias("reordered"))


@query("key9", f"""
SELECT o_orderkey, {S_ORDER} AS sha2_key, sha1({s_text(['o_orderkey'], 'SALES')}) AS sha1_key FROM orders""")
def key9(t: Tables):
    return t.orders.select("o_orderkey", hash_key(["o_orderkey"], "SALES").alias("sha2_key"),
                           hash_key(["o_orderkey"], "SALES", "sha1").alias("sha1_key"))


@query("key9_xxhash64")
def key9_xxhash64(t: Tables):
    """The third algorithm has no counterpart in the oracle's engine: checked by row count."""
    return t.orders.select("o_orderkey", hash_key(["o_orderkey"], "SALES", "xxhash64").alias("xxhash64_key"))


@query("key10", f"""
SELECT repeat('00', 32) AS zero_key, repeat('00', 20) AS short_zero_key, count(*) AS rows_checked,
       count(*) FILTER ({S_ORDER} = repeat('00', 32)) AS rows_at_zero FROM orders""")
def key10(t: Tables):
    """No stored key may meet the zero key."""
    return staged(t, "hub_order").agg(
        F.max(zero_key()).alias("zero_key"), F.max(zero_key(20)).alias("short_zero_key"),
        F.count(F.lit(1)).alias("rows_checked"), F.count_if(F.col("hub_order_hk") == zero_key()).alias("rows_at_zero"))


@query("key11", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {s_diff([S_LINE, 'l_linenumber', s_money('l_quantity'), s_money('l_extendedprice'), 'l_returnflag', "nullif(l_linestatus, 'O')"])} AS digest
FROM lineitem""")
def key11(t: Tables):
    rows = staged(t, "nhl_order_line").withColumn("open_status", F.nullif("l_linestatus", F.lit("O")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", row_digest(
        ["l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "open_status"], ["nhl_order_line_hk"]).alias("digest"))


IDENTITY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_shipdate"]
S_IDENTITY = [s_money(c) if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") else c for c in IDENTITY]


@query("key12", f"""
SELECT l_orderkey, l_linenumber, sha256({s_text(S_IDENTITY, upper=False)}) AS line_reference FROM lineitem""")
def key12(t: Tables):
    money = {c: F.col(c).cast("decimal(18,2)") for c in IDENTITY[4:8]}
    return t.lineitem.withColumns(money).select("l_orderkey", "l_linenumber", line_reference(IDENTITY).alias("line_reference"))


@query("key13", f"""
SELECT {S_ORDER} AS hub_order_hk, cast(o_orderkey as varchar) AS order_key, 'SALES' AS rec_src, '{LOAD}' AS load_dts FROM orders
UNION ALL SELECT repeat('00', 32), NULL, 'SYSTEM', '1900-01-01 00:00:00'""")
def key13(t: Tables):
    return with_ghost(log_of(t, "hub_order"), "hub_order_hk").select("hub_order_hk", "order_key", "rec_src", "load_dts")


@query("key13_satellite", f"""
WITH s AS (SELECT {S_ORDER} AS hub_order_hk, o_orderstatus FROM orders)
SELECT hub_order_hk, o_orderstatus, '' AS missing FROM s UNION ALL
SELECT repeat('00', 32), NULL, 'hashdiff,manifest_id' FROM (SELECT count(*) AS n FROM s) WHERE n > 0""")
def key13_satellite(t: Tables):
    """The ghost of a satellite has its whole shape, with typed NULLs outside the system columns."""
    rows = log_of(t, "sat_order")
    absent = F.concat_ws(",", F.when(F.col("hashdiff").isNull(), "hashdiff"), F.when(F.col("manifest_id").isNull(), "manifest_id"))
    ghosts = ghost(rows).select("hub_order_hk", "o_orderstatus", absent.alias("missing"))
    return rows.select("hub_order_hk", "o_orderstatus", F.lit("").alias("missing")).unionByName(ghosts)


@query("key14", f"""
SELECT 'key' AS digest, count(*) AS compared, 0 AS different FROM orders UNION ALL
SELECT 'hashdiff', count(*), 0 FROM orders UNION ALL SELECT 'hashdiff_grown', count(*), 0 FROM orders""")
def key14(t: Tables):
    """Digests derived two ways (column expressions and SQL text) must be equal in every row."""
    want_key = F.expr("unhex(sha2(concat_ws('||', 'SALES', coalesce(nullif(upper(trim(cast(o_orderkey AS string))), ''), '^^')), 256))")
    payload = ["o_orderstatus", "o_orderpriority"]
    joined = "concat_ws('||', coalesce(nullif(trim(o_orderstatus), ''), '^^'), coalesce(nullif(trim(o_orderpriority), ''), '^^'))"
    want_diff = F.expr(rf"unhex(sha2(regexp_replace({joined}, '(\\|\\|\\^\\^)+$', ''), 256))")
    pairs = [("key", hash_key(["o_orderkey"], "SALES"), want_key), ("hashdiff", hashdiff(payload), want_diff),
             ("hashdiff_grown", hashdiff([*payload, F.lit(None).cast("string")]), want_diff)]
    return t.orders.agg(F.array(*[F.struct(
        F.lit(n).alias("digest"), F.count(F.lit(1)).alias("compared"),
        F.count_if(~got.eqNullSafe(want)).cast("int").alias("different")) for n, got, want in pairs]).alias("a")
    ).select(F.inline("a"))
