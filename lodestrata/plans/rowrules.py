"""Row rules of invoice lines, and the built-in functions in use."""

from pyspark.sql import functions as F

from lodestrata.functions import rules
from lodestrata.operators.quality import any_mismatch
from lodestrata.plans.registry import Tables, query, s_money

# Names, codes and amounts with the blemishes they arrive with, cut out of the tables.
S_TYPE = "CASE l_returnflag WHEN 'A' THEN ' ts ' WHEN 'R' THEN 'ES' ELSE CASE WHEN l_linestatus = 'O' THEN 'Mi' ELSE ' tAx ' END END"
S_TASK = "CASE l_linenumber WHEN 1 THEN concat('T|', l_partkey) WHEN 2 THEN concat(' A|B|', l_partkey, ') ') WHEN 3 THEN concat('X(', l_partkey, ')') WHEN 4 THEN '   ' WHEN 5 THEN NULL WHEN 6 THEN concat('Y|', l_suppkey, ')))') ELSE concat('Z)', l_suppkey) END"
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
S_ID = ", ".join(LINE)


def lines(t: Tables, **derived: str):
    return t.lineitem.select(*LINE, *[F.expr(e).alias(n) for n, e in derived.items()])


@query("rule1", """
SELECT c_custkey, CASE WHEN last = '' AND first = '' THEN NULL ELSE concat(last, ', ', first) END AS worker, last = '' AND first = '' AS refused
FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE trim(c_mktsegment) END AS last, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 10 = 0 THEN '' ELSE c_name END AS first FROM customer)""")
def rule1(t: Tables):
    rows = t.customer.select("c_custkey", F.expr("CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE concat(' ', c_mktsegment) END AS last"),
                             F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN '\\t' ELSE concat(c_name, ' ') END AS first"))
    name = rules.worker_name("last", "first")
    return rows.select("c_custkey", name.alias("worker"), name.isNull().alias("refused"))


@query("rule2", f"""
SELECT {S_ID}, text AS line_description, l_orderkey || '|' || text AS description FROM (
  SELECT *, l_returnflag || ', ' || l_linestatus || '|' || CASE WHEN l_orderkey % 9 > 0 THEN strftime(l_shipdate, '%Y-%m-%d') END || '|' || l_linenumber AS text FROM lineitem)""")
def rule2(t: Tables):
    """A line without a week ending has no description."""
    rows = t.lineitem.withColumn("week_ending", F.when(F.expr("l_orderkey % 9 > 0"), F.date_format("l_shipdate", "yyyy-MM-dd")))
    args = ("l_returnflag", "l_linestatus", "week_ending", "l_linenumber")
    return rows.select(*LINE, rules.line_description(*args).alias("line_description"), rules.line_description(*args, "l_orderkey").alias("description"))


@query("rule3", f"SELECT {S_ID}, CASE WHEN lower(trim({S_TYPE})) = 'tax' THEN 'TAX' ELSE 'ITEM' END AS line_type FROM lineitem")
def rule3(t: Tables):
    return lines(t, code=S_TYPE).select(*LINE, rules.line_type("code").alias("line_type"))


S_TASK_RULE = "CASE WHEN trim(coalesce(task, '')) = '' THEN NULL ELSE trim(rtrim(CASE WHEN strpos(trim(task), '|') > 0 THEN substr(trim(task), strpos(trim(task), '|') + 1) ELSE trim(task) END, ')')) END"


@query("rule4", f"SELECT {S_ID}, {S_TASK_RULE} AS task_number FROM (SELECT *, {S_TASK} AS task FROM lineitem)")
def rule4(t: Tables):
    return lines(t, task=S_TASK).select(*LINE, rules.task_number("task").alias("task_number"))


@query("rule5", f"SELECT {S_ID}, CASE upper(trim({S_TYPE})) WHEN 'TS' THEN concat('t', l_partkey) WHEN 'ES' THEN concat('e', l_suppkey) WHEN 'MI' THEN concat('m', l_orderkey) END AS module_value FROM lineitem")
def rule5(t: Tables):
    rows = lines(t, code=S_TYPE, ts="concat('t', l_partkey)", es="concat('e', l_suppkey)", mi="concat('m', l_orderkey)")
    return rows.select(*LINE, rules.module_value("code", "ts", "es", "mi").alias("module_value"))


S_MARGIN = "CASE WHEN l_returnflag <> 'N' THEN cast(l_tax * 100 as decimal(18,2)) END"
S_CLIENT = f"CASE WHEN l_linenumber = 3 THEN {s_money('l_extendedprice')} ELSE cast({s_money('l_extendedprice')} + coalesce({S_MARGIN}, 0) as decimal(18,2)) END"


@query("rule6", f"SELECT {S_ID}, l_linenumber <> 3 OR coalesce({S_MARGIN}, 0) = 0 AS consistent FROM lineitem")
def rule6(t: Tables):
    rows = lines(t, supplier=s_money("l_extendedprice"), margin=S_MARGIN, client=S_CLIENT)
    return rows.select(*LINE, rules.client_amount_consistent("client", "supplier", "margin").alias("consistent"))


@query("rule7", f"SELECT {S_ID}, CASE WHEN trim({S_TYPE}) = 'ES' AND {S_MARGIN} <> 0 THEN concat('fee of ', cast({S_MARGIN} as varchar), ' on an expense line') ELSE '' END AS reason FROM lineitem")
def rule7(t: Tables):
    return lines(t, code=S_TYPE, fee=S_MARGIN).select(*LINE, rules.fee_violation("code", "fee").alias("reason"))


@query("rule8", """
SELECT p_partkey, CASE WHEN length(concat(' ', p_brand)) > 5 AND p_partkey % 3 > 0 THEN substr(p_brand, 1, 4) END AS tenant,
  CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN NULL ELSE concat('R', p_partkey) END AS reference,
  CASE WHEN p_partkey % 4 > 1 AND p_size % 5 > 0 THEN concat('R', p_partkey, '#', p_size % 5) END AS synthetic FROM part""")
def rule8(t: Tables):
    rows = t.part.select(
        "p_partkey", F.expr("CASE WHEN p_partkey % 3 > 0 THEN concat(' ', p_brand) ELSE ' abcd ' END AS number"), (F.col("p_size") % 5).alias("line"),
        F.expr("CASE p_partkey % 4 WHEN 0 THEN concat(p_brand, '|', p_type) WHEN 1 THEN concat(p_brand, '|', p_type, '||  |x') ELSE concat(p_brand, '|', p_type, '||', ' R', p_partkey) END AS text"))
    ref = rules.pipe_field("text")
    return rows.select("p_partkey", rules.tenant_of("number").alias("tenant"), ref.alias("reference"), rules.synthetic_reference(ref, "line").alias("synthetic"))


@query("rule9", """
SELECT event_id, cast(CASE event_id % 4 WHEN 0 THEN cast(value as decimal(18,2)) WHEN 1 THEN cast(user_id as decimal(18,2)) END as double) AS amount FROM events""")
def rule9(t: Tables):
    text = F.expr("CASE event_id % 4 WHEN 0 THEN concat(' ', cast(cast(value AS decimal(18,2)) AS string)) WHEN 1 THEN concat(user_id, '\\t') WHEN 2 THEN props ELSE '' END")
    return t.events.select("event_id", rules.money(text).alias("amount"))


@query("rule10", """
SELECT 'line_type' AS rule, count(*) AS compared, cast(0 as bigint) AS different FROM lineitem UNION ALL
SELECT 'module_value', count(*), 0 FROM lineitem UNION ALL SELECT 'task_number', count(*), 0 FROM lineitem""")
def rule10(t: Tables):
    """The column rules against the same rules as SQL text, over every line."""
    edges = r"'^\\s+|\\s+$', ''"
    code, task = f"regexp_replace(coalesce(code, ''), {edges})", f"regexp_replace(coalesce(task, ''), {edges})"
    rows = lines(t, code=S_TYPE, task=S_TASK, ts="concat('t', l_partkey)", es="concat('e', l_suppkey)", mi="concat('m', l_orderkey)")
    return any_mismatch(rows, {
        "line_type": (rules.line_type("code"), F.expr(f"if(upper({code}) = 'TAX', 'TAX', 'ITEM')")),
        "task_number": (rules.task_number("task"), F.expr(
            f"nullif(regexp_replace(regexp_replace(substr({task}, locate('|', {task}) + 1), '[)]+$', ''), {edges}), '')")),
        "module_value": (rules.module_value("code", "ts", "es", "mi"), F.expr(f"decode(upper({code}), 'TS', ts, 'ES', es, 'MI', mi)"))})


@query("fn1", """
SELECT event_id, cast(trunc(value) as int) AS whole, try_cast(props as int) AS props_number, try_cast(CASE event_id % 2 WHEN 0 THEN '12' ELSE 'x' END as int) AS mixed FROM events""")
def fn1(t: Tables):
    return t.events.select("event_id", F.col("value").cast("int").alias("whole"), F.col("props").try_cast("int").alias("props_number"),
                           F.expr("CASE event_id % 2 WHEN 0 THEN '12' ELSE 'x' END").try_cast("int").alias("mixed"))


@query("fn2", """
SELECT doc_id, upper(lang) AS up, lower(source) AS low, left(lang, 1) AS first, concat(lang, source) AS joined, concat_ws('|', lang, nullif(source, 'src1'), chr(31)) AS spaced, strpos(text, 'the') AS at, length(trim(text)) AS trimmed FROM documents""")
def fn2(t: Tables):
    return t.documents.select(
        "doc_id", F.upper("lang").alias("up"), F.lower("source").alias("low"), F.left("lang", F.lit(1)).alias("first"), F.concat("lang", "source").alias("joined"),
        F.concat_ws("|", "lang", F.nullif("source", F.lit("src1")), F.char(F.lit(31))).alias("spaced"), F.instr("text", "the").cast("long").alias("at"), F.length(F.trim("text")).cast("long").alias("trimmed"))


@query("fn3", """
SELECT event_id, coalesce(nullif(event_type, 'view'), 'none') AS kind, nullif(event_type, 'view') IS DISTINCT FROM 'click' AS differs, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS code FROM events""")
def fn3(t: Tables):
    kind = F.nullif("event_type", F.lit("view"))
    return t.events.select("event_id", F.coalesce(kind, F.lit("none")).alias("kind"), (~kind.eqNullSafe("click")).alias("differs"),
                           F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).otherwise(3).alias("code"))


@query("fn4", r"""
SELECT doc_id, sha256(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS stripped, sha256(regexp_replace(text, '^[^e]*[e]', '')) AS after_first, length(regexp_replace(text, '[.]+$', '')) AS no_tail FROM documents""")
def fn4(t: Tables):
    """Whole texts."""
    return t.documents.select("doc_id", F.sha2(F.regexp_replace("text", r"^\s+|\s+$", ""), 256).alias("stripped"),
                              F.sha2(F.regexp_replace("text", "^[^e]*[e]", ""), 256).alias("after_first"), F.length(F.regexp_replace("text", "[.]+$", "")).cast("long").alias("no_tail"))


@query("fn5", """
SELECT doc_id, sha256(text) AS sha2, sha1(text) AS sha1, md5(text) AS md5, hex(md5(text)) AS hexed, cast(cast(concat('0x', substr(md5(text), 1, 15)) as bigint) as varchar) AS number FROM documents""")
def fn5(t: Tables):
    return t.documents.select("doc_id", F.sha2("text", 256).alias("sha2"), F.sha1("text").alias("sha1"), F.md5("text").alias("md5"),
                              F.hex(F.md5("text")).alias("hexed"), F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).alias("number"))


@query("fn5_crc32")
def fn5_crc32(t: Tables):
    return t.documents.select("doc_id", F.crc32("text").alias("crc32"), F.xxhash64("text").alias("xxhash64"), F.unhex(F.md5("text")).alias("unhexed"))


@query("fn6", """
SELECT o_orderkey, cast(cast(o_orderdate as date) as varchar) AS day, o_orderdate < timestamp '1997-01-01 00:00:00' AS early, cast(o_orderdate as date) = date '1998-02-01' AS that_day FROM orders""")
def fn6(t: Tables):
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.expr("o_orderdate < timestamp_ntz'1997-01-01 00:00:00' AS early"),
                           F.expr("to_date(o_orderdate) = date'1998-02-01' AS that_day"))


@query("fn7", f"""
SELECT {S_ID}, cast(abs({s_money('l_discount')} - {s_money('l_tax')}) as double) AS gap, cast({s_money('l_extendedprice')} + {s_money('l_quantity')} as double) AS total,
  cast(cast(l_quantity as decimal(9,2)) * cast(l_tax as decimal(9,2)) as double) AS product, l_extendedprice / l_quantity AS unit_price, cast(round({s_money('l_extendedprice')}, 1) as double) AS rounded FROM lineitem""")
def fn7(t: Tables):
    d = {c: F.col(c).cast("decimal(18,2)") for c in ("l_discount", "l_tax", "l_extendedprice", "l_quantity")}
    return t.lineitem.select(*LINE, F.abs(d["l_discount"] - d["l_tax"]).alias("gap"), (d["l_extendedprice"] + d["l_quantity"]).alias("total"),
                             (F.col("l_quantity").cast("decimal(9,2)") * F.col("l_tax").cast("decimal(9,2)")).alias("product"),
                             (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"), F.round(d["l_extendedprice"], 1).alias("rounded"))


@query("fn8", """
SELECT o_orderkey, unnest([o_orderstatus, o_orderpriority]) AS item, 2 AS items FROM orders""")
def fn8(t: Tables):
    return t.orders.select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("a")).select(
        "o_orderkey", F.explode("a").alias("item"), F.size("a").alias("items"))


@query("fn8_collect", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def fn8_collect(t: Tables):
    """Collected values are distinct first; there are five of them."""
    return t.orders.select("o_custkey", "o_orderpriority").distinct().groupBy("o_custkey").agg(
        F.array_sort(F.collect_list("o_orderpriority")).alias("priorities"))


@query("fn9", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def fn9(t: Tables):
    return t.customer.selectExpr("* EXCEPT (c_acctbal, c_name)")
