"""Data quality, quarantine, validation, conformance and masks."""

from dataclasses import replace

from pyspark.sql import functions as F

from lodestrata.functions import validity
from lodestrata.functions.keys import key_rules
from lodestrata.functions.masking import mask
from lodestrata.model import Binding
from lodestrata.operators import quality, reports
from lodestrata.operators.staging import declared_columns, mandatory_rules, stage
from lodestrata.plans.registry import Tables, query, s_key
from lodestrata.plans.warehouse import (
    LINE_MONEY, LINE_PAYLOAD, LOAD, MODEL, S_LINE_MONEY, S_LINE_SUPPLIER,
)

# Key components with holes: blanks, delimiters and null tokens at known places.
DIRTY = ("CASE l_linenumber % 7 WHEN 1 THEN '  ' WHEN 2 THEN concat('a||', l_orderkey) WHEN 3 THEN ' ^^ ' "
         "WHEN 4 THEN NULL ELSE concat('K', l_orderkey) END")


def dirty_lines(t: Tables):
    return t.lineitem.withColumn("code", F.expr(DIRTY))


S_SAFE = {
    "key_present_code": "coalesce(code IS NOT NULL AND trim(code) <> '', false)",
    "key_no_delimiter_code": "coalesce(strpos(code, '||'), 0) = 0",
    "key_not_null_token_code": "coalesce(trim(code) <> '^^', true)",
}
S_DIRTY = f"SELECT *, {DIRTY} AS code FROM lineitem"


@query("dq1", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(f'{e} AS {n}' for n, e in S_SAFE.items())} FROM ({S_DIRTY})""")
def dq1(t: Tables):
    return dirty_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[
        F.coalesce(rule, F.lit(False)).alias(n) for n, rule in key_rules(["code"])])


S_TYPED = {n.replace("_code", "_code_bytes"): e for n, e in S_SAFE.items()}


@query("dq1_typed", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(f'{e} AS {n}' for n, e in S_TYPED.items())},
  l_partkey IS NOT NULL AS key_present_l_partkey, TRUE AS key_no_delimiter_l_partkey, TRUE AS key_not_null_token_l_partkey FROM ({S_DIRTY})""")
def dq1_typed(t: Tables):
    """With a schema: a binary component is read as text, a number has only to be there."""
    rows = dirty_lines(t).withColumn("code_bytes", F.encode("code", "UTF-8"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[
        F.coalesce(rule, F.lit(False)).alias(n) for n, rule in key_rules(["code_bytes", "l_partkey"], schema=rows.schema)])


DIRTY_BINDING = Binding(
    "lineitem", "SALES", parent_keys={"hub_order": ("code",), "hub_part": ("l_partkey",), "hub_supplier": ("l_suppkey",)},
    txn_keys=("l_linenumber",), payload=LINE_PAYLOAD, casts=LINE_MONEY, derived={"code": DIRTY}, applied="l_shipdate",
    manifest="l_returnflag")
NHL = MODEL["nhl_order_line"]


def dirty_stage(t: Tables):
    return stage(t.lineitem, MODEL, NHL, DIRTY_BINDING, load_dts=LOAD, batch_id="b1")


def dirty_rules(t: Tables):
    return mandatory_rules(NHL, DIRTY_BINDING, dirty_stage(t).schema)


S_FIRST = f"CASE {' '.join(f'WHEN NOT {e} THEN {chr(39)}{n}{chr(39)}' for n, e in S_SAFE.items())} END"


@query("dq2", f"""
SELECT count(*) AS row_count, {', '.join(f"count(*) FILTER (NOT {e}) AS {n}" for n, e in S_SAFE.items())},
       (SELECT cast(count(*) as int) FROM (VALUES ('code'), ('l_partkey'), ('l_suppkey'), ('l_linenumber')) c(x), (VALUES ('present'), ('no_delimiter'), ('not_null_token')) r(y)) AS rules_applied FROM ({S_DIRTY})""")
def dq2(t: Tables):
    """Failures per mandatory rule; the parents' components are guarded too."""
    rules = dirty_rules(t)
    shown = [r for r in rules if r[0] in S_SAFE]
    return dirty_stage(t).agg(F.count(F.lit(1)).alias("row_count"), *[
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(n) for n, rule in shown]).withColumn(
            "rules_applied", F.lit(len(rules)))


SUB_KEY = "CASE user_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN concat('a||', event_type) WHEN 3 THEN ' ^^' ELSE event_type END"
S_SUB = f"SELECT event_id, {SUB_KEY} AS sub_key FROM events"


@query("dq2_sub_key", f"""
SELECT event_id, CASE WHEN sub_key IS NULL OR trim(sub_key) = '' THEN 'key_present_sub_key' WHEN strpos(sub_key, '||') > 0 THEN 'key_no_delimiter_sub_key'
  WHEN trim(sub_key) = '^^' THEN 'key_not_null_token_sub_key' END AS failure_rule FROM ({S_SUB})""")
def dq2_sub_key(t: Tables):
    """Sub-keys of a multi-active satellite in every state."""
    entity = MODEL["msat_user_activity"]
    binding = replace(entity.bindings[0], derived={**entity.bindings[0].derived, "sub_key": SUB_KEY}, mas_keys=("sub_key",))
    rows = stage(t.events, MODEL, entity, binding, load_dts=LOAD, batch_id="b1")
    valid, rejected = quality.split(rows, mandatory_rules(entity, binding, rows.schema))
    return valid.select("event_id", F.lit(None).cast("string").alias("failure_rule")).unionByName(rejected.select("event_id", "failure_rule"))


CONFIGURED = [("orders", "price_positive", "o_totalprice > 1000", True, "drop"),
              ("orders", "status_known", "o_orderstatus IN ('F', 'O')", True, "drop"),
              ("orders", "old_rule", "o_custkey < 0", False, "drop"),
              ("orders", "advice", "o_custkey < 0", True, "warn"),
              ("lineitem", "quantity_small", "l_quantity < 10", True, "drop")]


def rules_table(t: Tables):
    return t.spark.createDataFrame(
        CONFIGURED, "dataset string, rule_name string, rule_sql string, is_current boolean, severity string")


@query("dq3", """
SELECT o_orderkey, CASE WHEN NOT o_totalprice > 1000 THEN 'price_positive' WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status_known' END AS failure_rule
FROM orders WHERE NOT o_totalprice > 1000 OR o_orderstatus NOT IN ('F', 'O')""")
def dq3(t: Tables):
    """Rules as data: current drop rules of one dataset, from the rules table."""
    rules = quality.configured_rules(rules_table(t), "orders")
    return quality.split(t.orders, rules)[1].select("o_orderkey", "failure_rule")


@query("dq4", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ({S_FIRST}) IS NOT NULL OR NOT l_quantity < 40 AS failed,
       coalesce({S_FIRST}, CASE WHEN NOT l_quantity < 40 THEN 'quantity_small' END) AS reason FROM ({S_DIRTY})""")
def dq4(t: Tables):
    """FALSE and NULL both fail; the first failing rule in order is the reason."""
    rules = quality.merge_rules(key_rules(["code"]), [("quantity_small", F.expr("l_quantity < 40"))])
    failed, reason = quality.violation(rules)
    return dirty_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", failed.alias("failed"), reason.alias("reason"))


@query("dq5", f"""
SELECT 'valid' AS half, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({S_DIRTY}) WHERE ({S_FIRST}) IS NULL AND l_shipdate >= timestamp '1996-01-01'
UNION ALL SELECT 'quarantined', l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({S_DIRTY}) WHERE NOT (({S_FIRST}) IS NULL AND l_shipdate >= timestamp '1996-01-01')""")
def dq5(t: Tables):
    """Complementary halves; the configured rule reads a column the target does not keep."""
    rules = quality.merge_rules(dirty_rules(t), [("shipped", F.expr("l_shipdate >= timestamp_ntz'1996-01-01 00:00:00'"))])
    valid, bad = quality.split(dirty_stage(t), rules)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return valid.select(F.lit("valid").alias("half"), *cols).unionByName(bad.select(F.lit("quarantined").alias("half"), *cols))


S_DIRTY_LINE = s_key(["code", "l_partkey", "'srm'", "l_suppkey", "l_linenumber"], "SALES")


@query("dq6", f"""
SELECT {S_DIRTY_LINE} AS nhl_order_line_hk, {s_key(['code'], 'SALES')} AS hub_order_hk, {s_key(['l_partkey'])} AS hub_part_hk,
       {S_LINE_SUPPLIER} AS hub_supplier_hk, l_linenumber,
       {', '.join(f'cast({e} as double) AS {c}' if 'decimal' in e else c for c, e in zip(LINE_PAYLOAD, S_LINE_MONEY))},
       '{LOAD}' AS load_dts, cast(l_shipdate as varchar) AS applied_dts, 'SALES' AS rec_src, 'b1' AS batch_id, l_returnflag AS manifest_id,
       {S_FIRST} AS failure_rule, 'expectation violated' AS failure_detail
FROM ({S_DIRTY}) WHERE ({S_FIRST}) IS NOT NULL""")
def dq6(t: Tables):
    """The quarantine twin: the target's shape plus why."""
    return quality.quarantine(dirty_stage(t), dirty_rules(t), declared_columns(NHL, DIRTY_BINDING))


@query("dq7", f"""
SELECT {S_FIRST} AS failure_rule, count(*) AS rejected FROM ({S_DIRTY}) WHERE ({S_FIRST}) IS NOT NULL GROUP BY 1""")
def dq7(t: Tables):
    return quality.reject_counts(quality.split(dirty_stage(t), dirty_rules(t))[1])


# Each nation is a dataset; its rules come from customers' segments.
S_RULES = "SELECT DISTINCT c_nationkey AS dataset, c_mktsegment AS rule_name, c_mktsegment <> 'BUILDING' AND c_nationkey % 3 <> 0 AS is_current FROM customer"
S_TABLES = "SELECT n_nationkey AS table_name FROM nation"
S_PER_TABLE = f"SELECT t.table_name, count(e.rule_name) AS rules_declared FROM ({S_TABLES}) t LEFT JOIN ({S_RULES}) e ON e.dataset = t.table_name AND e.is_current GROUP BY 1"


def coverage_inputs(t: Tables):
    model = t.nation.groupBy("n_regionkey").agg(F.collect_list("n_nationkey").alias("generated_tables"))
    rules = t.customer.select(
        F.col("c_nationkey").alias("dataset"), F.col("c_mktsegment").alias("rule_name"),
        F.expr("c_mktsegment <> 'BUILDING' AND c_nationkey % 3 <> 0").alias("is_current")).distinct()
    return model, rules


@query("dq8", f"""
SELECT count(*) AS tables_total, cast(sum(CASE WHEN rules_declared > 0 THEN 1 ELSE 0 END) as bigint) AS tables_with_a_rule,
       cast(sum(CASE WHEN rules_declared = 0 THEN 1 ELSE 0 END) as bigint) AS tables_with_no_rule FROM ({S_PER_TABLE})""")
def dq8(t: Tables):
    return reports.coverage_headline(*coverage_inputs(t))


@query("dq9", f"""
SELECT table_name, rules_declared, CASE WHEN rules_declared = 0 THEN 'no rule' ELSE 'rule declared' END AS coverage_state FROM ({S_PER_TABLE})""")
def dq9(t: Tables):
    return reports.coverage_by_table(*coverage_inputs(t))


# Texts of every shape a field can arrive in, cut out of the tables.
S_CELL = ("CASE event_id % 11 WHEN 0 THEN cast(cast(value as decimal(18,2)) as {s}) WHEN 1 THEN props WHEN 2 THEN '   ' WHEN 3 THEN 'NaN' "
          "WHEN 4 THEN concat('+', user_id, '.') WHEN 5 THEN concat(user_id, 'e', user_id % 5) WHEN 6 THEN '-Infinity' WHEN 7 THEN concat(user_id, ',5') "
          "WHEN 8 THEN concat('.', event_id) WHEN 9 THEN NULL ELSE concat(' 1_', user_id, chr(9)) END")


@query("dq10", f"""
SELECT event_id, coalesce(regexp_replace(cell, '^\\s+|\\s+$', '', 'g') = '' OR regexp_matches(replace(regexp_replace(cell, '^\\s+|\\s+$', '', 'g'), '_', ''),
  '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'), true) AS valid
FROM (SELECT event_id, {S_CELL.format(s='varchar')} AS cell FROM events)""")
def dq10(t: Tables):
    cells = t.events.select("event_id", F.expr(S_CELL.format(s="string").replace("chr(9)", "'\\t'")).alias("cell"))
    return cells.select("event_id", validity.numeric("cell").alias("valid"))


S_DATE = ("CASE o_orderkey % 6 WHEN 0 THEN substr(cast(o_orderdate as {s}), 1, 10) WHEN 1 THEN concat(substr(cast(o_orderdate as {s}), 1, 8), '31') "
          "WHEN 2 THEN substr(cast(o_orderdate as {s}), 1, 7) WHEN 3 THEN '' WHEN 4 THEN concat(' ', substr(cast(o_orderdate as {s}), 1, 5), '02-29 ') ELSE cast(o_orderdate as {s}) END")


@query("dq11", f"""
SELECT o_orderkey, trim(cell) = '' OR (regexp_matches(trim(cell), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND try_cast(trim(cell) as date) IS NOT NULL) AS valid
FROM (SELECT o_orderkey, {S_DATE.format(s='varchar')} AS cell FROM orders)""")
def dq11(t: Tables):
    cells = t.orders.select("o_orderkey", F.expr(S_DATE.format(s="string")).alias("cell"))
    return cells.select("o_orderkey", validity.iso_date("cell").alias("valid"))


@query("dq12", r"""
SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '\s', '', 'g') = '' AS text_missing,
       regexp_replace(CASE WHEN turn % 3 = 0 THEN concat(' ', chr(9), chr(10)) ELSE role END, '\s', '', 'g') = '' AS role_missing FROM conversations""")
def dq12(t: Tables):
    role = F.when(F.col("turn") % 3 == 0, F.lit(" \t\n")).otherwise(F.col("role"))
    return t.conversations.select("conv_id", "turn", validity.blank("text").alias("text_missing"), validity.blank(role).alias("role_missing"))


S_BOOL = "CASE event_id % 5 WHEN 0 THEN ' y ' WHEN 1 THEN cast(user_id % 4 as {s}) WHEN 2 THEN 'False' WHEN 3 THEN '' ELSE event_type END"


@query("dq13", f"""
SELECT event_id, trim(cell) = '' OR upper(trim(cell)) IN ('0', '1', 'TRUE', 'FALSE', 'Y', 'N') AS valid
FROM (SELECT event_id, {S_BOOL.format(s='varchar')} AS cell FROM events)""")
def dq13(t: Tables):
    return t.events.select("event_id", validity.boolean(F.expr(S_BOOL.format(s="string"))).alias("valid"))


# References: a type per order status, holding the customers of half the nations; 'P' has none.
S_REFS = """SELECT 'F' AS type, cast(c_custkey as {s}) AS value FROM customer WHERE c_nationkey < 12
UNION ALL SELECT 'O', cast(c_custkey as {s}) FROM customer UNION ALL SELECT 'P', '  ' FROM nation"""


def references(t: Tables):
    c = t.customer.select("c_nationkey", F.col("c_custkey").cast("string").alias("value"))
    return (c.where("c_nationkey < 12").select(F.lit("F").alias("type"), "value")
            .unionByName(c.select(F.lit("O").alias("type"), "value"))
            .unionByName(t.nation.select(F.lit("P").alias("type"), F.lit("  ").alias("value"))))


@query("dq14", f"""
WITH refs AS ({S_REFS.format(s='varchar')}), known AS (SELECT DISTINCT type, trim(value) AS value FROM refs WHERE trim(value) <> ''),
n AS (SELECT type, count(*) AS n FROM known GROUP BY type),
found AS (SELECT o.o_orderstatus AS type, count(*) AS checks, count(*) FILTER (k.type IS NULL) AS bad
  FROM orders o LEFT JOIN known k ON k.type = o.o_orderstatus AND k.value = cast(o.o_custkey as varchar) GROUP BY 1)
SELECT found.type, coalesce(n.n, 0) AS reference_values, CASE WHEN coalesce(n.n, 0) > 0 THEN checks ELSE 0 END AS checks,
       CASE WHEN coalesce(n.n, 0) > 0 THEN bad ELSE 0 END AS violations,
       CASE WHEN coalesce(n.n, 0) = 0 THEN 'NOT_EVALUATED' WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM found LEFT JOIN n ON n.type = found.type""")
def dq14(t: Tables):
    return quality.membership(t.orders, references(t), "o_orderstatus", "o_custkey")


FIELD_RULES = {
    "ISNUMERIC": ["o_totalprice", "o_custkey"], "DATEFORMATCHECK": ["day"], "MISSINGVALUE": ["o_orderstatus", "day"],
    "CHECKBOOLEAN": ["o_orderstatus"], "MATCHVALUE_FINISHED": ["o_custkey"], "MATCHVALUE_ANY": ["o_custkey"],
    "MATCHVALUE_PENDING": ["o_custkey"], "CHECKREFERENCES": ["o_custkey"], "NOSUCHRULE": ["day"]}
REFERENCE_TYPES = {"MATCHVALUE_FINISHED": "F", "MATCHVALUE_ANY": "O", "MATCHVALUE_PENDING": "P", "CHECKREFERENCES": None}


@query("dq15", f"""
WITH refs AS ({S_REFS.format(s='varchar')}), known AS (SELECT DISTINCT type, trim(value) AS value FROM refs WHERE trim(value) <> ''),
o AS (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day, cast(o_custkey as varchar) AS customer FROM orders),
matched AS (SELECT rule, count(*) AS asked, count(*) FILTER (k.type IS NULL) AS problems, (SELECT count(*) FROM known WHERE known.type = any_value(v.type)) AS used
  FROM o CROSS JOIN (VALUES ('MATCHVALUE_FINISHED', 'F'), ('MATCHVALUE_ANY', 'O'), ('MATCHVALUE_PENDING', 'P'), ('CHECKREFERENCES', NULL)) v(rule, type) LEFT JOIN known k ON k.type = v.type AND k.value = o.customer GROUP BY 1),
counted AS (
  SELECT 'CHECKBOOLEAN' AS rule, 1 AS fields, count(*) AS checks, count(*) FILTER (upper(trim(o_orderstatus)) NOT IN ('', '0', '1', 'TRUE', 'FALSE', 'Y', 'N')) AS problems, cast(0 as bigint) AS references_used FROM o UNION ALL
  SELECT 'DATEFORMATCHECK', 1, count(*), count(*) FILTER (NOT regexp_matches(day, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')), 0 FROM o UNION ALL
  SELECT 'ISNUMERIC', 2, 2 * count(*), count(*) FILTER (try_cast(cast(o_totalprice as varchar) as double) IS NULL) + count(*) FILTER (try_cast(customer as double) IS NULL), 0 FROM o UNION ALL
  SELECT 'MISSINGVALUE', 2, 2 * count(*), count(*) FILTER (coalesce(trim(o_orderstatus), '') = '') + count(*) FILTER (coalesce(trim(day), '') = ''), 0 FROM o UNION ALL
  SELECT 'NOSUCHRULE', 1, count(*), count(*), 0 FROM o UNION ALL
  SELECT rule, 1, CASE WHEN used > 0 THEN asked ELSE 0 END, CASE WHEN used > 0 THEN problems ELSE 0 END, used FROM matched)
SELECT *, CASE WHEN checks = 0 THEN 'NOT_EVALUATED' WHEN problems > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM counted""")
def dq15(t: Tables):
    orders = t.orders.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return quality.validate_fields(orders, FIELD_RULES, references(t), REFERENCE_TYPES)


@query("dq16", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws(';', CASE WHEN code = '' OR code IS NULL THEN 'code' END, CASE WHEN flag IS NULL THEN 'flag' END) AS missing_fields,
       CASE WHEN code = '' OR code IS NULL OR flag IS NULL THEN 'exception' ELSE 'release' END AS route
FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE l_linestatus END AS code, nullif(l_returnflag, 'N') AS flag FROM lineitem)""")
def dq16(t: Tables):
    lines = t.lineitem.withColumns({
        "code": F.expr("CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE l_linestatus END"),
        "flag": F.nullif("l_returnflag", F.lit("N"))})
    return quality.required_fields(lines, ["l_orderkey", "code", "flag"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "missing_fields", "route")


@query("dq17", """
SELECT column_name, declared_type, present, lost FROM (
  SELECT 'props' AS column_name, 'int' AS declared_type, count(props) AS present, count(props) FILTER (try_cast(props as int) IS NULL) AS lost FROM events UNION ALL
  SELECT 'event_id', 'int', count(event_id), count(event_id) FILTER (try_cast(cast(event_id as varchar) as int) IS NULL) FROM events UNION ALL
  SELECT 'code', 'decimal(18,2)', count(code), count(code) FILTER (try_cast(code as decimal(18,2)) IS NULL) FROM
    (SELECT CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '12.5' END AS code FROM events))""")
def dq17(t: Tables):
    """All columns in one scan."""
    rows = t.events.withColumn("code", F.expr("CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '12.5' END"))
    return quality.lossy_casts(rows, {"props": "int", "event_id": "int", "code": "decimal(18,2)"})


# Required columns are read from one table of names, the columns that exist from another.
S_REQUIRED = "SELECT c_nationkey AS table_name, c_mktsegment AS column_name FROM customer GROUP BY ALL"
# One nation's table is absent, and a quarter of the columns, by nation and segment.
LEFT_OUT = "(c_nationkey = 3 OR (c_nationkey + length(c_mktsegment)) % 4 = 0)"
S_PRESENT = f"SELECT c_nationkey AS table_name, lower(c_mktsegment) AS column_name FROM customer WHERE NOT {LEFT_OUT} GROUP BY ALL"


def inventories(t: Tables):
    def pairs(rows):
        return rows.select(F.col("c_nationkey").alias("table_name"), F.col("c_mktsegment").alias("column_name")).distinct()
    return pairs(t.customer), pairs(t.customer.where(f"NOT {LEFT_OUT}").withColumn("c_mktsegment", F.lower("c_mktsegment")))


@query("dq18", f"""
SELECT r.table_name, r.column_name FROM ({S_REQUIRED}) r LEFT JOIN ({S_PRESENT}) p
ON p.table_name = r.table_name AND p.column_name = lower(r.column_name) WHERE p.table_name IS NULL""")
def dq18(t: Tables):
    return quality.missing_columns(*inventories(t))


# Every fifth table loses values; of every eighth one cast was not probed, of every seventh one probe had no result.
UNPROBED, FAILED = "(c_nationkey % 8 = 1 AND c_mktsegment = 'BUILDING')", "(c_nationkey % 7 = 1 AND c_mktsegment = 'MACHINERY')"
S_LOSSY = f"""SELECT c_nationkey AS table_name, c_mktsegment AS column_name, CASE WHEN NOT {FAILED} THEN n END AS lost FROM (
 SELECT c_nationkey, c_mktsegment, count(*) FILTER (c_nationkey % 5 = 0 AND c_acctbal < 5000) AS n FROM customer WHERE NOT {UNPROBED} GROUP BY ALL)"""


def lossy_found(t: Tables):
    found = t.customer.where(f"NOT {UNPROBED}").groupBy("c_nationkey", "c_mktsegment").agg(F.count_if(F.expr("c_nationkey % 5 = 0 AND c_acctbal < 5000")).alias("lost"))
    return found.select(F.col("c_nationkey").alias("table_name"), F.col("c_mktsegment").alias("column_name"), F.when(F.expr(f"NOT {FAILED}"), F.col("lost")).alias("lost"))


@query("dq19", f"""
WITH r AS ({S_REQUIRED}), p AS ({S_PRESENT}), l AS ({S_LOSSY}),
f AS (SELECT r.table_name, 'MISSING_COLUMN: ' || r.column_name AS finding FROM r LEFT JOIN p ON p.table_name = r.table_name AND p.column_name = lower(r.column_name) WHERE p.table_name IS NULL
  UNION ALL SELECT table_name, 'LOSSY_CAST: ' || column_name || ' loses ' || lost FROM l WHERE lost > 0),
a AS (SELECT d.table_name, d.table_name IN (SELECT table_name FROM p) AS there, NOT EXISTS (FROM r ANTI JOIN (FROM l WHERE lost IS NOT NULL) USING (table_name, column_name) WHERE r.table_name = d.table_name) AS probed,
  (SELECT count(*) FROM f WHERE f.table_name = d.table_name AND finding LIKE 'MISS%') AS m, (SELECT count(*) FROM f WHERE f.table_name = d.table_name AND finding LIKE 'LOSSY%') AS x,
  (SELECT string_agg(finding, ';' ORDER BY finding) FROM f WHERE f.table_name = d.table_name) AS findings FROM (SELECT DISTINCT table_name FROM r) d)
SELECT table_name, CASE WHEN NOT there THEN 'ABSENT' WHEN m + x > 0 THEN 'NON_CONFORMANT' WHEN NOT probed THEN 'NOT_EVALUATED' ELSE 'CONFORMANT' END AS status,
  CASE WHEN there THEN m ELSE 0 END AS missing_columns, CASE WHEN there THEN x ELSE 0 END AS lossy_casts,
  CASE WHEN there THEN coalesce(findings, '') ELSE 'TABLE_ABSENT: no such table' END AS findings FROM a""")
def dq19(t: Tables):
    return quality.conformance(*inventories(t), lossy_found(t))


# Conformance results of many runs: one run per order date, one contracted table per customer group.
S_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'CONFORMANT' WHEN 'O' THEN 'NON_CONFORMANT' ELSE 'NOT_EVALUATED' END"
S_RESULTS = f"""SELECT concat('run', year(o_orderdate)) AS job_run_id, o_orderdate + o_orderkey * INTERVAL 1 second AS recorded_at, o_orderpriority AS target,
 concat('t', o_custkey % 20) AS contract_table, {S_STATUS} AS status, o_custkey % 3 AS missing_columns, o_custkey % 2 AS lossy_casts, o_orderkey FROM orders"""


def conformance_results(t: Tables):
    return t.orders.select(
        F.concat(F.lit("run"), F.year("o_orderdate")).alias("job_run_id"),
        F.expr("o_orderdate + make_interval(0, 0, 0, 0, 0, 0, o_orderkey)").alias("recorded_at"),
        F.col("o_orderpriority").alias("target"), F.concat(F.lit("t"), F.col("o_custkey") % 20).alias("contract_table"),
        F.expr(S_STATUS).alias("status"), (F.col("o_custkey") % 3).alias("missing_columns"), (F.col("o_custkey") % 2).alias("lossy_casts"),
        F.when(F.expr("o_orderstatus = 'F'"), F.array().cast("array<string>")).otherwise(
            F.array(F.concat(F.lit("A: "), "o_orderkey"), F.concat(F.lit("B: "), "o_custkey"))).alias("findings"))


S_LATEST = f"SELECT * FROM ({S_RESULTS}) QUALIFY row_number() OVER (PARTITION BY target, contract_table ORDER BY recorded_at DESC) = 1"


@query("dq20", f"""
SELECT count(*) AS tables_measured, cast(sum(CASE WHEN status = 'CONFORMANT' THEN 1 ELSE 0 END) as bigint) AS tables_conformant,
       cast(sum(CASE WHEN status <> 'CONFORMANT' THEN 1 ELSE 0 END) as bigint) AS tables_not_conformant, count(DISTINCT target) AS targets_under_contract FROM ({S_LATEST})""")
def dq20(t: Tables):
    return reports.conformance_headline(conformance_results(t))


@query("dq20_by_table", f"SELECT target, contract_table, status, missing_columns, lossy_casts, cast(recorded_at as varchar) AS recorded_at FROM ({S_LATEST})")
def dq20_by_table(t: Tables):
    return reports.conformance_by_table(conformance_results(t))


@query("dq20_findings", f"""
SELECT target, contract_table, unnest(['A: ' || o_orderkey, 'B: ' || c]) AS finding FROM (SELECT l.*, o_custkey AS c FROM ({S_LATEST}) l JOIN orders USING (o_orderkey)) WHERE status <> 'CONFORMANT'""")
def dq20_findings(t: Tables):
    return reports.conformance_findings(conformance_results(t))


@query("dq20_trend", f"""
SELECT job_run_id, target, cast(min(recorded_at) as varchar) AS recorded_at, count(*) AS denominator,
       cast(sum(CASE WHEN status = 'CONFORMANT' THEN 1 ELSE 0 END) as bigint) AS conformant,
       cast(round(cast(100 * sum(CASE WHEN status = 'CONFORMANT' THEN 1 ELSE 0 END) as decimal(18,8)) / count(*), 1) as double) AS conformant_rate
FROM ({S_RESULTS}) GROUP BY 1, 2""")
def dq20_trend(t: Tables):
    return reports.conformance_trend(conformance_results(t))


@query("dq20_runs", f"""
SELECT count(DISTINCT job_run_id) AS runs_recorded, count(*) AS rows_recorded, cast(max(recorded_at) as varchar) AS last_recorded_at FROM ({S_RESULTS})""")
def dq20_runs(t: Tables):
    return reports.runs_recorded(conformance_results(t))


MASKS = {"c_name": "personal_name", "c_acctbal": "money", "c_mktsegment": "tax_reference"}


@query("dq21", """
SELECT c_custkey, substr(c_name, 1, 1) || '***' AS c_name, c_nationkey, cast(NULL as double) AS c_acctbal, cast(NULL as varchar) AS c_mktsegment FROM customer""")
def dq21(t: Tables):
    return mask(t.customer, MASKS)


@query("dq21_privileged", "SELECT * FROM customer")
def dq21_privileged(t: Tables):
    return mask(t.customer, MASKS, privileged=True)


@query("dq22", """
WITH seen AS (SELECT c_name, c_acctbal, c_mktsegment, substr(c_name, 1, 1) || '***' AS m_name, cast(NULL as double) AS m_acctbal, c_mktsegment AS m_mktsegment FROM customer WHERE c_custkey % 10 > 0),
twice AS (SELECT count(*) AS unpaired FROM customer WHERE c_custkey % 10 = 0)
SELECT 'c_name' AS column_name, count(c_name) AS compared, count(*) FILTER (c_name = m_name) AS survived, any_value(unpaired) AS unpaired FROM seen, twice UNION ALL
SELECT 'c_acctbal', count(c_acctbal), count(*) FILTER (c_acctbal = m_acctbal), any_value(unpaired) FROM seen, twice UNION ALL
SELECT 'c_mktsegment', count(c_mktsegment), count(*) FILTER (c_mktsegment = m_mktsegment), any_value(unpaired) FROM seen, twice""")
def dq22(t: Tables):
    """One declared column was left out of the masks downstream, and its values survive; every tenth key came twice."""
    source = t.customer.unionByName(t.customer.where("c_custkey % 10 = 0").withColumn("c_acctbal", F.lit(0.0)))
    published = mask(source, {k: MASKS[k] for k in ("c_name", "c_acctbal")})
    return quality.surviving_clear_values(source, published, ["c_custkey"], list(MASKS))


@query("dq23", """
WITH seen AS (SELECT c_custkey, cast(NULL as double) AS c_acctbal FROM customer), n AS (
  SELECT count(*) AS rows, 'c_acctbal' AS column_name, count(c_acctbal) AS readable FROM seen UNION ALL SELECT count(*), 'c_custkey', count(c_custkey) FROM seen)
SELECT *, CASE WHEN rows = 0 THEN 'NOT_EVALUATED' WHEN readable = 0 THEN 'ALL_NULL' ELSE 'READABLE' END AS status FROM n""")
def dq23(t: Tables):
    return quality.null_amounts(mask(t.customer, MASKS), ["c_acctbal", "c_custkey"])
