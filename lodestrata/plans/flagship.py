"""The minimum slice of a vault, end to end: order lines from feed to landing check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.operators import load, quality, reconcile
from lodestrata.operators.dedup import repeated_hashes
from lodestrata.operators.staging import declared_columns, mandatory_rules
from lodestrata.plans.registry import Tables, query
from lodestrata.plans.warehouse import MODEL, staged

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]


def loaded(log: DataFrame, hk: str) -> tuple[DataFrame, list[int] | None]:
    """A first load, and the hashes of keys that come again in its log: asked for once, also for the count of what landed."""
    again = repeated_hashes(log, hk)
    return load.load_keyed(log, None, hk, repeated=again), again


def order_lines_as_vault(t: Tables) -> DataFrame:
    """Per hub or link: keys expected, landed, quarantined, and the signed variance."""
    line, order = MODEL["nhl_order_line"], MODEL["hub_order"]
    rows = staged(t, "nhl_order_line")
    rules = quality.merge_rules(mandatory_rules(line, line.bindings[0], rows.schema), [("quantity_sane", F.expr("l_quantity <= 45"))])
    valid, rejected = quality.split(rows, rules)
    lines, line_again = loaded(valid.select(*declared_columns(line, line.bindings[0])), line.hk)
    orders, order_again = loaded(staged(t, "hub_order").select(*declared_columns(order, order.bindings[0])), order.hk)
    none = rejected.where("1 = 0")
    checks = [
        reconcile.landing_variance(t.lineitem, LINE, lines, line.hk, rejected, none,
                                   repeated_hashes(t.lineitem, LINE), line_again).select(F.lit(line.name).alias("entity"), "*"),
        reconcile.landing_variance(t.orders, ["o_orderkey"], orders, order.hk, none, none,
                                   None, order_again).select(F.lit(order.name).alias("entity"), "*")]
    return checks[0].unionByName(checks[1])


@query("flagship", """
SELECT 'nhl_order_line' AS entity, *, expected - (landed + quarantined - superseded) AS variance, 'PASSED' AS status FROM (
  SELECT count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate)) AS expected, count(DISTINCT CASE WHEN l_quantity <= 45 THEN (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) END) AS landed,
  count(*) FILTER (l_quantity > 45) AS quarantined, cast(0 as bigint) AS superseded FROM lineitem) UNION ALL
SELECT 'hub_order', n, n, 0, 0, 0, 'PASSED' FROM (SELECT count(DISTINCT o_orderkey) AS n FROM orders)""")
def flagship(t: Tables) -> DataFrame:
    return order_lines_as_vault(t)
