"""The declared model over the test tables, and staged frames several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.model import Binding, Entity, Model, Parent
from lodestrata.operators.load import load_satellite
from lodestrata.operators.staging import project, stage
from lodestrata.plans.registry import Tables, s_diff, s_key

LOAD = "2026-01-01 00:00:00"
MONEY = "decimal(18,2)"
LINE_PAYLOAD = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
LINE_MONEY = {c: MONEY for c in LINE_PAYLOAD[:4]}
TIER = "CASE WHEN value >= 50 THEN 'high' ELSE 'low' END"

OPERATION = "CASE event_type WHEN 'error' THEN 'd' WHEN 'click' THEN 'u' END"

MODEL = Model(
    Entity("hub_order", "hub", ("order_key",), "SALES", bindings=(
        Binding("orders", "SALES", {"order_key": "o_orderkey"}, applied="o_orderdate",
                manifest="o_orderpriority"),)),
    Entity("hub_customer", "hub", ("customer_code",), "CRM", bindings=(
        Binding("customer", "CRM", {"customer_code": "c_custkey"}),
        Binding("orders", "SALES", {"customer_code": "o_custkey"}, key_scope="CRM"),
        Binding("customer", "OLDCRM", {"customer_code": "c_name"}, key_scope="OLDCRM", active=False))),
    Entity("hub_part", "hub", ("part_code",), bindings=(
        Binding("part", "PIM", {"part_code": "p_partkey"}),)),
    Entity("hub_supplier", "hub", ("system", "supplier_code"), bindings=(
        Binding("supplier", "SRM", {"supplier_code": "s_suppkey"}, literals={"system": "srm"}),)),
    Entity("hub_account", "hub", ("tenant", "account"), "FIN", tenant_keys=("tenant",), bindings=(
        Binding("customer", "FIN", {"tenant": "c_mktsegment", "account": "c_custkey"}),)),
    Entity("hub_user", "hub", ("user_id",), "WEB", bindings=(
        Binding("events", "WEB", {"user_id": "user_id"}),)),
    Entity("link_order_customer", "link", scope="SALES",
           parents=(Parent("hub_order"), Parent("hub_customer")), bindings=(
               Binding("orders", "SALES", parent_keys={"hub_order": ("o_orderkey",), "hub_customer": ("o_custkey",)},
                       applied="o_orderdate", manifest="o_orderpriority"),)),
    Entity("nhl_order_line", "nhl", scope="SALES",
           parents=(Parent("hub_order"), Parent("hub_part"), Parent("hub_supplier")), bindings=(
               Binding("lineitem", "SALES",
                       parent_keys={"hub_order": ("l_orderkey",), "hub_part": ("l_partkey",), "hub_supplier": ("l_suppkey",)},
                       txn_keys=("l_linenumber", "l_shipdate"), payload=LINE_PAYLOAD, casts=LINE_MONEY, applied="l_shipdate",
                       manifest="l_returnflag"),)),
    Entity("hal_customer_group", "hal", scope="CRM",
           parents=(Parent("hub_customer", "parent"), Parent("hub_customer", "child")), bindings=(
               Binding("customer", "CRM", parent_keys={"parent_hub_customer": ("group_code",), "child_hub_customer": ("c_custkey",)},
                       derived={"group_code": "c_custkey DIV 10"}),)),
    Entity("sat_order", "sat", parents=(Parent("hub_order"),), bindings=(
        Binding("orders", "SALES", parent_keys={"hub_order": ("o_orderkey",)},
                payload=("o_orderstatus", "o_totalprice", "o_orderpriority"), casts={"o_totalprice": MONEY},
                applied="o_orderdate"),)),
    Entity("sat_user", "sat", parents=(Parent("hub_user"),), bindings=(
        Binding("events", "WEB", parent_keys={"hub_user": ("user_id",)},
                derived={"tier": TIER, "operation": OPERATION}, payload=("event_type", "tier"), applied="ts",
                cdc="operation"),)),
    Entity("msat_user_activity", "msat", parents=(Parent("hub_user"),), bindings=(
        Binding("events", "WEB", parent_keys={"hub_user": ("user_id",)}, derived={"tier": TIER},
                payload=("tier",), mas_keys=("event_type",), applied="ts"),)),
    Entity("sat_line", "sat", parents=(Parent("hub_order"),), bindings=(
        Binding("lineitem", "SALES", parent_keys={"hub_order": ("l_orderkey",)}, payload=LINE_PAYLOAD,
                casts=LINE_MONEY, applied="l_shipdate"),)),
)


def staged(t: Tables, name: str, rec_src: str | None = None, load_dts=LOAD) -> DataFrame:
    entity = MODEL[name]
    binding = next(b for b in entity.bindings if rec_src in (None, b.rec_src))
    return stage(getattr(t, binding.feed), MODEL, entity, binding, load_dts=load_dts, batch_id="b1")


def log_of(t: Tables, name: str, rec_src: str | None = None, load_dts=LOAD, extra=()) -> DataFrame:
    entity = MODEL[name]
    binding = next(b for b in entity.bindings if rec_src in (None, b.rec_src))
    return project(staged(t, name, rec_src, load_dts), entity, binding, extra)


def user_log(t: Tables) -> DataFrame:
    """Satellite log of users: one load per day, the event's clock as the source's."""
    return log_of(t, "sat_user", load_dts=F.date_trunc("day", "ts"))


def activity_log(t: Tables) -> DataFrame:
    return log_of(t, "msat_user_activity", load_dts=F.date_trunc("day", "ts"))


# A day in the middle of the events, up to which the satellites are loaded already.
HALF = "2024-01-15 00:00:00"


def before_half(log: DataFrame) -> DataFrame:
    return log.where(F.col("load_dts") < F.lit(HALF).cast("timestamp"))


def stored_users(t: Tables) -> DataFrame:
    return load_satellite(before_half(user_log(t)), None, "hub_user_hk")


def line_log(t: Tables) -> DataFrame:
    """Lines of an order as a log: load by year, so that orders have several versions."""
    return log_of(t, "sat_line", load_dts=F.date_trunc("year", "l_shipdate"))


# The same in SQL.

S_ORDER = s_key(["o_orderkey"], "SALES")
S_LINE_ORDER = s_key(["l_orderkey"], "SALES")
S_CUSTOMER = s_key(["o_custkey"], "CRM")
S_USER = s_key(["user_id"], "WEB")
S_LINE_SUPPLIER = s_key(["'srm'", "l_suppkey"])
S_LINE = s_key(["l_orderkey", "l_partkey", "'srm'", "l_suppkey", "l_linenumber", "l_shipdate"], "SALES")
S_LINK = s_key(["o_orderkey", "o_custkey"], "SALES")
S_TIER = f"({TIER})"
S_LINE_MONEY = [f"cast({c} as decimal(18,2))" if c in LINE_MONEY else c for c in LINE_PAYLOAD]

S_USER_LOG = f"""ulog AS (
  SELECT {S_USER} AS hk, {s_diff(['event_type', S_TIER])} AS hd, event_type, {S_TIER} AS tier,
         cast(date_trunc('day', ts) as timestamp) AS load_dts, ts AS applied_dts
  FROM events)"""
S_ACTIVITY_LOG = f"""alog AS (
  SELECT {S_USER} AS hk, upper(event_type) AS mas_key, {s_diff([S_TIER])} AS hd, {S_TIER} AS tier,
         cast(date_trunc('day', ts) as timestamp) AS load_dts, ts AS applied_dts
  FROM events)"""


def s_load(log: str, key: str, out: str, where: str = "TRUE", target: str | None = None) -> str:
    """CTEs that load a satellite: ``out`` holds the inserted rows."""
    on = " AND ".join(f"x.{k} IS NOT DISTINCT FROM s.{k}" for k in key.split(", "))
    seed = ""
    cond = "s.hd IS DISTINCT FROM s.prev"
    if target:
        seed = f"LEFT JOIN (SELECT {key}, hd FROM {target} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY load_dts DESC, sub_seq DESC) = 1) x ON {on}"
        cond = ("s.hd IS DISTINCT FROM coalesce(s.prev, x.hd) AND NOT EXISTS (SELECT 1 FROM " + target + " x WHERE "
                + on + " AND x.load_dts = s.load_dts AND x.sub_seq = s.sub_seq)")
    return f"""{out}_s AS (
  SELECT *, cast(row_number() OVER (PARTITION BY {key}, load_dts ORDER BY applied_dts, hd) - 1 AS int) AS sub_seq,
         lag(hd) OVER (PARTITION BY {key} ORDER BY load_dts, applied_dts, hd) AS prev
  FROM {log} WHERE {where}),
{out} AS (SELECT s.* FROM {out}_s s {seed} WHERE {cond})"""
