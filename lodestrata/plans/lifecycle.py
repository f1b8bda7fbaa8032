"""A whole vault: staged, loaded twice, audited and read back."""

from lodestrata.operators import load

from lodestrata.plans.registry import Tables, query
from lodestrata.plans.warehouse import LOAD, MODEL, S_USER_LOG, s_load
from lodestrata.sources import sinks
from lodestrata.vault import Vault

SOURCES = ["hub_order", "hub_customer", "hub_user", "link_order_customer", "sat_order", "sat_user"]


def loaded(t: Tables, runs: int = 2) -> Vault:
    """Orders, customers and events staged once and loaded by two runs; the second finds nothing new."""
    vault = Vault(t.spark, sinks.run_folder(t.spark, "vault"), MODEL)
    wanted = [f"{name}/{b.rec_src}" for name in SOURCES for b in MODEL[name].bindings if b.active]
    feeds = {n: getattr(t, n) for n in ("orders", "customer", "events")}
    vault.stage(feeds, LOAD, "b1", wanted)
    for n in range(runs):
        problems = vault.load(f"run{n + 1}", f"2026-01-0{n + 1} 00:00:00", wanted)
        if problems:
            raise RuntimeError(problems)
    return vault


S_KEPT = S_USER_LOG.replace("date_trunc('day', ts)", f"timestamp '{LOAD}'").replace("FROM events", "FROM events WHERE event_type <> 'error'")


@query("vault_load", f"""
WITH {S_KEPT}, {s_load('ulog', 'hk', 'added')}, n AS (
  SELECT 'hub_order' AS table_name, (SELECT count(*) FROM orders) AS staged, (SELECT count(*) FROM orders) AS accepted UNION ALL
  SELECT 'hub_customer', (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer), (SELECT count(DISTINCT c_custkey) FROM customer) UNION ALL
  SELECT 'hub_user', (SELECT count(*) FROM events), (SELECT count(DISTINCT user_id) FROM events) UNION ALL
  SELECT 'link_order_customer', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders) UNION ALL
  SELECT 'sat_order_sales', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders) UNION ALL
  SELECT 'sat_user_web', (SELECT count(*) FROM ulog), (SELECT count(*) FROM added))
SELECT 'run1' AS job_run_id, table_name, staged, accepted, staged - accepted AS discarded, TRUE AS balanced FROM n UNION ALL
SELECT 'run2', table_name, staged, 0, staged, TRUE FROM n""")
def vault_load(t: Tables):
    """Every load of both runs with its arithmetic."""
    vault = loaded(t)
    return load.load_arithmetic(t.spark.read.parquet(vault.path("audit", "aud_table_load")),
                                t.spark.read.parquet(vault.path("audit", "aud_table_discard"))).select(
        "job_run_id", "table_name", "staged", "accepted", "discarded", "balanced")


@query("vault_history", f"""
WITH {S_KEPT}, {s_load('ulog', 'hk', 'added')} SELECT hk AS hub_user_hk, event_type, tier, cast(applied_dts as varchar) AS valid_from,
  cast(lead(applied_dts) OVER w as varchar) AS valid_to, lead(hk) OVER w IS NULL AS is_current FROM added WINDOW w AS (PARTITION BY hk ORDER BY applied_dts, load_dts, sub_seq)""")
def vault_history(t: Tables):
    """The type-2 view of a loaded satellite, without its ghost."""
    vault = loaded(t, runs=1)
    vault.views(["sat_user/WEB"])
    return t.spark.table("sat_user_web_v1").where("rec_src <> 'SYSTEM'").select(
        "hub_user_hk", "event_type", "tier", "valid_from", "valid_to", "is_current")
