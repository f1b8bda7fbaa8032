"""Datasets over the control and audit tables: coverage, conformance, volume, runs, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.ordered import first_per_key

NOT_EVALUATED = "not evaluated"


def _rules_per_table(model: DataFrame, rules: DataFrame) -> DataFrame:
    tables = model.select(F.explode("generated_tables").alias("table_name"))
    live = (rules.where("is_current").groupBy(F.col("dataset").alias("table_name"))
            .agg(F.count("rule_name").alias("rules_declared")))
    return tables.join(live, "table_name", "left").na.fill(0, ["rules_declared"])


def coverage_headline(model: DataFrame, rules: DataFrame) -> DataFrame:
    with_rule = F.when(F.col("rules_declared") > 0, 1).otherwise(0)
    return _rules_per_table(model, rules).agg(
        F.count(F.lit(1)).alias("tables_total"), F.sum(with_rule).alias("tables_with_a_rule"),
        F.sum(1 - with_rule).alias("tables_with_no_rule"))


def coverage_by_table(model: DataFrame, rules: DataFrame) -> DataFrame:
    return _rules_per_table(model, rules).withColumn(
        "coverage_state", F.when(F.col("rules_declared") == 0, "no rule").otherwise("rule declared")
    ).orderBy("rules_declared", "table_name")


def latest_conformance(results: DataFrame) -> DataFrame:
    """Latest row per (target, table); a global maximum would hide every other target."""
    return first_per_key(results, ["target", "contract_table"], F.desc("recorded_at"))


def _conformant() -> Column:
    return F.when(F.col("status") == "CONFORMANT", 1).otherwise(0)


def conformance_headline(results: DataFrame) -> DataFrame:
    return latest_conformance(results).agg(
        F.count(F.lit(1)).alias("tables_measured"), F.sum(_conformant()).alias("tables_conformant"),
        F.sum(1 - _conformant()).alias("tables_not_conformant"),
        F.countDistinct("target").alias("targets_under_contract"))


def problems_first(df: DataFrame, ok: Column, *then: str) -> DataFrame:
    return df.orderBy(F.when(ok, 1).otherwise(0), *then)


def conformance_by_table(results: DataFrame) -> DataFrame:
    latest = latest_conformance(results).select(
        "target", "contract_table", "status", "missing_columns", "lossy_casts", "recorded_at")
    return problems_first(latest, F.col("status") == "CONFORMANT", "contract_table")


def conformance_findings(results: DataFrame) -> DataFrame:
    return latest_conformance(results).select(
        "target", "contract_table", F.explode("findings").alias("finding")).orderBy("contract_table", "finding")


def conformance_trend(results: DataFrame) -> DataFrame:
    out = results.groupBy("job_run_id", "target").agg(
        F.min("recorded_at").alias("recorded_at"), F.count(F.lit(1)).alias("denominator"),
        F.sum(_conformant()).alias("conformant"))
    rate = F.when(F.col("denominator") > 0, F.round(100.0 * F.col("conformant") / F.col("denominator"), 1))
    return out.withColumn("conformant_rate", rate).orderBy(F.desc("recorded_at"))


def runs_recorded(audit: DataFrame) -> DataFrame:
    return audit.agg(F.countDistinct("job_run_id").alias("runs_recorded"),
                     F.count(F.lit(1)).alias("rows_recorded"), F.max("recorded_at").alias("last_recorded_at"))


def load_volume(loads: DataFrame, difference: str = "not_accepted") -> DataFrame:
    return loads.select("job_run_id", "table_name", "written_by", "staged", "accepted",
                        (F.col("staged") - F.col("accepted")).alias(difference), "recorded_at"
                        ).orderBy(F.desc("recorded_at"))


def discards_by_reason(discards: DataFrame) -> DataFrame:
    return discards.groupBy("table_name", "discard_reason").agg(
        F.sum("discarded").alias("discarded"), F.countDistinct("job_run_id").alias("runs")
    ).orderBy(F.desc("discarded"))


def acceptance_rate(loads: DataFrame, rate: str = "accept_rate") -> DataFrame:
    out = loads.groupBy("table_name").agg(F.sum("staged").alias("denominator"), F.sum("accepted").alias("accepted"))
    none = F.col("denominator") == 0
    return out.withColumns({
        rate: F.when(~none, F.col("accepted") / F.col("denominator")),
        "state": F.when(none, NOT_EVALUATED).otherwise("evaluated")}).orderBy("table_name")


def incomplete_runs(runs: DataFrame) -> DataFrame:
    """Runs that opened and never completed."""
    return runs.groupBy("job_run_id", "target").agg(
        F.max(F.when(F.col("phase") == "opened", F.col("recorded_at"))).alias("opened_at"),
        F.sum(F.when(F.col("phase") == "completed", 1).otherwise(0)).alias("_done")
    ).where("_done = 0").drop("_done").orderBy(F.desc("opened_at"))


def newest_first(control: DataFrame, *cols: str, by: str) -> DataFrame:
    return control.select(*cols).orderBy(F.desc(by))


def unbalanced_audit(loads: DataFrame, discards: DataFrame) -> DataFrame:
    """Per run, tables whose discards do not add up to staged less accepted."""
    lost = discards.groupBy("job_run_id", "table_name").agg(F.sum("discarded").alias("discarded"))
    sums = loads.groupBy("job_run_id", "table_name").agg(
        F.sum("staged").alias("staged"), F.sum("accepted").alias("accepted"))
    out = sums.join(lost, ["job_run_id", "table_name"], "left").na.fill(0, ["discarded"])
    return out.where("staged - accepted <> discarded")


def unclosed_runs(loads: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs with load rows that lack one of their two phases."""
    phases = runs.groupBy("job_run_id").agg(F.collect_set("phase").alias("phases"))
    out = loads.select("job_run_id").distinct().join(phases, "job_run_id", "left")
    missing = F.array_sort(F.array_except(F.array(F.lit("opened"), F.lit("completed")),
                                          F.coalesce("phases", F.array().cast("array<string>"))))
    return out.select("job_run_id", missing.alias("missing_phases")).where("size(missing_phases) > 0")


def freshness(audit: DataFrame, sla: DataFrame, now: str) -> DataFrame:
    """STALE, FRESH, EXEMPT (SLA of 0) or NOT_EVALUATED (no SLA declared, or never loaded) per table.

    ``sla`` is (table_name, sla_hours); ``now`` is a parameter, so a report can be repeated.
    """
    last = audit.groupBy("table_name").agg(F.max("recorded_at").alias("last_loaded"))
    out = sla.join(last, "table_name", "left")
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("last_loaded").cast("timestamp"))
    status = (F.when(F.col("sla_hours") == 0, "EXEMPT").when(F.col("sla_hours").isNull() | F.col("last_loaded").isNull(), "NOT_EVALUATED")
              .when(age > F.col("sla_hours") * 3600, "STALE").otherwise("FRESH"))
    return out.withColumns({"age_seconds": age, "status": status})

