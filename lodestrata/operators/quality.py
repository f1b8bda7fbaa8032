"""Rules, quarantine, field validation, conformance and mask survival."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import validity
from lodestrata.functions.rules import bare

Rules = Sequence[tuple[str, Column]]

PASS, FAIL, NOT_EVALUATED = "PASS", "FAIL", "NOT_EVALUATED"
FAILURE_DETAIL = "expectation violated"
LOCAL_RULES = {
    "ISNUMERIC": validity.numeric,
    "DATEFORMATCHECK": validity.iso_date,
    "MISSINGVALUE": validity.present,
    "CHECKBOOLEAN": validity.boolean,
}


def configured_rules(rules: DataFrame, dataset: str) -> list[tuple[str, Column]]:
    """Current ``drop`` rules of one dataset from the rules table, in name order.

    The rules of one dataset are configuration written by people and are read while the
    plan is built, because a predicate must be known before it can be pushed down.
    """
    rows = (rules.where((F.col("dataset") == dataset) & F.col("is_current")
                        & (F.col("severity") == "drop"))
            .select("rule_name", "rule_sql").orderBy("rule_name").collect())
    return [(r["rule_name"], F.expr(r["rule_sql"])) for r in rows]


def merge_rules(mandatory: Rules, configured: Rules) -> list[tuple[str, Column]]:
    """Mandatory rules first; a configured rule of the same name takes its place."""
    return list({**dict(mandatory), **dict(configured)}.items())


def violation(rules: Rules) -> tuple[Column, Column]:
    """(failed, reason): FALSE and NULL both fail; the reason is the first failing rule."""
    bad = [(name, ~F.coalesce(rule, F.lit(False))) for name, rule in rules]
    failed = reduce(lambda a, b: a | b, [b for _, b in bad], F.lit(False))
    return failed, F.coalesce(F.lit(None).cast("string"), *[F.when(b, F.lit(n)) for n, b in bad])


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) as exact complements of one predicate on the full row."""
    failed, reason = violation(rules)
    return df.where(~failed), df.where(failed).withColumns(
        {"failure_rule": reason, "failure_detail": F.lit(FAILURE_DETAIL)})


def quarantine(df: DataFrame, rules: Rules, target_columns: Sequence[str]) -> DataFrame:
    """Rejected rows in the target's shape plus why they were rejected."""
    return split(df, rules)[1].select(*target_columns, "failure_rule", "failure_detail")


def reject_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("failure_rule").agg(F.count(F.lit(1)).alias("rejected"))


def blank_columns(cols: Sequence[str]) -> Column:
    """Names of the required columns a row leaves blank."""
    return F.array_compact(F.array(*[F.when(validity.blank(c), F.lit(c)) for c in cols]))


def required_fields(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = blank_columns(cols)
    return df.withColumn("missing_fields", missing).withColumn(
        "route", F.when(F.size("missing_fields") > 0, "exception").otherwise("release"))


def validate_fields(df: DataFrame, field_rules: Mapping[str, Sequence[str]], refs: DataFrame,
                    reference_types: Mapping[str, str | None]) -> DataFrame:
    """One row per rule: status, how many fields carry it, values checked, violations, references.

    ``refs`` is (type, value); ``reference_types`` gives the type each membership rule tests
    against. Values are counted per distinct value first, so the membership join sees each
    value once however often it occurs.
    """
    spark = df.sparkSession
    rules = sorted(set(LOCAL_RULES) | set(reference_types) | set(field_rules))
    local = [(r, f) for r in rules if r in LOCAL_RULES for f in field_rules.get(r, ())]
    member = [(r, f) for r in rules if r in reference_types and reference_types[r]
              for f in field_rules.get(r, ())]
    other = [r for r in rules if r not in LOCAL_RULES and r not in reference_types]

    aggregates = []
    for r, f in local:
        aggregates.append(F.struct(
            F.lit(r).alias("rule"), F.count(F.lit(1)).alias("checks"),
            F.sum(F.when(LOCAL_RULES[r](f), 0).otherwise(1)).alias("problems")))
    for r in other:
        aggregates.append(F.struct(F.lit(r).alias("rule"), F.count(F.lit(1)).alias("checks"),
                                   F.count(F.lit(1)).alias("problems")))
    parts = []
    if aggregates:
        parts.append(df.agg(F.array(*aggregates).alias("a")).select(F.inline("a")))
    known = (refs.select(F.col("type").alias("_type"), bare("value").alias("_value"))
             .where("_value <> ''").distinct())
    if member:
        cells = df.select(F.explode(F.array(*[
            F.struct(F.lit(r).alias("rule"), F.lit(reference_types[r]).alias("type"),
                     bare(f).alias("value")) for r, f in member])).alias("c")).select("c.*")
        values = (cells.where("value <> ''").groupBy("rule", "type", "value")
                  .agg(F.count(F.lit(1)).alias("n")))
        parts.append(
            values.join(known, (F.col("type") == F.col("_type")) & (F.col("value") == F.col("_value")), "left")
            .groupBy("rule").agg(F.sum("n").alias("checks"),
                                 F.sum(F.when(F.col("_type").isNull(), F.col("n")).otherwise(0)).alias("problems")))
    sized = known.groupBy("_type").agg(F.count(F.lit(1)).alias("references_used"))
    declared = spark.createDataFrame(
        [(r, len(set(field_rules.get(r, ()))), reference_types.get(r), r in LOCAL_RULES, r in reference_types)
         for r in rules], "rule string, fields int, ref_type string, is_local boolean, is_member boolean")
    out = declared
    if parts:
        found = reduce(DataFrame.unionByName, parts).groupBy("rule").agg(
            F.sum("checks").alias("checks"), F.sum("problems").alias("problems"))
        out = out.join(found, "rule", "left")
    else:
        out = out.withColumns({"checks": F.lit(0), "problems": F.lit(0)})
    out = out.join(sized, out.ref_type == sized._type, "left")
    has_refs = F.coalesce("references_used", F.lit(0)) > 0
    # A membership rule with nothing to compare against has compared nothing.
    dead = F.col("is_member") & ~has_refs
    checks = F.when(dead, 0).otherwise(F.coalesce("checks", F.lit(0)))
    problems = F.when(dead, 0).otherwise(F.coalesce("problems", F.lit(0)))
    status = (F.when(problems > 0, FAIL).when(~F.col("is_local") & ~F.col("is_member"), FAIL)
              .when(dead, NOT_EVALUATED).when(checks <= 0, NOT_EVALUATED).otherwise(PASS))
    return out.select("rule", status.alias("status"), "fields", checks.cast("long").alias("checks"),
                      problems.cast("long").alias("problems"),
                      F.coalesce("references_used", F.lit(0)).cast("long").alias("references_used"))


def membership(df: DataFrame, refs: DataFrame, type_col: str, value_col: str) -> DataFrame:
    """Per type: values checked, values unknown, and a status that is never a pass on no reference."""
    cells = (df.select(F.col(type_col).alias("type"), bare(value_col).alias("value"))
             .groupBy("type", "value").agg(F.count(F.lit(1)).alias("n")))
    known = refs.select(F.col("type").alias("_type"), bare("value").alias("_value")).where(
        "_value <> ''").distinct()
    sized = known.groupBy("_type").agg(F.count(F.lit(1)).alias("reference_values"))
    hit = known.withColumnRenamed("_type", "_t")
    tested = cells.join(hit, (cells.type == hit._t) & (cells.value == hit._value), "left")
    found = tested.groupBy("type").agg(
        F.sum(F.when(F.col("value") != "", F.col("n")).otherwise(0)).alias("compared"),
        F.sum(F.when((F.col("value") != "") & F.col("_t").isNull(), F.col("n")).otherwise(0)).alias("unknown"))
    out = found.join(sized, found.type == sized._type, "left")
    refs_n = F.coalesce("reference_values", F.lit(0))
    return out.select(
        "type", refs_n.cast("long").alias("reference_values"),
        F.when(refs_n > 0, F.col("compared")).otherwise(0).cast("long").alias("checks"),
        F.when(refs_n > 0, F.col("unknown")).otherwise(0).cast("long").alias("violations"),
        F.when((refs_n == 0) | (F.col("compared") == 0), NOT_EVALUATED)
        .when(F.col("unknown") > 0, FAIL).otherwise(PASS).alias("status"))


def lossy_casts(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per column: values that are there today and that the cast would destroy."""
    probes = [F.struct(
        F.lit(c).alias("column_name"), F.lit(t).alias("declared_type"), F.count(c).alias("present"),
        F.coalesce(F.sum(F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull(), 1)),
                   F.lit(0)).alias("lost")) for c, t in types.items()]
    return df.agg(F.array(*probes).alias("p")).select(F.inline("p"))


def inventory(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of each frame: (table_name, column_name, ordinal, data_type). Reads no rows."""
    return spark.createDataFrame(
        [(t, f.name, i, f.dataType.simpleString()) for t, df in frames.items()
         for i, f in enumerate(df.schema)],
        "table_name string, column_name string, ordinal int, data_type string")


def missing_columns(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required columns a present table lacks; extra columns are no finding."""
    have = present.select("table_name", F.lower("column_name").alias("_c")).distinct()
    return required.join(
        have, (required.table_name == have.table_name) & (F.lower(required.column_name) == have._c), "left_anti")


def conformance(required: DataFrame, present: DataFrame, lossy: DataFrame | None) -> DataFrame:
    """Verdict per contracted table: ABSENT, NON_CONFORMANT, NOT_EVALUATED or CONFORMANT.

    ``lossy`` is (table_name, column_name, lost) for the columns whose casts were probed, with no count where the probe
    had no result; a table conforms only if all its required columns have one. The counts are read from the findings, so the two cannot disagree.
    """
    tables = required.select("table_name").distinct()
    existing = present.select("table_name").distinct().withColumn("_exists", F.lit(True))
    gaps = missing_columns(required, present).select(
        "table_name", F.concat(F.lit("MISSING_COLUMN: "), "column_name").alias("finding"))
    findings = gaps
    if lossy is not None:
        findings = findings.unionByName(lossy.where("lost > 0").select(
            "table_name", F.concat(F.lit("LOSSY_CAST: "), "column_name", F.lit(" loses "),
                                   F.col("lost").cast("string")).alias("finding")))
        measured = lossy.where(F.col("lost").isNotNull()).select("table_name", F.lower("column_name").alias("_c")).distinct()
        asked = required.select("table_name", F.lower("column_name").alias("_c")).distinct()
        unmeasured = asked.join(measured, ["table_name", "_c"], "left_anti").select("table_name").distinct()
        probed = tables.join(unmeasured, "table_name", "left_anti").withColumn("_probed", F.lit(True))
    listed = findings.groupBy("table_name").agg(F.array_sort(F.collect_list("finding")).alias("findings"))
    out = tables.join(existing, "table_name", "left").join(listed, "table_name", "left")
    out = out.join(probed, "table_name", "left") if lossy is not None else out.withColumn(
        "_probed", F.lit(None).cast("boolean"))
    absent = F.col("_exists").isNull()
    found = F.when(absent, F.array(F.lit("TABLE_ABSENT: no such table"))).otherwise(
        F.coalesce("findings", F.array().cast("array<string>")))
    counted = out.select("table_name", "_exists", "_probed", found.alias("findings"))

    def having(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x.startswith(kind)))

    status = (F.when(F.col("_exists").isNull(), "ABSENT").when(F.size("findings") > 0, "NON_CONFORMANT")
              .when(F.col("_probed").isNull(), "NOT_EVALUATED").otherwise("CONFORMANT"))
    return counted.select("table_name", status.alias("status"),
                          having("MISSING_COLUMN").cast("long").alias("missing_columns"),
                          having("LOSSY_CAST").cast("long").alias("lossy_casts"), "findings")


def surviving_clear_values(source: DataFrame, output: DataFrame, keys: Sequence[str],
                           columns: Sequence[str]) -> DataFrame:
    """Per declared-sensitive column: values that read the same after the mask as before it.

    Only rows whose key is unique on both sides are pairs; ``unpaired`` counts the keys that repeat on one of them,
    where no value can be told to be its own row's.
    """
    def once(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}n"), *[F.any_value(c).alias(prefix + c) for c in columns])
    joined = once(source, "_clear_").join(once(output, "_masked_"), list(keys))
    pair = F.col("_clear_n") + F.col("_masked_n") == 2
    return joined.agg(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.count(F.when(pair, F.col("_clear_" + c))).alias("compared"),
        F.count_if(pair & (F.col("_clear_" + c) == F.col("_masked_" + c))).alias("survived"), F.count_if(~pair).alias("unpaired"))
        for c in columns]).alias("s")).select(F.inline("s"))


def null_amounts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Guard before a balance check: a masked reader sees only NULL amounts and must not pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.count(c).alias("readable")) for c in columns
    ]).alias("a")).select("rows", F.inline("a")).withColumn(
        "status", F.when(F.col("rows") == 0, NOT_EVALUATED).when(F.col("readable") == 0, "ALL_NULL")
        .otherwise("READABLE"))


def any_mismatch(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per rule: rows compared and rows in which its two forms differ, in one scan."""
    return df.agg(F.array(*[F.struct(
        F.lit(n).alias("rule"), F.count(F.lit(1)).alias("compared"), F.count_if(~got.eqNullSafe(want)).alias("different"))
        for n, (got, want) in pairs.items()]).alias("a")).select(F.inline("a"))
