"""Type-2 history, current state, effectivity and computed satellites, all derived on read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.ordered import first_per_key, ordered_scan, same
from lodestrata.functions import rules

HISTORY_ORDER = ("applied_dts", "load_dts", "sub_seq")


def type2(sat: DataFrame, hk: str, mas_key: str | None = None, points="probe",
          probe_on: DataFrame | None = None) -> DataFrame:
    """``valid_from``, ``valid_to`` (half-open) and ``is_current`` by the source's clock.

    Current is the row nothing follows, which stays one row per key where a clock is missing.
    """
    keys = [hk] + ([mas_key] if mas_key else [])
    nexts = {"valid_to": F.col("applied_dts"), "_more": F.lit(True)}
    out = ordered_scan(sat, keys, HISTORY_ORDER, following=nexts, points=points, probe_on=probe_on)
    return out.withColumns({"valid_from": F.col("applied_dts"), "is_current": F.col("_more").isNull()}).drop("_more")


def current(sat: DataFrame, hk: str, mas_key: str | None = None) -> DataFrame:
    """Latest version per key in loading order."""
    return first_per_key(sat, [hk] + ([mas_key] if mas_key else []), F.desc("load_dts"), F.desc("sub_seq"))


def effectivity(edges: DataFrame, driving_key: Sequence[str], tie: Sequence[str] = (),
                points="probe", probe_on: DataFrame | None = None) -> DataFrame:
    """Intervals of a relationship in which each driving key has at most one open edge."""
    order = ["applied_dts", "load_dts", *tie]
    out = ordered_scan(edges, driving_key, order, points=points, probe_on=probe_on,
                       following={"effective_to": F.col("applied_dts"), "_more": F.lit(True)})
    return out.withColumns({"effective_from": F.col("applied_dts"), "is_open": F.col("_more").isNull()}).drop("_more")


def offered_values(hub: DataFrame, effect: DataFrame, hk: str, status: str = "reference_status") -> DataFrame:
    """Reference values whose latest statement is that they are offered."""
    latest = first_per_key(effect, [hk], F.desc("applied_dts"), F.desc("load_dts"))
    return hub.join(latest.where(F.col(status) == "OFFERED"), hk)


def unpivot_fields(df: DataFrame, ids: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """A wide feed as key-value rows: a new client adds rows, not columns."""
    return (df.select(*ids, *[F.col(c).cast("string") for c in fields])
            .unpivot(list(ids), list(fields), "field_name", "field_value").where("field_value IS NOT NULL"))


def promote_fields(kv: DataFrame, registry: Mapping[str, tuple[str, str]], hk: str,
                   order: Sequence[str] = ()) -> DataFrame:
    """Registered fields as typed columns: ``registry`` is field -> (column, type).

    Conditional aggregation, so the plan needs no pass to find the pivot values and copies
    of a key combine before the shuffle.
    """
    def pick(name: str, kind: str) -> Column:
        this = F.col("field_name") == name
        text = (F.max(F.when(this, F.struct(*order, "field_value")))["field_value"] if order
                else F.max(F.when(this, F.col("field_value"))))
        return text.try_cast(kind)

    out = kv.where(F.col("field_name").isin(*registry)).groupBy(hk).agg(
        *[pick(n, t).alias(c) for n, (c, t) in registry.items()])
    promoted = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c, _ in registry.values()), F.lit(0))
    return out.withColumn("promoted_fields", promoted)


def line_coding(lines: DataFrame, type_col: str, modules: Mapping[str, Sequence[str]],
                rule_version: str = "1.0.0") -> DataFrame:
    """Computed satellite payload of an invoice line: line type, and per attribute the value
    of the line's own module. ``modules`` is attribute -> (timesheet, expense, miscellaneous)."""
    picked = {a: rules.module_value(type_col, *map(F.col, cols)) for a, cols in modules.items()}
    if "task_number" in picked:
        picked["task_number"] = rules.task_number(picked["task_number"])
    return lines.withColumns({"line_type": rules.line_type(type_col), **picked,
                              "rule_version": F.lit(rule_version)})


def classify_payroll(lines: DataFrame, mapping: DataFrame, code: str, indicator: str, amount: str) -> DataFrame:
    """Computed satellite payload of a payroll line: class, liability party, employer and
    worker amounts, mapped account. An unmapped code surfaces instead of vanishing.

    ``mapping`` is (code, code_class, mapped_account); its size is Catalyst's to judge.
    """
    m = mapping.select(F.col("code").alias("_code"), "code_class", "mapped_account")
    out = lines.join(m, lines[code] == m._code, "left").drop("_code")
    employer = F.upper(rules.strip(indicator)) == "ER"
    return out.withColumns({
        "code_class": F.coalesce("code_class", F.lit("UNMAPPED")),
        "liability_party": F.when(employer, "EMPLOYER").otherwise("WORKER"),
        "employer_amount": F.when(employer, F.col(amount)),
        "worker_amount": F.when(~employer, F.col(amount))})


def newest_of(frames: Sequence[DataFrame], hk: str, tie: Sequence[str] = ()) -> DataFrame:
    """One row per key over several tables (open and closed years), the latest load."""
    from lodestrata.operators.load import union_feeds
    return first_per_key(union_feeds(frames), [hk], F.desc("load_dts"), *[F.desc(c) for c in tie])


def snapshot_spine(keys: DataFrame, hk: str, start: str, stop: str, days: int, at: str = "snapshot_dts") -> DataFrame:
    """Every key at every snapshot date."""
    dates = F.sequence(F.lit(start).cast("timestamp"), F.lit(stop).cast("timestamp"), F.expr(f"interval {days} days"))
    return keys.select(hk).distinct().select(hk, F.explode(dates).alias(at))


def point_in_time(spine: DataFrame, sats: Mapping[str, DataFrame], hk: str, at: str = "snapshot_dts",
                  points="probe", probe_on: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """For every (key, date) of the spine, the version of each satellite in force then.

    ``probe_on`` may name, per satellite, the log it was loaded from. Versions and dates are merged into one ordered pass per satellite, so the work grows
    with their sum and not with versions times dates.
    """
    asked_for = spine.select(hk, at).where(F.col(hk).isNotNull() & F.col(at).isNotNull()).distinct()
    out = asked_for
    for name, sat in sats.items():
        version = F.struct("applied_dts", "load_dts", "sub_seq")
        rows = sat.select(hk, F.col("applied_dts").alias("_at"), F.lit(0).alias("_asked"), version.alias("_v"))
        asked = asked_for.select(
            hk, F.col(at).alias("_at"), F.lit(1).alias("_asked"), F.lit(None).cast(rows.schema["_v"].dataType).alias("_v"))
        marks = rows.groupBy(hk, "_at", "_asked").agg(F.max("_v").alias("_v")).unionByName(asked)
        bound = (probe_on or sats)[name].select(hk).unionByName(spine.select(hk))
        swept = ordered_scan(marks, [hk], ["_at", "_asked"], maxima={"_last": F.col("_v")}, points=points, probe_on=bound)
        found = swept.where("_asked = 1").select(
            F.col(hk).alias("_hk"), F.col("_at").alias("_d"),
            F.col("_last.load_dts").alias(f"{name}_load_dts"), F.col("_last.sub_seq").alias(f"{name}_sub_seq"))
        out = out.join(found, (out[hk] == found["_hk"]) & (out[at] == found["_d"]), "left").drop("_hk", "_d")
    return out


def seeded_by_latest(rows: DataFrame, latest: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with the stored latest value of their key beside them; NULL where none is stored."""
    seed = latest.select(*[F.col(k).alias("_l_" + k) for k in keys], F.col(value).alias("latest_" + value))
    return rows.join(seed, same(rows, seed, keys, "_l_", keys[1:]), "left").drop(*["_l_" + k for k in keys])
