"""A vault in a folder: feeds staged into logs, logs loaded into tables, every load audited.

Each step is distributed work per table; the driver sees counts only. Tables are independent
of each other and a few are worked on at a time. Nothing is updated: staging logs, tables,
quarantine and audit only ever grow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from lodestrata.model import KEYED_KINDS, VERSIONED_KINDS, Binding, Entity, Model, active_bindings
from lodestrata.operators.dedup import key_multiplicity, refuse_ambiguous
from lodestrata.operators.history import type2
from lodestrata.operators.load import (
    empty_like, load_keyed, load_satellite, named_in, named_keys, refuse_duplicates, refuse_imbalance, with_ghost, without_earlier,
)
from lodestrata.operators.quality import configured_rules, merge_rules, quarantine, split
from lodestrata.operators.staging import declared_columns, kept_operations, mandatory_rules, project, stage

AUDIT_LOAD = ("job_run_id string, table_name string, written_by string, staged long, accepted long, "
              "recorded_at timestamp")
AUDIT_DISCARD = "job_run_id string, table_name string, discard_reason string, discarded long, recorded_at timestamp"
AUDIT_RUN = "job_run_id string, phase string, target string, active_sources string, recorded_at timestamp"


class Vault:
    def __init__(self, spark: SparkSession, root: str, model: Model, at_a_time: int = 4):
        self.spark, self.root, self.model, self.at_a_time = spark, root.rstrip("/"), model, at_a_time
        self.viewed: set[str] = set()

    # Tables

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(layer, table))
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def audit(self, table: str, schema: str) -> DataFrame:
        held = self.read("audit", table)
        return self.spark.createDataFrame([], schema) if held is None else held

    def stored(self, table: str, run: str | None = None) -> DataFrame | None:
        """A raw table; with ``run`` what that run has stored. Each run has a folder of its own, so that one which
        stopped before its audit can still be counted."""
        held = self.read("raw", table)
        if held is None:
            return None
        return (held if run is None else held.where(F.col("_run").cast("string") == run)).drop("_run")

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        df.write.mode("append").parquet(self.path(layer, table))

    def append_log(self, df: DataFrame, table: str) -> None:
        """Staging logs are partitioned by load day, so that a load can leave out old days."""
        (df.withColumn("_load_day", F.to_date("load_dts")).write.mode("append").partitionBy("_load_day")
         .parquet(self.path("stg", table)))

    def log(self, table: str, since: str | None = None) -> DataFrame | None:
        """A staging log, or its loads after ``since``."""
        log = self.read("stg", table)
        if log is not None and since is not None:
            log = without_earlier(log.where(F.col("_load_day") >= F.to_date(F.lit(since))), since)
        return None if log is None else log.drop("_load_day")

    @staticmethod
    def table_of(entity: Entity, binding: Binding) -> str:
        """Keyed entities have one table for all their sources, satellites one per source."""
        return entity.name if entity.kind in KEYED_KINDS else f"{entity.name}_{binding.rec_src}".lower()

    def tables(self, wanted: Sequence[str] | None = None) -> dict[str, tuple[Entity, list[Binding]]]:
        out: dict[str, tuple[Entity, list[Binding]]] = {}
        for entity in active_bindings(self.model, wanted).values():
            for b in entity.bindings:
                out.setdefault(self.table_of(entity, b), (entity, []))[1].append(b)
        return out

    # Staging

    def stage(self, feeds: Mapping[str, DataFrame], load_dts: str | Column, batch_id: str,
              wanted: Sequence[str] | None = None, rules: DataFrame | None = None) -> None:
        """Every active binding of a delivered feed into its staging log and quarantine twin."""
        def one(item: tuple[str, tuple[Entity, list[Binding]]]) -> None:
            table, (entity, bindings) = item
            for b in (b for b in bindings if b.feed in feeds):
                rows = stage(feeds[b.feed], self.model, entity, b, load_dts=load_dts, batch_id=batch_id)
                checks = mandatory_rules(entity, b, rows.schema)
                if rules is not None:
                    checks = merge_rules(checks, configured_rules(rules, table))
                valid = split(rows, checks)[0]
                if entity.kind in VERSIONED_KINDS:
                    valid = kept_operations(valid)
                elif entity.kind == "nhl":
                    valid = valid.dropDuplicates([entity.hk])
                self.append_log(project(valid, entity, b), table)
                self.append(quarantine(rows, checks, declared_columns(entity, b)), "qtn", table)

        with ThreadPoolExecutor(self.at_a_time) as pool:
            list(pool.map(one, self.tables(wanted).items()))

    # Loading

    def load(self, job_run_id: str, recorded_at: str, wanted: Sequence[str] | None = None,
             since: str | None = None) -> dict[str, str]:
        """Every table from its log. Returns table -> what went wrong; a table that fails does
        not keep the others from loading.

        ``since`` restricts the logs to later loads. What came before must be loaded already;
        the tables themselves then stand in for it, and the work grows with what is new.
        """
        problems = {}
        tables = self.tables(wanted)
        sources = ",".join(sorted({b.rec_src for _, bs in tables.values() for b in bs}))
        self._phase(job_run_id, "opened", sources, recorded_at)
        with ThreadPoolExecutor(self.at_a_time) as pool:
            loads = {t: pool.submit(self._load_one, t, entity, since, job_run_id) for t, (entity, _) in tables.items()}
            for table, future in loads.items():
                try:
                    counted = future.result()
                except (ValueError, PySparkException) as e:
                    problems[table] = str(e)
                    continue
                # Audit tables have one writer.
                if counted:
                    self._record(table, job_run_id, recorded_at, *counted)
        if not problems:
            self._phase(job_run_id, "completed", sources, recorded_at)
        self.views(sorted(self.viewed & set(tables)), by_table=True)
        return problems

    def _phase(self, run: str, phase: str, sources: str, at: str) -> None:
        row = self._few([(run, phase, self.root, sources)], AUDIT_RUN)
        self.append(row.withColumn("recorded_at", F.lit(at).cast("timestamp")), "audit", "aud_load_run")

    def _few(self, rows: list[tuple], schema: str) -> DataFrame:
        """Audit rows but for their time, as one file."""
        return self.spark.createDataFrame(rows, schema.rpartition(",")[0]).coalesce(1)

    def _load_one(self, table: str, entity: Entity, since: str | None, run: str) -> tuple[int, int, list[tuple[str, int]]] | None:
        """(staged, accepted, discards) of one table, or None without a log. What does not add up, or would be stored
        twice, is a problem of the table, and no reader ever sees it."""
        log = self.log(table, since)
        if log is None:
            return None
        if self.stored(table) is None:
            self.append(with_ghost(empty_like(log), self._ghost_key(entity)), "raw", f"{table}/_run=ghost")
        target, key = self.stored(table), self._ghost_key(entity)
        versioned = entity.kind in VERSIONED_KINDS
        if versioned:
            staged = log.count()
            new = load_satellite(log, target, key, "mas_key" if entity.kind == "msat" else None)
        else:
            counted = key_multiplicity(log, [entity.hk]).first()
            staged, distinct = counted["total_rows"], counted["distinct_keys"]
            if entity.kind != "hub":
                refuse_ambiguous(log, entity.hk, counted=counted)
            new = load_keyed(log, target, entity.hk)
        fresh = self._pending(new, table, run)
        accepted = fresh.count() + self.stored(table, run).count()
        grain = [key, *(["mas_key"] if entity.kind == "msat" else []), *(["load_dts", "sub_seq"] if versioned else [])]
        refuse_duplicates(table, named_in(self.stored(table).select(*grain).unionByName(fresh.select(*grain)), log, key), grain)
        if versioned:
            self._publish(table, run)
            return staged, accepted, [("unchanged_hashdiff", staged - accepted)]
        others = self.read("raw", table).where(F.col("_run").cast("string") != run).select(entity.hk)
        present = named_keys(others, log, entity.hk).count()
        refuse_imbalance(table, staged, accepted, staged - distinct + present)
        self._publish(table, run)
        return staged, accepted, [("duplicate_in_batch", staged - distinct), ("already_present", present)]

    def _hidden(self, table: str, run: str) -> str:
        """Where a load's rows wait for its checks. Readers do not see such folders."""
        return self.path("raw", f"{table}/_pending-{hashlib.sha256(run.encode()).hexdigest()[:24]}")

    def _pending(self, new: DataFrame, table: str, run: str) -> DataFrame:
        new.write.mode("overwrite").parquet(self._hidden(table, run))
        return self.spark.read.schema(new.schema).parquet(self._hidden(table, run))

    def _publish(self, table: str, run: str) -> None:
        """Checked rows become visible: the folder gets the run's name, in one step. Where an earlier attempt of the
        run has published already, the files join it."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path
        source, target = place(self._hidden(table, run)), place(self.path("raw", f"{table}/_run={run}"))
        files = source.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(target):
            if not files.rename(source, target):
                raise ValueError(f"{table}: what {run} has loaded could not be published")
            return
        for found in files.listStatus(source):  # the files of one load
            if found.getPath().getName().startswith("part-") and not files.rename(found.getPath(), place(target, found.getPath().getName())):
                raise ValueError(f"{table}: what {run} has loaded could not be published")
        files.delete(source, True)

    @staticmethod
    def _ghost_key(entity: Entity) -> str:
        return entity.hk if entity.kind in KEYED_KINDS else f"{entity.parents[0].name}_hk"

    def _record(self, table: str, run: str, at: str, staged: int, accepted: int, lost: list[tuple[str, int]]) -> None:
        """Audit rows of one load; a repeated run finds them and adds none."""
        done = self.audit("aud_table_load", AUDIT_LOAD).where(
            (F.col("job_run_id") == run) & (F.col("table_name") == table))
        if done.limit(1).count():
            return
        stamp = F.lit(at).cast("timestamp")
        rows = self._few([(run, table, "vault", staged, accepted)], AUDIT_LOAD)
        self.append(rows.withColumn("recorded_at", stamp), "audit", "aud_table_load")
        gone = self._few([(run, table, r, n) for r, n in lost], AUDIT_DISCARD)
        self.append(gone.withColumn("recorded_at", stamp), "audit", "aud_table_discard")

    # Reading

    def views(self, wanted: Sequence[str] | None = None, by_table: bool = False) -> list[str]:
        """A view per table under its stable name, and a type-2 view per satellite. ``load`` renews them."""
        made = []
        for table, (entity, _) in self.tables(None if by_table else wanted).items():
            if by_table and table not in wanted:
                continue
            held = self.stored(table)
            if held is None:
                continue
            self.viewed.add(table)
            held.createOrReplaceTempView(table)
            made.append(table)
            if entity.kind in VERSIONED_KINDS:
                key = self._ghost_key(entity)
                type2(held, key, "mas_key" if entity.kind == "msat" else None).createOrReplaceTempView(f"{table}_v1")
                made.append(f"{table}_v1")
        return made

    def counts(self, layer: str = "raw") -> DataFrame:
        """Rows per table."""
        parts = [df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
                 for t in self.tables() if (df := self.read(layer, t)) is not None]
        empty = self.spark.createDataFrame([], T.StructType().add("table_name", "string").add("row_count", "long"))
        return reduce(DataFrame.unionByName, parts, empty)
