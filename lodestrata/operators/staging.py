"""From a feed to staged rows: conform, cast, stamp, derive keys, project to declared shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.functions.keys import (
    DELIMITER, as_col, hash_key, hashdiff, key_rules, norm, parent_key,
)
from lodestrata.model import (
    KEYED_KINDS, KEYED_SYSTEM_COLUMNS, PAYLOAD_KINDS, SYSTEM_COLUMNS, VERSIONED_KINDS, Binding,
    Entity, Model,
)
from lodestrata.operators.ordered import first_per_key

KEPT_OPERATIONS = ("I", "U")


def conform(df: DataFrame, row_filter: str | None = None,
            derived: Mapping[str, str] | None = None) -> DataFrame:
    """Row filter on the source's columns, then derived columns, each as SQL text."""
    if row_filter:
        df = df.where(row_filter)
    return df.withColumns({n: F.expr(e) for n, e in derived.items()}) if derived else df


def cast_declared(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    return df.withColumns({n: F.col(n).cast(t) for n, t in casts.items()}) if casts else df


def narrow(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Only the columns some consumer reads, in name order."""
    wanted = {n.lower() for n in needed}
    return df.select(*sorted((c for c in df.columns if c.lower() in wanted), key=str.lower))


def timestamp(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp")


def stamps(rec_src: str, load_dts: str | Column, batch_id: str | None, applied: str | Column | None = None,
           manifest: str | Column | None = None, cdc: str | Column | None = None) -> dict[str, Column]:
    """The system columns of a staged row, by name."""
    none = F.lit(None)
    operation = F.coalesce(F.upper(as_col(cdc)), F.lit("I")) if cdc is not None else F.lit("I")
    return {
        "load_dts": timestamp(load_dts),
        "applied_dts": (none if applied is None else as_col(applied)).cast("timestamp"),
        "sub_seq": F.lit(0),
        "rec_src": F.lit(rec_src),
        "batch_id": F.lit(batch_id).cast("string"),
        "manifest_id": (none if manifest is None else as_col(manifest)).cast("string"),
        "cdc_op": operation,
    }


def system_columns(df: DataFrame, rec_src: str, load_dts: str | Column, batch_id: str | None,
                   applied=None, manifest=None, cdc=None) -> DataFrame:
    """``load_dts`` is when we learned of the row, ``applied_dts`` when it happened at the source."""
    return df.withColumns(stamps(rec_src, load_dts, batch_id, applied, manifest, cdc))


def key_columns(entity: Entity, binding: Binding) -> dict[str, Column]:
    """Business-key columns as text; a literal of the binding stands for a missing column."""
    missing = [k for k in entity.keys if k not in binding.literals and k not in binding.keys]
    if missing:
        raise ValueError(f"{entity.name}/{binding.rec_src}: no source for key {missing}")
    return {k: F.lit(binding.literals[k]).cast("string") if k in binding.literals
            else F.col(binding.keys[k]).cast("string") for k in entity.keys}


def readable_key(cols: Sequence[str | Column]) -> Column:
    return F.concat_ws(DELIMITER, *[norm(c) for c in cols])


def sub_key(cols: Sequence[str | Column]) -> Column:
    """Sub-key of a multi-active satellite."""
    return F.concat_ws("|", *[norm(c) for c in cols])


def scope_of(model: Model, hub: str, binding: Binding) -> str | None:
    """A parent's key space is the hub's own, unless the binding names another."""
    scope = model[hub].scope
    return binding.key_scope if scope is not None and binding.key_scope else scope


def parent_components(model: Model, entity: Entity, binding: Binding) -> dict[str, list[Column]]:
    """Per parent, the components of its key: the hub's literals and the child's columns."""
    out = {}
    for p in entity.parents:
        hub, cols = model[p.hub], list(binding.parent_keys[p.name])
        literals = {k: v for b in hub.bindings for k, v in b.literals.items()}
        source = iter(cols)
        take_literals = len(cols) < len(hub.keys)
        parts = [F.lit(literals[k]) if take_literals and k in literals else F.col(next(source))
                 for k in hub.keys]
        out[p.name] = parts
    return out


def hash_columns(model: Model, entity: Entity, binding: Binding) -> dict[str, Column]:
    """Own and parent hash keys of an entity, by column name."""
    parents = parent_components(model, entity, binding)
    keys = {f"{p.name}_hk": parent_key(parents[p.name], scope_of(model, p.hub, binding))
            for p in entity.parents}
    if entity.kind == "hub":
        own = hash_key(list(key_columns(entity, binding).values()), binding.key_scope or entity.scope)
    elif entity.kind in KEYED_KINDS:
        own = hash_key([c for parts in parents.values() for c in parts] + list(binding.txn_keys),
                       entity.scope)
    else:
        return keys
    return {entity.hk: own, **keys}


def stage(df: DataFrame, model: Model, entity: Entity, binding: Binding, *, load_dts: str | Column,
          batch_id: str | None = None) -> DataFrame:
    """Every column the feed has plus every column the vault derives; nothing is dropped yet,
    because a rule may name any source column."""
    df = conform(df, binding.row_filter, binding.derived)
    if binding.dedup_by:
        if binding.dedup_order and not df.isStreaming:
            # Rows the declared order leaves equal are told apart by content, so that a
            # second run keeps the same survivor.
            df = first_per_key(df, binding.dedup_by, *[F.expr(o).desc_nulls_last() for o in binding.dedup_order],
                               F.xxhash64(*df.columns))
        else:
            df = df.dropDuplicates(list(binding.dedup_by))
    df = cast_declared(df, binding.casts)
    added = stamps(binding.rec_src, load_dts, batch_id, binding.applied, binding.manifest, binding.cdc)
    if entity.kind == "hub":
        keys = key_columns(entity, binding)
        added |= {k: c for k, c in keys.items()}
        added[f"{entity.name}_bk"] = readable_key(list(keys.values()))
    added |= hash_columns(model, entity, binding)
    if entity.kind in VERSIONED_KINDS:
        added["hashdiff"] = hashdiff(list(binding.payload))
    if entity.kind == "msat":
        added["mas_key"] = sub_key(list(binding.mas_keys))
    return df.withColumns(added)


def declared_columns(entity: Entity, binding: Binding) -> list[str]:
    """The shape of the vault table: a pure function of the declaration."""
    names: list[str] = []
    if entity.kind in KEYED_KINDS:
        names.append(entity.hk)
    names += [f"{p.name}_hk" for p in entity.parents]
    if entity.kind == "hub":
        names += [*entity.keys, f"{entity.name}_bk"]
    if entity.kind in VERSIONED_KINDS:
        names.append("hashdiff")
    if entity.kind == "msat":
        names.append("mas_key")
    names += binding.txn_keys
    if entity.kind in PAYLOAD_KINDS:
        names += binding.payload
    clash = set(names) & set(SYSTEM_COLUMNS)
    if clash:
        raise ValueError(f"{entity.name}: {sorted(clash)} collide with system columns")
    names += KEYED_SYSTEM_COLUMNS if entity.kind in KEYED_KINDS else SYSTEM_COLUMNS
    return list(dict.fromkeys(names))


def project(df: DataFrame, entity: Entity, binding: Binding, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*declared_columns(entity, binding), *extra)


def kept_operations(df: DataFrame) -> DataFrame:
    """Inserts and updates; deletes do not reach a satellite."""
    return df.where(F.col("cdc_op").isin(*KEPT_OPERATIONS))


def mandatory_rules(entity: Entity, binding: Binding, schema: StructType | None = None) -> list[tuple[str, Column]]:
    """Rules every staged row of a kind must meet.

    Parent components and the sub-keys of multi-active rows are guarded as well as own keys,
    because a digest of NULLs is never NULL and a missing sub-key would make siblings one.
    For the same reason the presence of a digest that ``stage`` derives is no rule: it is
    there by construction, and deriving it once more to test it would double the work.
    """
    rules: list[tuple[str, Column]] = []
    if entity.kind == "hub":
        rules += key_rules(list(entity.keys), schema=schema)
    guarded = [c for p in entity.parents for c in binding.parent_keys[p.name]] + list(binding.txn_keys)
    if entity.kind == "msat":
        guarded += binding.mas_keys
    if guarded:
        rules += key_rules(list(dict.fromkeys(guarded)), schema=schema)
    return rules
