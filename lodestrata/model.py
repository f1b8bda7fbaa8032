"""Declarations: what an entity is and how a feed is bound to it.

Plain frozen dataclasses; the operators read them while building a plan and nothing here
touches data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

SYSTEM_COLUMNS = ("load_dts", "applied_dts", "sub_seq", "rec_src", "batch_id", "manifest_id", "cdc_op")
KEYED_SYSTEM_COLUMNS = ("load_dts", "applied_dts", "rec_src", "batch_id", "manifest_id")
KEYED_KINDS = ("hub", "link", "nhl", "hal")
VERSIONED_KINDS = ("sat", "msat", "esat", "csat")
PAYLOAD_KINDS = ("nhl", *VERSIONED_KINDS)


@dataclass(frozen=True)
class Parent:
    """A hub an entity refers to; ``role`` tells two references to one hub apart."""
    hub: str
    role: str | None = None

    @property
    def name(self) -> str:
        return f"{self.role}_{self.hub}" if self.role else self.hub


@dataclass(frozen=True)
class Binding:
    """One feed bound to one entity."""
    feed: str
    rec_src: str
    keys: Mapping[str, str] = field(default_factory=dict)
    literals: Mapping[str, str] = field(default_factory=dict)
    parent_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    txn_keys: Sequence[str] = ()
    payload: Sequence[str] = ()
    mas_keys: Sequence[str] = ()
    row_filter: str | None = None
    derived: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    dedup_by: Sequence[str] = ()
    dedup_order: Sequence[str] = ()
    applied: str | None = None
    manifest: str | None = None
    cdc: str | None = None
    key_scope: str | None = None
    active: bool = True
    generation: int = 0


@dataclass(frozen=True)
class Entity:
    """A declared business concept. ``scope`` is the key space; None for authored keys."""
    name: str
    kind: str
    keys: Sequence[str] = ()
    scope: str | None = None
    parents: Sequence[Parent] = ()
    bindings: Sequence[Binding] = ()
    tenant_keys: Sequence[str] = ()

    @property
    def hk(self) -> str:
        return f"{self.name}_hk"

    def parent(self, name: str) -> Parent:
        return next(p for p in self.parents if p.name == name)


class Model(dict):
    """Entities by name. Stays whole, so a child can always compose its parent's key."""

    def __init__(self, *entities: Entity):
        super().__init__((e.name, e) for e in entities)
        for e in entities:
            self._check(e)

    def _check(self, e: Entity) -> None:
        for p in e.parents:
            if p.hub not in self:
                raise ValueError(f"{e.name}: parent {p.hub} is not declared")
        if e.kind == "hub" and e.tenant_keys and tuple(e.keys[:len(e.tenant_keys)]) != tuple(e.tenant_keys):
            raise ValueError(f"{e.name}: tenant columns must lead the key")
        if e.kind in ("link", "nhl", "hal") and len(e.parents) < (1 if e.kind == "nhl" else 2):
            raise ValueError(f"{e.name}: a {e.kind} needs its parents")
        for b in e.bindings:
            if e.kind in PAYLOAD_KINDS and not b.payload:
                raise ValueError(f"{e.name}/{b.rec_src}: no payload declared")
            taken = set(SYSTEM_COLUMNS) & {*b.payload, *e.keys, *b.txn_keys}
            if taken:
                raise ValueError(f"{e.name}/{b.rec_src}: {sorted(taken)} collide with system columns")
            unmapped = {p.name for p in e.parents} - set(b.parent_keys)
            if unmapped:
                raise ValueError(f"{e.name}/{b.rec_src}: parents {sorted(unmapped)} have no columns")


def active_bindings(model: Model, wanted: Sequence[str] | None = None) -> dict[str, Entity]:
    """Entities narrowed to the chosen bindings: ``SOURCE`` or ``entity/SOURCE``; none = all active."""
    known = {f"{e.name}/{b.rec_src}" for e in model.values() for b in e.bindings}
    known |= {b.rec_src for e in model.values() for b in e.bindings}
    unknown = set(wanted or ()) - known
    if unknown:
        raise ValueError(f"no such binding: {sorted(unknown)}")
    out = {}
    for e in model.values():
        kept = [b for b in e.bindings if b.active and (
            not wanted or b.rec_src in wanted or f"{e.name}/{b.rec_src}" in wanted)]
        if kept:
            out[e.name] = replace(e, bindings=tuple(kept))
    return out


def payload_grew(stored: Sequence[str], declared: Sequence[str]) -> bool:
    """A payload may only grow at its end, or every stored hashdiff would stop matching."""
    return list(declared[:len(stored)]) == list(stored)
