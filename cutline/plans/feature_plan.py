"""Enumerates the features of a target entity up to depth 2. Pure driver-side metadata."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from cutline.functions.calendar import Offset
from cutline.functions.primitives import (
    DEFAULT_AGGREGATES, DEFAULT_TRANSFORMS, DEFAULT_WHERE, MONTH_OF_CUTOFF, Aggregate, Transform, aggregate,
    primitive_name, transform)
from cutline.operators.entities import Entity, EntitySet


@dataclass(frozen=True)
class FeatureSpec:
    target: str
    aggregates: Sequence[str] = DEFAULT_AGGREGATES
    transforms: Sequence[str] = DEFAULT_TRANSFORMS
    where: Sequence[str] = DEFAULT_WHERE
    training_window: Offset | None = Offset(24)
    include_cutoff: bool = False
    depth: int = 2
    ignore_entities: Sequence[str] = ()
    ignore_columns: Mapping[str, Sequence[str]] = field(default_factory=dict)
    drop_contains: Sequence[str] = ()
    drop_exact: Sequence[str] = ()
    drop_substring: bool = False
    max_features: int | None = None
    only: Sequence[str] = ()

    def __post_init__(self):
        w = self.training_window
        if w is not None and w.unit not in ("months", "days"):
            raise ValueError("the training window is given in months or days")


@dataclass(frozen=True)
class Source:
    """A column of an entity's row: its own, a transform of it, a parent's, or a child aggregate."""

    path: str
    kind: str
    how: str
    column: str
    transform: str | None = None
    parent: str | None = None
    inner: "Feature | None" = None


@dataclass(frozen=True)
class Feature:
    name: str
    how: str
    kind: str
    entity: str
    source: Source | None = None
    primitive: str | None = None
    where: tuple[Source, Any] | None = None


def _accepts(takes: str, kind: str) -> bool:
    if takes == "any":
        return kind in ("numeric", "discrete", "boolean")
    if takes == "discrete":
        return kind in ("discrete", "boolean")
    return takes == kind


def _columns(entity: Entity, spec: FeatureSpec) -> list[tuple[str, str]]:
    ignored = set(spec.ignore_columns.get(entity.name, ()))
    return [(c, entity.kind(c)) for c in entity.df.columns if c not in ignored and entity.kind(c) != "key"]


def _transformed(entity: Entity, spec: FeatureSpec, transforms: Sequence[Transform]) -> list[Source]:
    out = []
    for column, kind in _columns(entity, spec):
        for t in transforms:
            if t.kind == "previous" and entity.time is None:
                continue
            fits = column == entity.time if t.takes == "time" else t.takes == kind
            if fits:
                out.append(Source(f"{t.name.upper()}({column})", t.gives, "transform", column, t.name))
    return out


def _own(entity: Entity, spec: FeatureSpec) -> list[Source]:
    return [Source(c, k, "column", c) for c, k in _columns(entity, spec) if c != entity.time]


def _parents(es: EntitySet, entity: Entity, spec: FeatureSpec, skip: str | None = None) -> list[Source]:
    out = []
    for p in entity.parents:
        if p.name in spec.ignore_entities or p.name == skip or p.name not in es.entities:
            continue
        parent = es[p.name]
        out += [Source(f"{p.name}.{c}", k, "parent", c, parent=p.name)
                for c, k in _columns(parent, spec) if c != parent.time]
    return out


def _aggregates(child: Entity, sources: Sequence[Source], prims: Sequence[Aggregate]) -> list[Feature]:
    out = []
    for prim in prims:
        label = prim.name.upper()
        if prim.takes == "rows" or (prim.takes == "time" and child.time):
            argument = child.name if prim.takes == "rows" else f"{child.name}.{child.time}"
            out.append(Feature(f"{label}({argument})", "aggregate", prim.gives, child.name, None, prim.name))
        elif prim.takes != "time":
            if prim.route == "order" and child.time is None:
                continue
            for s in sources:
                if _accepts(prim.takes, s.kind):
                    kind = s.kind if prim.gives == "same" else prim.gives
                    out.append(Feature(f"{label}({child.name}.{s.path})", "aggregate", kind, child.name, s, prim.name))
    return out


def _where(es: EntitySet, child: Entity, target: str, sources: Sequence[Source], prims: Sequence[Aggregate],
           ) -> list[Feature]:
    conditions = [(s, v) for s in sources if s.how in ("column", "parent")
                  for v in es[s.parent or child.name].interesting.get(s.column, ()) if v is not None]
    out = []
    for s, value in conditions:
        for prim in prims:
            if prim.takes == "rows":
                inputs: list[Source | None] = [None]
            else:
                inputs = [x for x in sources if _accepts(prim.takes, x.kind)]
            for x in inputs:
                argument = child.name if x is None else f"{child.name}.{x.path}"
                kind = prim.gives if prim.gives != "same" else x.kind
                out.append(Feature(f"{prim.name.upper()}({argument} WHERE {s.path} = {value})", "aggregate",
                                   kind, child.name, x, prim.name, (s, value)))
    return out


def _dropped(name: str, names: set[str], substring: bool) -> bool:
    if substring:
        return any(n in name for n in names)
    return bool(names & set(re.split(r"[^\w]+", name)))


def plan_features(es: EntitySet, spec: FeatureSpec) -> list[Feature]:
    """All features of the target, sorted by name."""
    target = es[spec.target]
    wanted = [primitive_name(p) for p in spec.aggregates]
    prims = [aggregate(p) for p in wanted if p != MONTH_OF_CUTOFF]
    transforms = [transform(t) for t in spec.transforms]
    where = [aggregate(p) for p in spec.where]

    found = [Feature(s.path, "target", s.kind, target.name, s) for s in
             [*_own(target, spec), *_parents(es, target, spec), *_transformed(target, spec, transforms)]]
    if MONTH_OF_CUTOFF in wanted:
        found.append(Feature(MONTH_OF_CUTOFF.upper(), "cutoff", "discrete", target.name))
    for child, _ in es.children(target.name):
        if child.name in spec.ignore_entities:
            continue
        sources = _own(child, spec)
        if spec.depth >= 2:
            sources = sources + _transformed(child, spec, transforms) + _parents(es, child, spec, target.name)
        found += _aggregates(child, sources, prims)
        found += _where(es, child, target.name, sources, where)
        if spec.depth >= 2 and child.key and child.time:
            for grandchild, _ in es.children(child.name):
                if grandchild.name in spec.ignore_entities:
                    continue
                inner = [f for f in _aggregates(grandchild, _own(grandchild, spec), prims) if f.kind == "numeric"]
                stacked = [Source(f.name, "numeric", "inner", f.name, inner=f) for f in inner]
                outer = [p for p in prims if p.takes == "numeric" and p.route in ("merge", "median")]
                found += _aggregates(child, stacked, outer)

    keys = es.key_names() | set(spec.drop_contains)
    kept = {f.name: f for f in found
            if f.name not in spec.drop_exact and not _dropped(f.name, keys, spec.drop_substring)}
    if spec.only:
        unknown = set(spec.only) - set(kept)
        if unknown:
            raise ValueError(f"no such features: {sorted(unknown)}")
        kept = {n: kept[n] for n in spec.only}
    ordered = [kept[n] for n in sorted(kept)]
    return ordered[: spec.max_features] if spec.max_features else ordered
