"""Declarative exports: a list of fields drives projection, rendering, group keys and aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import render_human, render_machine


@dataclass(frozen=True)
class Field:
    """A published column: ``key`` takes a value of a JSON text or map, ``enum`` names the codes, ``aggregate`` makes it an aggregate of a grouped export, ``children`` are the parts of a
    struct as columns ``<label>_<child>``. ``kind`` (text, boolean, time, number, flag) says how the value is written, for people and for machines; ``fn`` renders it otherwise.
    ``name`` is its name in machine output, else the column's."""

    column: str
    label: str
    aggregate: Callable[[str], Column] | None = None
    fn: Callable[[Column], Column] | None = None
    key: str | None = None
    enum: Sequence[str] | None = None
    children: Sequence[str] = ()
    kind: str | None = None
    name: str | None = None


@dataclass(frozen=True)
class Rendering:
    """``machine`` gives typed values under short names, else texts for people under labels, booleans as ``letters`` or digits; ``enum`` tells the names of codes: beside them for people, in their
    place for machines."""

    machine: bool = False
    letters: bool = True
    enum: bool = True

    def value(self, f: Field, c: Column) -> Column:
        if f.fn:
            c = f.fn(c)
        if f.kind is None:
            return c
        return render_machine(c, f.kind) if self.machine else render_human(c, f.kind, self.letters)

    def label(self, f: Field) -> str:
        return (f.name or f.column) if self.machine else f.label


def columns(df: DataFrame, f: Field, how: Rendering | None = None) -> list[Column]:
    how = how or Rendering()
    c, label = F.col(f.column), how.label(f)
    if f.key:
        c = F.get_json_object(c, f"$.{f.key}") if df.schema[f.column].dataType.simpleString() == "string" else c[f.key]
    if f.children:
        return [how.value(f, c[child]).alias(f"{label}_{child}") for child in f.children]
    if f.enum is None or not how.enum:
        return [how.value(f, c).alias(label)]
    name = F.get(F.array(*map(F.lit, f.enum)), c)
    if how.machine:
        return [F.coalesce(name, c.cast("string")).alias(label)]
    told = name if f.kind is None else F.coalesce(name, F.lit("-"))
    return [how.value(f, c).alias(label), told.alias(f"{label}_coding")]


def project(df: DataFrame, fields: Sequence[Field], how: Rendering | None = None) -> DataFrame:
    return df.select(*[c for f in fields for c in columns(df, f, how)])


def grouped(df: DataFrame, fields: Sequence[Field], how: Rendering | None = None) -> DataFrame:
    """Fields without an aggregate are the keys; values are rendered after grouping."""
    keys = [f for f in fields if f.aggregate is None]
    made = df.select("*", *[c.alias(f"_{f.label}") for f in keys for c in columns(df, Field(f.column, f.label, key=f.key))])
    out = made.groupBy(*[f"_{f.label}" for f in keys]).agg(*[f.aggregate(f.column).alias(f"_{f.label}") for f in fields if f.aggregate])
    return project(out, [replace(f, column=f"_{f.label}", aggregate=None, key=None, name=f.name or f.column) for f in fields], how)
