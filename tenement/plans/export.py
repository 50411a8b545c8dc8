"""Exports that users define: fields, a source, a decoration and job options."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import export_manifest
from ..operators.fields import Field, Rendering, grouped, project
from ..operators.filters import period
from ..sources.files import write_csv, write_json_by

REGISTRY: dict[str, Export] = {}


@dataclass(frozen=True)
class Export:
    """``source`` prepares the rows, ``fields`` select and render or group them, ``decorate`` has the last word, ``order`` sorts the file.

    What a job's options act on: ``unique`` are the fields of the grouped form, of rows that meet ``house``; ``lifetime`` names the columns of first and last day and of a value that only listings with
    details have, so that a job's days keep what lived in them; ``region`` is the column that regions are chosen by, and may be one of, and JSON is filed by.
    """

    fields: Sequence[Field]
    source: Callable[[DataFrame, Job], DataFrame] = lambda df, job: df
    decorate: Callable[[DataFrame], DataFrame] = lambda df: df
    order: Sequence[Column] = field(default_factory=tuple)
    unique: Sequence[Field] = ()
    house: Callable[[], Column] | None = None
    lifetime: tuple[str, str, str] | None = None
    region: str | None = None

    def rows(self, df: DataFrame, job: Job, machine: bool = False) -> DataFrame:
        df = self.source(df, job)
        if self.region:
            df = in_regions(df, job, self.region)
        if self.lifetime and job.start and job.end:
            df = df.where(period(job.start, job.end, *self.lifetime))
        if job.unique and self.house:
            df = df.where(self.house())
        fields, how = self.unique if job.unique and self.unique else self.fields, Rendering(machine, job.letters, job.enum)
        return self.decorate((grouped if any(f.aggregate for f in fields) else project)(df, fields, how))

    def filed_by(self, job: Job) -> str:
        """The machine name of the region's field; a JSON export files its objects by it."""
        fields = self.unique if job.unique and self.unique else self.fields
        return next((f.name or f.column for f in fields if f.column == (job.json if isinstance(job.json, str) else self.region)), job.json or self.region)


@dataclass(frozen=True)
class Job:
    """Options of a run. Periodic runs only export on the last day of a month, and then for month, quarter and year as they end. ``json`` names the column that JSON files are parted by."""

    start: date | None = field(default_factory=date.today)
    end: date | None = field(default_factory=date.today)
    unique: bool = False
    enum: bool = False
    json: str | None = None
    regions: tuple[str, ...] = ()
    letters: bool = True
    periodic: bool = False

    def periods(self, today: date) -> list[tuple[str, date, date]]:
        """Label, first and last day of what is due."""
        if not self.periodic:
            start, end = sorted((self.start or today, self.end or today))
            return [(f"{start:%Y%m%d}-{end:%Y%m%d}", start, end)]
        if (today + timedelta(days=1)).day != 1:
            return []
        due = [(f"{today:%Y%m}", today.replace(day=1), today)]
        if today.month % 3 == 0:
            due.append((f"{today.year}Q{today.month // 3}", today.replace(month=today.month - 2, day=1), today))
        if today.month == 12:
            due.append((f"{today.year}", today.replace(month=1, day=1), today))
        return due


def register_export(name: str, export: Export) -> None:
    REGISTRY[name] = export


def options(argv: Sequence[str]) -> tuple[str, Job]:
    """Name of the export and its job from command-line words."""
    p = argparse.ArgumentParser()
    p.add_argument("name")
    for k in ("start", "end"):
        p.add_argument(f"--{k}", type=date.fromisoformat, default=date.today())
    for k in ("unique", "enum", "periodic"):
        p.add_argument(f"--{k}", action="store_true")
    p.add_argument("--digits", dest="letters", action="store_false")
    p.add_argument("--json")
    p.add_argument("--regions", type=lambda s: tuple(s.split(",")), default=())
    given = vars(p.parse_args(argv))
    return given.pop("name"), Job(**given)


def run_export(name: str, df: DataFrame, job: Job, path: str, vendor: str | None = None) -> DataFrame | None:
    """Write the export as CSV for people, or as JSON for machines by region; with ``vendor`` give the manifest of what was written."""
    export = REGISTRY[name]
    if job.json:
        rows = export.rows(df, job, machine=True)
        write_json_by(rows, path, export.filed_by(job))
    else:
        rows = export.rows(df, job)
        write_csv(rows, path, list(export.order))
    return export_manifest(rows, vendor) if vendor else None


def run_periodic(name: str, df: DataFrame, job: Job, path: str, today: date) -> list[str]:
    """What is due on a day: for every period that ends, CSV below ``<path>/<label>/csv`` and JSON below ``<path>/<label>/json``, of the listings that lived in it; the labels."""
    export, done = REGISTRY[name], []
    for label, start, end in job.periods(today):
        one = replace(job, start=start, end=end, periodic=False)
        run_export(name, df, replace(one, json=None), f"{path}/{label}/csv")
        if export.region:
            run_export(name, df, replace(one, json=export.region), f"{path}/{label}/json")
        done.append(label)
    return done


def in_regions(df: DataFrame, job: Job, region: str) -> DataFrame:
    return df.where(F.col(region).isin(*job.regions)) if job.regions else df
