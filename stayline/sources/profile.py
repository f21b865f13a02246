"""Declarative description of a source database, loaded from its profile file."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.timeframe import as_long
from stayline.operators.labs import LabRules
from stayline.sources.readers import path_exists, read_raw

PROFILES = Path(__file__).parent / "profiles"
UNITS = ("abs", "min", "ms", "sec")


@dataclass(frozen=True)
class CodeLookup:
    """A code column and the dictionary that describes it."""

    column: str
    file: str
    key: str
    describe: dict[str, str]
    only: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class EventTable:
    file: str
    time: str
    unit: str
    exclude: tuple[str, ...] = ()
    codes: tuple[CodeLookup, ...] = ()
    group: str = "base"
    name: str = ""

    @property
    def label(self) -> str:
        return self.name or self.file.split("/")[-1]


@dataclass(frozen=True)
class Measurements:
    file: str
    key: str
    time: str
    unit: str
    code: str
    value: str
    codes: dict[str, tuple]
    unit_column: str | None = None


@dataclass(frozen=True)
class Exclusion:
    """Rows that end the use of renal measures; ``rule`` says what makes a row count."""

    file: str
    key: str
    time: str
    unit: str
    rule: str
    code: str | None = None
    codes: tuple = ()
    value: str | None = None
    equals: str | None = None
    time_else: str | None = None


@dataclass(frozen=True)
class Profile:
    name: str
    keys: dict[str, str]
    join: str
    labs: dict
    tables: tuple[EventTable, ...]
    measurements: tuple[Measurements, ...]
    exclusions: tuple[Exclusion, ...]
    encoding: str | None = None
    unit_text: dict | None = None
    unit_id: dict | None = None
    visits: dict | None = None
    constant_labels: tuple[str, ...] = ()

    def __post_init__(self):
        unknown = {t.unit for t in (*self.tables, *self.measurements, *self.exclusions)} - set(UNITS)
        if unknown:
            raise ValueError(f"{self.name}: unknown time units {sorted(unknown)}")

    def rules(self, pred_hours: int, horizons: tuple[int, ...]) -> LabRules:
        settings = {"combine": None, **self.labs}
        if "excluded" in settings:
            settings["excluded"] = tuple(settings["excluded"])
        return LabRules(pred_hours=pred_hours, horizons=horizons, **settings)

    def event_tables(self, more: bool = False, visits: bool = False) -> list[EventTable]:
        if visits and not self.visits:
            raise ValueError(f"{self.name} has no emergency visits")
        groups = ["base"] + ["more"] * more + ["ed"] * visits
        return [t for t in self.tables if t.group in groups]


def load_profile(name: str) -> Profile:
    path = PROFILES / f"{name}.toml"
    if not path.exists():
        known = ", ".join(sorted(p.stem for p in PROFILES.glob("*.toml")))
        raise KeyError(f"unknown source {name!r}; known are {known}")
    raw = tomllib.loads(path.read_text())
    tables = tuple(
        EventTable(**{**t, "exclude": tuple(t["exclude"]), "codes": tuple(CodeLookup(**c) for c in t.get("codes", []))})
        for t in raw.pop("tables")
    )
    measured = tuple(Measurements(**m) for m in raw.pop("measurements"))
    excluded = tuple(Exclusion(**{**e, "codes": tuple(e.get("codes", []))}) for e in raw.pop("exclusions"))
    constant = tuple(raw.pop("constant_labels", []))
    return Profile(tables=tables, measurements=measured, exclusions=excluded, constant_labels=constant, **raw)


@dataclass(frozen=True)
class Source:
    """A source database in a folder, read with its profile."""

    spark: SparkSession
    root: str
    profile: Profile
    ext: str = ".csv"
    classes: str | None = None
    crosswalk: str | None = None
    # tables by file name that stand in for files
    frames: dict[str, DataFrame] | None = None

    def path(self, file: str) -> str:
        return f"{self.root}/{file}" if file.endswith("/csv") else f"{self.root}/{file}{self.ext}"

    def inputs(self) -> list[str]:
        """The paths that results depend on; none where tables stand in for files."""
        return [] if self.frames is not None else [p for p in (self.root, self.classes, self.crosswalk) if p]

    def has(self, file: str) -> bool:
        if self.frames is not None:
            return file in self.frames
        return path_exists(self.spark, self.path(file))

    def table(self, file: str, *columns: str, row_limit: int | None = None) -> DataFrame:
        """A raw table, as text for CSV, with the wanted columns."""
        if self.frames is not None:
            found = self.frames[file].select(*columns) if columns else self.frames[file]
            return found.limit(row_limit) if row_limit is not None else found
        form = "parquet" if self.ext == ".parquet" else "csv"
        return read_raw(
            self.spark, self.path(file), form, list(columns) or None, encoding=self.profile.encoding, row_limit=row_limit
        )

    def keyed(self, file: str, *columns: str, patient: bool = True) -> DataFrame:
        """A table with its key columns renamed to stay_id, hadm_id and, if wanted, patient_id."""
        names = self.profile.keys
        renames = {names.get("hadm"): "hadm_id", names["stay"]: "stay_id"}
        if patient and "patient" in names:
            renames[names["patient"]] = "patient_id"
        df = self.table(file, *columns)
        renamed = df.withColumnsRenamed({own: key for own, key in renames.items() if own in df.columns})
        numeric = {k: as_long(F.col(k)) for k in ("stay_id", "hadm_id") if k in renamed.columns}
        return renamed.withColumns(numeric) if numeric else renamed


def open_source(spark: SparkSession, name: str, root: str, **options) -> Source:
    return Source(spark, root, load_profile(name), **options)
