"""Parameters and source descriptions. Everything here is data; the operators read it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Keys:
    """Column names of the cohort keys and of the column that orders stays inside an admission."""

    stay: str = "stay_id"
    admission: str = "hadm_id"
    patient: str = "patient_id"
    order_by: str = "intime"


@dataclass(frozen=True)
class Params:
    """Knobs of one run. Window sizes are in hours."""

    obs: int = 12
    gap: int = 0
    pred: int = 24
    long_term_pred: int = 336
    min_age: int = 18
    max_age: int | None = None
    first_stay_only: bool = False
    min_events: int = 5
    max_events: int | None = 256
    max_event_tokens: int = 128
    max_stay_tokens: int = 8192
    valid_percent: float = 0.1
    seeds: tuple[int, ...] = (42,)
    labels: tuple[str, ...] = (
        "mortality",
        "long_term_mortality",
        "los_3day",
        "los_7day",
        "readmission",
        "final_acuity",
        "imminent_discharge",
    )
    diagnosis: bool = False
    measurements: tuple[str, ...] = ()
    code_backoff: bool = False
    trim_codes: bool = True
    packed_type: str = "smallint"  # "int" for vocabularies with ids beyond 32,767
    label_sources: bool = False  # keep the columns that labels are made from in the finished cohort

    def __post_init__(self):
        if self.min_events <= 0:
            raise ValueError("min_events must be positive")
        if self.max_events is not None and self.min_events > self.max_events:
            raise ValueError("min_events must not exceed max_events")
        if self.max_age is not None and self.min_age > self.max_age:
            raise ValueError("min_age must not exceed max_age")
        if not 0 <= self.valid_percent <= 0.5:
            raise ValueError("valid_percent must lie between 0 and 0.5")


@dataclass(frozen=True)
class TokenIds:
    """Ids of types, special tokens and number characters."""

    table_type: int = 1
    column_type: int = 2
    value_type: int = 3
    start_type: int = 5
    end_type: int = 6
    no_place: int = 0
    pad: int = 0
    zero: int = 121  # ids of the digits 0 to 9 follow each other
    dot: int = 119
    unknown: int = 100
    start: int = 101
    end: int = 102


@dataclass(frozen=True)
class StayLayout:
    """How one source spells its stays. ``mode`` picks the age rule and the time representation.

    ``birthdate`` and ``anchor`` sources carry absolute times and need patients and admissions;
    ``capped`` sources carry minute offsets and everything in the stay table.
    """

    mode: str
    stay: str
    admission: str
    patient: str
    dischtime: str
    outtime: str
    location: str
    locations: Mapping[str, str] = field(default_factory=dict)
    intime: str | None = None
    los: str | None = None
    units: tuple[str, str] | None = None
    died: str | None = None
    birth_date: str | None = None
    anchor_year: str | None = None
    anchor_age: str | None = None
    age: str | None = None
    age_cap: tuple[str, int] | None = None
    unit_status: tuple[str, str] | None = None
    visit_order: str | None = None


@dataclass(frozen=True)
class EventTableSpec:
    """One event table: which column is the time, what to leave out, which codes to describe."""

    name: str
    time: str
    unit: str  # "abs" (timestamp) or "min" (minutes from the start of the stay)
    exclude: tuple[str, ...] = ()
    descriptions: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, text column)
    row_key: tuple[str, ...] = ()


@dataclass(frozen=True)
class Bins:
    """Label = number of cut points the value has passed (from below, or from above when descending)."""

    cuts: tuple[float, ...]
    descending: bool = False


@dataclass(frozen=True)
class Band:
    """0 below the band, 1 inside (both ends included), 2 above."""

    low: float
    high: float


@dataclass(frozen=True)
class MeasurementTask:
    name: str
    items: tuple
    rule: Bins | Band
    before_exclusion: bool = False


@dataclass(frozen=True)
class LabTable:
    name: str
    code: str
    value: str
    time: str
    unit: str
    key: str  # "admission" or "stay"
    tasks: tuple[MeasurementTask, ...] = ()


@dataclass(frozen=True)
class ExclusionRule:
    """Rows of ``table`` that satisfy the SQL ``predicate`` exclude their key from ``time`` on.

    ``only_stays`` is an optional (table, SQL predicate): the row's stay must be in that selection.
    """

    table: str
    predicate: str
    time: str
    only_stays: tuple[str, str] | None = None


@dataclass(frozen=True)
class ExclusionSpec:
    rules: tuple[ExclusionRule, ...]
    key: str  # "patient" or "stay"
    unit: str = "abs"
    drop_multi_stay: bool = False


@dataclass(frozen=True)
class DiagnosisSpec:
    """``style`` is "versioned" (one code per row, optional ICD version) or "paths" (code lists on a path)."""

    table: str
    style: str
    code: str
    missing: str  # "drop" stays without a class, or give them an "empty" list
    key: str
    version: str | None = None
    path: str | None = None
    rare_class: int = 14


@dataclass(frozen=True)
class SourceSpec:
    name: str
    layout: StayLayout
    stays: str
    events: tuple[EventTableSpec, ...]
    patients: str | None = None
    admissions: str | None = None
    diagnosis: DiagnosisSpec | None = None
    labs: LabTable | None = None
    exclusion: ExclusionSpec | None = None
