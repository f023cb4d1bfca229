"""What a training job needs to know of its domain, and nothing it does not read.

Features are declared one by one, each as an object that knows its inputs and its Column expression; a
feature whose inputs a table lacks is left out of that table's projection. A spec is checked when it
is made, before any data is touched.
"""

from __future__ import annotations

import warnings
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.features import day_of_week, haversine_km, hour, month, parse_timestamp


class SpecError(ValueError):
    pass


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Number:
    """A column taken as it is, read as a number by the learners."""

    name: str
    categorical = False

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.name,)

    def column(self, df: DataFrame) -> Column:
        return _col(self.name)


@dataclass(frozen=True)
class Category(Number):
    """A column taken as it is, whose values are levels."""

    categorical = True


_DATE_PARTS = {"hour": hour, "dayofweek": day_of_week, "month": month}


@dataclass(frozen=True)
class DatePart:
    """Hour, weekday (Monday 0) or month of a timestamp, named after the part."""

    name: str
    source: str
    categorical = False

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.source,)

    def column(self, df: DataFrame) -> Column:
        dtype = df.schema[self.source].dataType
        typed = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
        return _DATE_PARTS[self.name](_col(self.source) if typed else parse_timestamp(_col(self.source).cast("string")))


@dataclass(frozen=True)
class Distance:
    """Great-circle distance in km between two points given by four columns."""

    name: str
    sources: tuple[str, str, str, str]
    categorical = False

    @property
    def needs(self) -> tuple[str, ...]:
        return tuple(self.sources)

    def column(self, df: DataFrame) -> Column:
        return haversine_km(*(_col(c).cast("double") for c in self.sources))


Feature = Number | Category | DatePart | Distance
_KINDS = {c.__name__: c for c in (Number, Category, DatePart, Distance)}


def numbers(*names: str) -> tuple[Number, ...]:
    return tuple(Number(n) for n in names)


def categories(*names: str) -> tuple[Category, ...]:
    return tuple(Category(n) for n in names)


def date_parts(source: str) -> tuple[DatePart, ...]:
    return tuple(DatePart(p, source) for p in _DATE_PARTS)


#: The distance between a customer and a merchant (fixed names).
MERCHANT_DISTANCE = Distance("geo_distance_km", ("lat", "long", "merch_lat", "merch_long"))


@dataclass(frozen=True)
class Trees:
    """Boosted trees with a fitted score map; slices are the cuts of train, calibration and test."""

    params: dict = field(default_factory=dict)
    cuts: tuple[float, float] = (0.70, 0.85)
    score_map: str = "auto"


@dataclass(frozen=True)
class Posterior:
    """Bayesian logistic regression; one cut between train and test. ``draws``: posterior draws, 0 for the normal law at the mode."""

    cut: float = 0.8
    interval: float = 0.90
    draws: int = 0


@dataclass(frozen=True)
class JobSpec:
    domain: str
    target: str
    key: str  # unique per row: breaks ties of every order
    features: tuple[Feature, ...]
    time: str | None = None  # rows are split in this order, without it in seeded random order
    learner: Trees | Posterior = field(default_factory=Trees)
    precision: float = 0.9  # wanted at the decision threshold
    psi_limit: float = 0.2
    ks_limit: float = 0.05

    def __post_init__(self) -> None:
        names = [f.name for f in self.features]
        shares = self.learner.cuts if isinstance(self.learner, Trees) else (self.learner.cut, self.learner.interval)
        problems = {
            "domain, target and key must be named": not (self.domain and self.target and self.key),
            "a feature is declared twice": len(set(names)) < len(names),
            "cuts and intervals lie between 0 and 1": not all(0 < s < 1 for s in shares),
            "cuts must rise": isinstance(self.learner, Trees) and self.learner.cuts[0] >= self.learner.cuts[1],
            "precision lies in (0, 1]": not 0 < self.precision <= 1,
            "no such score map": isinstance(self.learner, Trees) and self.learner.score_map not in ("auto", "isotonic", "sigmoid", "identity", "none"),
        }
        found = [text for text, wrong in problems.items() if wrong]
        if found:
            raise SpecError("; ".join(found))

    def names(self, categorical: bool) -> list[str]:
        return [f.name for f in self.features if f.categorical == categorical]

    def to_dict(self) -> dict:
        features = [{"is": type(f).__name__, **asdict(f)} for f in self.features]
        learner = {"is": type(self.learner).__name__, **asdict(self.learner)}
        return {**{k: getattr(self, k) for k in ("domain", "target", "key", "time", "precision", "psi_limit", "ks_limit")}, "features": features, "learner": learner}

    @classmethod
    def from_dict(cls, d: dict) -> JobSpec:
        """Undo ``to_dict`` (also after a trip through JSON)."""
        tupled = lambda x: {k: tuple(v) if isinstance(v, list) else v for k, v in x.items() if k != "is"}
        features = tuple(_KINDS[f["is"]](**tupled(f)) for f in d["features"])
        learner = (Trees if d["learner"]["is"] == "Trees" else Posterior)(**tupled(d["learner"]))
        return cls(**{**d, "features": features, "learner": learner})


#: Paths of a configuration file that a job reads (fixed names); anything else is reported and left out.
_READ = {
    "domain", "target", "columns.datetime", "columns.numeric", "columns.categorical", "columns.key", "model.type", "model.params",
    "model.time_split_column", "model.valid_fraction", "calibration.method", "evaluation.target_precision", "evaluation.ci_level",
    "drift.psi_threshold", "drift.ks_pvalue_threshold",
}


def from_config(raw: dict, key: str | None = None) -> JobSpec:
    """A spec from the nested mapping of a configuration file; unread entries give one warning."""
    flat = {(f"{k}.{sub}" if sub else k): x for k, v in raw.items() for sub, x in (v.items() if isinstance(v, dict) else [("", v)])}
    unread = sorted(set(flat) - _READ)
    if unread:
        warnings.warn(f"not read by any job: {', '.join(unread)}", stacklevel=2)
    kind = flat.get("model.type", "gbt")
    if kind not in ("gbt", "lightgbm", "bayesian"):
        raise SpecError(f"no learner of type {kind!r}")
    held = flat.get("model.valid_fraction")
    if kind == "bayesian":
        learner = Posterior(cut=1 - (held or 0.2), interval=flat.get("evaluation.ci_level", 0.90))
    else:
        cuts = (0.70, 0.85) if held is None else (1 - 2 * held, 1 - held)
        learner = Trees(flat.get("model.params") or {}, cuts, flat.get("calibration.method", "auto"))
    chosen = {f.name: f for f in (*numbers(*flat.get("columns.numeric") or ()), *categories(*flat.get("columns.categorical") or ()))}
    time = flat.get("columns.datetime")
    engineered = (*(date_parts(time) if time else ()), MERCHANT_DISTANCE) if kind != "bayesian" else ()
    return JobSpec(
        flat.get("domain", ""), flat.get("target", ""), key or flat.get("columns.key") or "", (*chosen.values(), *engineered),
        flat.get("model.time_split_column") or time, learner, flat.get("evaluation.target_precision", 0.9),
        flat.get("drift.psi_threshold", 0.2), flat.get("drift.ks_pvalue_threshold", 0.05),
    )
