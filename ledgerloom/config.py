"""Settings of the cleaning job: one frozen dataclass per section, read from a dict or JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Missing:
    numeric_strategy: str = "median"      # "mean"; anything else is the median
    categorical_strategy: str = "mode"    # accepted, the mode is always used
    include: tuple[str, ...] = ()         # empty: every column
    exclude: tuple[str, ...] = ()


# Date formats tried when a config names none.
DEFAULT_DATE_FORMATS = (
    "%Y-%m-%d", "%d-%m-%Y", "%d/%m/%Y", "%m/%d/%Y", "%d-%b-%Y",
    "%d %b %Y", "%b %d, %Y", "%Y/%m/%d", "%d.%m.%Y",
)


@dataclass(frozen=True)
class Dates:
    fields: tuple[str, ...] = ()
    target_format: str = "%Y-%m-%d"
    input_formats: tuple[str, ...] = DEFAULT_DATE_FORMATS
    invalid_to_null: bool = False


@dataclass(frozen=True)
class Price:
    fields: tuple[str, ...] = ()
    allow_parentheses_negative: bool = True   # accepted, parentheses always negate
    decimal_places: int = 2
    coerce_invalid_to_null: bool = False


@dataclass(frozen=True)
class Ratings:
    column: str | None = None
    decimal_places: int = 1
    impute_strategy: str | float = "median"   # "mean", "median" or a number


@dataclass(frozen=True)
class Categorical:
    fields: tuple[str, ...] = ()
    lowercase: bool = True
    strip: bool = True
    collapse_spaces: bool = True
    replace_ampersand: bool = True
    mappings: dict[str, dict[str, str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Geo:
    city_field: str | None = None
    canonical_cities: tuple[str, ...] = ()
    city_mappings: dict[str, str] = field(default_factory=dict)
    fuzzy_threshold: float = 0.85


@dataclass(frozen=True)
class Booleans:
    fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class Delivery:
    column: str | None = None
    max_days: int = 30
    clip_max: bool = True


@dataclass(frozen=True)
class Dedup:
    key_fields: tuple[str, ...] = ()
    quantity_field: str | None = None
    strategy: str = "keep_first"              # or "aggregate"


@dataclass(frozen=True)
class Outliers:
    column: str | None = None
    high_factor: float = 50.0
    downscale_candidates: tuple[float, ...] = (10, 100)
    decimal_places: int = 2


@dataclass(frozen=True)
class Payment:
    column: str | None = None
    extra_mappings: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class CleaningConfig:
    missing: Missing = Missing()
    dates: Dates = Dates()
    price: Price = Price()
    ratings: Ratings = Ratings()
    categorical: Categorical = field(default_factory=Categorical)
    geo: Geo = field(default_factory=Geo)
    booleans: Booleans = Booleans()
    delivery: Delivery = Delivery()
    dedup: Dedup = Dedup()
    outliers: Outliers = Outliers()
    payment: Payment = field(default_factory=Payment)

    @classmethod
    def from_dict(cls, sections: dict) -> "CleaningConfig":
        """Absent or empty sections keep their defaults; an unknown key inside a
        section is a ``TypeError``; unknown sections are ignored."""
        built = {}
        for spec in fields(cls):
            given = sections.get(spec.name)
            if given:
                kind = SECTION_TYPES[spec.name]
                built[spec.name] = kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
        return cls(**built)

    @classmethod
    def from_json(cls, path: str) -> "CleaningConfig":
        with open(path, encoding="utf-8") as handle:
            return cls.from_dict(json.load(handle))


SECTION_TYPES = {
    "missing": Missing, "dates": Dates, "price": Price, "ratings": Ratings,
    "categorical": Categorical, "geo": Geo, "booleans": Booleans, "delivery": Delivery,
    "dedup": Dedup, "outliers": Outliers, "payment": Payment,
}
