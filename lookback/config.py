"""Names, locations and business parameters of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


#: Where every run logs its audit rows and publishes its features.
AUDIT_TABLE = "dq_results"


@dataclass(frozen=True)
class PipelineConfig:
    # The field names, which job parameters use.
    # A catalog prefix is only useful where a catalog plugin offers one.
    catalog: str | None = None
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    monitoring_schema: str = "monitoring"
    # Shared folder that holds the schemas; None leaves it to the warehouse setting.
    warehouse: str | None = None

    landing: str = "landing"
    prints_file: str = "prints.json"
    taps_file: str = "taps.json"
    pays_file: str = "pays.csv"
    feature_table: str = "click_features"

    feature_window_days: int = 21
    serving_window_days: int = 7
    # Clock for "not in the future" rules; None means the wall clock.
    as_of: dt.date | None = None
    # What to do with rows that have no user: fail, drop or warn.
    null_user: str = "fail"
    # Decimal places of money. Set: sums are exact fixed point. None: plain doubles.
    amount_scale: int | None = None

    def __post_init__(self) -> None:
        if self.feature_window_days < 1 or self.serving_window_days < 1:
            raise ValueError("window lengths must be at least one day")

    def table(self, layer: str, name: str) -> str:
        """Qualified name of a table; ``layer`` is the field that names its schema, bare."""
        schema = getattr(self, f"{layer}_schema")
        return ".".join(filter(None, (self.catalog, schema, name)))

    def source(self, name: str) -> str:
        """Landing file or folder of ``prints``, ``taps`` or ``pays``."""
        return f"{self.landing}/{getattr(self, name + '_file')}"

    def with_overrides(self, values: Mapping[str, object]) -> PipelineConfig:
        """Apply job parameters; empty values leave the default, unknown names raise."""
        known = {f.name for f in fields(self)}
        unknown = set(values) - known
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **{k: v for k, v in values.items() if v not in (None, "")})
