"""Point-in-time feature tables and data-quality gates as Spark DataFrame operators."""

from lookback.config import PipelineConfig
from lookback.operators.expectations import (
    DataQualityError,
    Expectation,
    apply_expectations,
)
from lookback.plans.features import compute_features
from lookback.plans.layers import run

__all__ = [
    "PipelineConfig",
    "Expectation",
    "DataQualityError",
    "apply_expectations",
    "compute_features",
    "run",
]
__version__ = "0.1.0"
