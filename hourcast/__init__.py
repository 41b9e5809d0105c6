"""hourcast: hourly time-series features and forecasts on Spark DataFrames."""

from .operators.conform import conform, conform_table
from .operators.enrich import star_merge
from .plans.features import build_features
from .plans.forecast import block_recursive_forecast, seasonal_naive
from .plans.model import SideModels, random_search
from .session import build_session, ensure_checkpoint_dir, materialize
from .streaming.incremental import DailyLoop

__all__ = [
    "DailyLoop",
    "SideModels",
    "block_recursive_forecast",
    "build_features",
    "build_session",
    "conform",
    "conform_table",
    "ensure_checkpoint_dir",
    "materialize",
    "random_search",
    "seasonal_naive",
    "star_merge",
]
__version__ = "0.1.0"
