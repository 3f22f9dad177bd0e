"""farebox: trip analytics on Spark DataFrames.

Raw trip files and a zone lookup go through a row-level quality gate, zone enrichment,
exact-duplicate removal and derived columns into an enriched trips table; daily, hourly
and vendor rollups and fifteen analytic views are built from it.  Every operator is a
plain ``DataFrame -> DataFrame`` function that Catalyst plans and optimises.
"""

__version__ = "0.1.0"

from .plans.catalog import register_views  # noqa: E402
from .plans.pipeline import enriched_trips, run_pipeline  # noqa: E402
from .sources.trips import read_trips  # noqa: E402
from .sources.zones import read_zones  # noqa: E402
from .streaming.incremental import incremental_load  # noqa: E402

__all__ = [
    "enriched_trips",
    "incremental_load",
    "read_trips",
    "read_zones",
    "register_views",
    "run_pipeline",
]
