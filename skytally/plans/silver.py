"""Bronze to Silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skytally.operators.enrich import derive_columns, fill_from_dimensions
from skytally.operators.pick import latest_per_flight


def silver_fact(
    bronze: DataFrame, airports: DataFrame | None = None, airlines: DataFrame | None = None,
    tie_break: Sequence[str] | None = None, stored: bool = False,
) -> DataFrame:
    """One enriched row per flight: its latest observation, filled and with derived columns.

    De-duplication comes first. Filling is row-wise over unique dimension keys, so the result
    is the same, but only surviving rows are joined, and narrower rows are shuffled. ``stored``
    says that ``bronze`` is read from a written table (see ``latest_per_flight``).
    """
    latest = latest_per_flight(bronze, tie_break=tie_break, stored=stored)
    return derive_columns(fill_from_dimensions(latest, airports, airlines))
