"""Paths of the lake."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from skytally.functions import as_utc


@dataclass(frozen=True)
class Lake:
    """Paths of a Bronze / Silver / Gold lake under one root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/flights_raw"

    @property
    def bronze_commits(self) -> str:
        return f"{self.root}/bronze/_commits/flights_raw"

    @property
    def staged_feed(self) -> str:
        return f"{self.root}/staging/flights_feed"

    @property
    def fact(self) -> str:
        return f"{self.root}/silver/fact_flights"

    @property
    def state(self) -> str:
        return f"{self.root}/silver/flight_state"

    @property
    def rollup(self) -> str:
        return f"{self.root}/silver/rollup_flights"

    @property
    def sketches(self) -> str:
        return f"{self.root}/silver/run_sketches"

    def dimension(self, name: str) -> str:
        return f"{self.root}/silver/{name}/_current"

    def gold(self, kpi: str) -> str:
        return f"{self.root}/gold/{kpi}"

    @property
    def run_metrics(self) -> str:
        return f"{self.root}/_logs/metrics"

    @property
    def run_index(self) -> str:
        return f"{self.root}/_logs/metrics_index"

    @property
    def alerts(self) -> str:
        return f"{self.root}/_logs/alerts"

    def quality_report(self, run_ts: datetime) -> str:
        return f"{self.root}/gold/_quality_logs/{as_utc(run_ts):%Y-%m-%d/%H}"
