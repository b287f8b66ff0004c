"""Container for the seven input tables of one run."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class HiringTables:
    candidates: DataFrame
    requisitions: DataFrame
    applications: DataFrame
    stage_events_raw: DataFrame
    offers: DataFrame
    hires: DataFrame
    # The FK-clean event table; derived from the raw one when not given.
    stage_events: DataFrame | None = None

    def with_promoted_events(self) -> "HiringTables":
        """Return a copy whose ``stage_events`` is the promoted raw table."""
        if self.stage_events is not None:
            return self
        from hirelens.operators.stages import promote_events

        return replace(self, stage_events=promote_events(self.stage_events_raw, self.applications))

    def as_dict(self) -> dict[str, DataFrame]:
        t = self.with_promoted_events()
        return {
            "candidates": t.candidates,
            "requisitions": t.requisitions,
            "applications": t.applications,
            "stage_events_raw": t.stage_events_raw,
            "stage_events": t.stage_events,
            "offers": t.offers,
            "hires": t.hires,
        }

    def register_views(self, prefix: str = "") -> None:
        """Expose every table as a temp view for SQL users."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)
