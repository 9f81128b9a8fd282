"""The three tables the library works on, as one immutable bundle."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    """Sensor readings, machine dimension and maintenance events.

    The optional members form the aggregate layer (see
    ``plans.curated``); when set, aggregate operators read them instead of
    the row-level tables, which row-level operators (previews, enriched
    rows) always read:

    * ``rollup``: readings pre-aggregated at (machine_id, date, status);
    * ``event_rollup``: events pre-aggregated at (machine_id, event_date,
      maintenance_type);
    * ``machine_copies``: the dimension with identical rows collapsed into
      one row and a ``copies`` count;
    * ``machine_repeats``: machine ids with more than one row (usually none)
      and how many they have.

    ``hot`` names machines with so large a share of all facts that their
    rows are joined apart (``plans.bucketed``); ``hot_is_small`` says that
    the dimension rows of these have been counted and are few.
    """

    sensors: DataFrame
    machines: DataFrame
    maintenance: DataFrame
    rollup: DataFrame | None = None
    event_rollup: DataFrame | None = None
    machine_copies: DataFrame | None = None
    machine_repeats: DataFrame | None = None
    hot: tuple[str, ...] = ()
    hot_is_small: bool = False

    def with_rollup(self, rollup: DataFrame | None) -> "Tables":
        return replace(self, rollup=rollup)

    def with_aggregates(
        self,
        rollup: DataFrame,
        event_rollup: DataFrame,
        machine_copies: DataFrame,
        machine_repeats: DataFrame,
    ) -> "Tables":
        return replace(
            self,
            rollup=rollup,
            event_rollup=event_rollup,
            machine_copies=machine_copies,
            machine_repeats=machine_repeats,
        )

    @property
    def has_aggregates(self) -> bool:
        layer = (self.rollup, self.event_rollup, self.machine_copies, self.machine_repeats)
        return all(x is not None for x in layer)
