"""The dashboard's filter set and where each filter applies.

* factory / production line / model: dimension columns. After the left
  join they reject readings of unknown machines, so they are applied to the
  machine dimension and the join becomes an inner join.
* machine: the join key; applied to the facts and to the dimension.
* status: sensor readings only (downtime and cost ignore it).
* date range: sensor ``date`` and maintenance ``event_date``, both bounds
  inclusive, and only when both bounds are given. Machines are never
  date-filtered.

``None`` means "no filter"; the widget sentinel ``"All"`` is accepted too.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlens import schemas as S

# A date bound is a literal date or a scalar-subquery Column (see
# ``resolve_date_range``); ISO text is accepted and parsed.
DateBound = dt.date | Column | None


def _value(v: str | None) -> str | None:
    return None if v is None or v == S.ALL else v


def _day(v: dt.date | Column | str | None) -> DateBound:
    if v is None or isinstance(v, (dt.date, Column)):
        return v
    return dt.date.fromisoformat(str(v))


def _bound(v: dt.date | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


@dataclass(frozen=True, eq=False)
class Filters:
    factory: str | None = None
    production_line: str | None = None
    model: str | None = None
    machine_id: str | None = None
    status: str | None = None
    start_date: DateBound = None
    end_date: DateBound = None
    # The date range is the full range of the readings (resolve_date_range):
    # it keeps every reading, and every event if there are no readings.
    full_range: bool = False

    def __post_init__(self) -> None:
        for name in ("factory", "production_line", "model", "machine_id", "status"):
            object.__setattr__(self, name, _value(getattr(self, name)))
        object.__setattr__(self, "start_date", _day(self.start_date))
        object.__setattr__(self, "end_date", _day(self.end_date))

    # -- variants ------------------------------------------------------------

    def without_status(self) -> "Filters":
        """The health view: every filter except the status filter."""
        return replace(self, status=None)

    # -- what is set -----------------------------------------------------------

    @property
    def dimension_values(self) -> dict[str, str]:
        """Set filters on dimension attributes (not the key)."""
        return {
            c: getattr(self, c)
            for c in S.DIMENSION_FILTER_COLUMNS
            if getattr(self, c) is not None
        }

    @property
    def has_dimension_filter(self) -> bool:
        return bool(self.dimension_values)

    @property
    def has_date_range(self) -> bool:
        return self.start_date is not None and self.end_date is not None

    # -- predicates (None when nothing is filtered) ------------------------------

    def machine_predicate(self) -> Column | None:
        preds = [F.col(c) == F.lit(v) for c, v in self.dimension_values.items()]
        if self.machine_id is not None:
            preds.append(F.col("machine_id") == F.lit(self.machine_id))
        return reduce(and_, preds) if preds else None

    def reading_predicate(self, date_column: str = "date") -> Column | None:
        preds = []
        if self.machine_id is not None:
            preds.append(F.col("machine_id") == F.lit(self.machine_id))
        if self.status is not None:
            preds.append(F.col("status") == F.lit(self.status))
        if self.has_date_range and not self.full_range:
            preds.append(
                F.col(date_column).between(_bound(self.start_date), _bound(self.end_date))
            )
        return reduce(and_, preds) if preds else None

    def event_predicate(self) -> Column | None:
        preds = []
        if self.machine_id is not None:
            preds.append(F.col("machine_id") == F.lit(self.machine_id))
        if self.has_date_range:
            inside = F.col("event_date").between(_bound(self.start_date), _bound(self.end_date))
            preds.append(F.coalesce(inside, F.lit(True)) if self.full_range else inside)
        return reduce(and_, preds) if preds else None


def _where(df: DataFrame, pred: Column | None) -> DataFrame:
    return df if pred is None else df.filter(pred)


def filter_machines(machines: DataFrame, filters: Filters) -> DataFrame:
    return _where(machines, filters.machine_predicate())


def filter_readings(readings: DataFrame, filters: Filters, date_column: str = "date") -> DataFrame:
    """Fact-side filters of the sensor table (or of its rollup)."""
    return _where(readings, filters.reading_predicate(date_column))


def filter_events(maintenance: DataFrame, filters: Filters) -> DataFrame:
    """Fact-side filters of the maintenance table."""
    return _where(maintenance, filters.event_predicate())
