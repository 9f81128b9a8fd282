"""Filter choices: machine metadata and the dependent option lists.

The choices cascade: the factory narrows the lines, factory and line narrow
the models, and all three narrow the machines. Each list is the distinct
non-NULL values of one dimension column under the choices before it,
ascending; the "All" entry belongs to the widget, not to the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens import schemas as S
from plantlens.operators.enrich import NO_FILTERS
from plantlens.operators.filters import Filters
from plantlens.tables import Tables

CASCADE = ("factory", "production_line", "model", "machine_id")
METADATA_COLUMNS = CASCADE


def machine_metadata(tables: Tables) -> DataFrame:
    """Distinct (machine, factory, line, model) rows of the dimension."""
    return tables.machines.select(*METADATA_COLUMNS).dropDuplicates()


def option_values(tables: Tables, column: str, filters: Filters = NO_FILTERS) -> DataFrame:
    """Choices for ``column`` given the choices earlier in the cascade."""
    position = CASCADE.index(column)
    machines = tables.machine_copies if tables.machine_copies is not None else tables.machines
    for earlier in CASCADE[:position]:
        value = getattr(filters, earlier)
        if value is not None:
            machines = machines.filter(F.col(earlier) == F.lit(value))
    return (
        machines.select(column)
        .filter(F.col(column).isNotNull())
        .distinct()
        .orderBy(column)
    )


def status_options() -> tuple[str, ...]:
    """The status choices are fixed values, not data."""
    return S.STATUS_VALUES
