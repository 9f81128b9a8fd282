"""Property test: on random small star schemas, the aggregate-first operators
(row-level and aggregate-layer paths) equal plain Python loops."""

from __future__ import annotations

from plants import clean_tables, machine, reading
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_bruteforce import by_key, check_health_and_kpis, count_by, enriched

from plantlens.operators import Filters, status_distribution
from plantlens.plans.curated import write_aggregates
from plantlens.session import fresh_dir

IDS = [f"M{i}" for i in range(1, 6)]  # M5 never appears in the dimension

dimension_rows = st.lists(
    st.tuples(st.sampled_from(IDS[:4]), st.sampled_from(["F1", "F2"]), st.sampled_from(["L1", "L2"]),
              st.integers(1, 3)),
    min_size=0, max_size=6,
)
reading_rows = st.lists(
    st.tuples(st.sampled_from(IDS), st.integers(1, 4), st.integers(0, 80),
              st.sampled_from(["OK", "OK", "WARNING", "CRITICAL", None])),
    min_size=0, max_size=40,
)


@settings(max_examples=8, deadline=None, derandomize=True, database=None,
          suppress_health_check=list(HealthCheck))
@given(dims=dimension_rows, reads=reading_rows, filtered=st.booleans())
def test_operators_equal_plain_loops(spark, dims, reads, filtered):
    machines = [machine(m, f, line) for m, f, line, copies in dims for _ in range(copies)]
    sensors = [reading(m, ts=f"2024-01-0{day} 08:00:00", temp=60 + t / 8, status=s)
               for m, day, t, s in reads]
    raw = clean_tables(spark, sensors=sensors, machines=machines)
    layered = write_aggregates(spark, raw, fresh_dir(spark, "test-property"))
    f = Filters(factory="F1") if filtered else Filters()
    for t in (raw, layered):
        check_health_and_kpis(raw, t, f)
        assert by_key(status_distribution(t, f), "status") == count_by(enriched(raw, "sensors", f), "status")
