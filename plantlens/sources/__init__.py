"""Sources: CSV and Parquet readers, one loader, and the test-table binding."""

from plantlens.sources import bind, csv, parquet
from plantlens.sources.loader import load, load_cells

__all__ = ["bind", "csv", "load", "load_cells", "parquet"]
