"""Where rows come from."""

from .flat_files import read_calendar_csv, read_flat_dimensions, read_territory_csv
from .tables import CatalogSource, FrameSource, JdbcSource, ParquetSource, Source, read_tables

__all__ = [
    "CatalogSource",
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "Source",
    "read_calendar_csv",
    "read_flat_dimensions",
    "read_tables",
    "read_territory_csv",
]
