from salesmart.sources.csv_files import read_staging_csv
from salesmart.sources.jdbc import (
    Database,
    Ranges,
    cut_points,
    key_sample,
    measured_ranges,
    read_table,
    text_predicates,
    text_splits,
)
from salesmart.sources.tables import STAR_VIEWS, read_tables, register_views

__all__ = [
    "Database", "Ranges", "STAR_VIEWS", "cut_points", "key_sample", "measured_ranges",
    "text_predicates", "text_splits",
    "read_staging_csv", "read_table", "read_tables", "register_views",
]
