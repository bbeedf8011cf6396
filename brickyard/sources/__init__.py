"""Sources and sinks: contract CSV, partitioned Parquet layer, dimensions,
and the sales view projected from the star-schema test tables."""
from .contract import FEED_SCHEMA, read_feed_csv, read_feed_csv_inferred, write_feed_csv
from .regions import region_lookup
from .sales import sales_view

__all__ = [
    "FEED_SCHEMA", "read_feed_csv", "read_feed_csv_inferred", "region_lookup",
    "sales_view", "write_feed_csv",
]
