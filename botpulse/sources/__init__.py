"""Input registry, schemas, test-data adapter, CSV seed reader and sinks."""

from botpulse.sources.catalog import Tables, normalize_mirror_columns
from botpulse.sources.fixtures import fixture_tables
from botpulse.sources.seed import seed_tags
from botpulse.sources.sinks import read_table, write_table

__all__ = ["Tables", "normalize_mirror_columns", "fixture_tables", "seed_tags", "read_table", "write_table"]
