"""Sources: table readers, the retail source model and the test-data adapter."""

from starloom.sources.readers import read_table, read_tables
from starloom.sources.retail import RetailSource, read_retail_source
from starloom.sources.tpch import retail_from_frames, retail_from_tpch

__all__ = ["read_table", "read_tables", "RetailSource", "read_retail_source",
           "retail_from_frames", "retail_from_tpch"]
