"""Input adapters (test data, warehouse tables) and output sinks."""

from patronage.sources.sinks import write_extract
from patronage.sources.testdata import testdata_tables
from patronage.sources.warehouse import store_tables, warehouse_tables

__all__ = ["store_tables", "testdata_tables", "warehouse_tables", "write_extract"]
