"""Landing sources: typed CSV, geometry parsing, test-table adapters."""
