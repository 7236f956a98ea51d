"""Driver-table adapters, the registered query catalog and its SQL oracle."""
