"""Sources: payload scans, message logs, dimension tables, test-table adapters."""
