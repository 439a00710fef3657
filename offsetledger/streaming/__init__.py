"""The ingest: one streaming query from the log to bucketed tables and their commit log."""
