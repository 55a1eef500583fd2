"""Sinks: CSV files, the by-source parquet store, landing, the ingestion ledger, JDBC."""
