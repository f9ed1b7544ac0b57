"""Composite results: Silver, Gold marts, analysis, backtest, ingest, data quality."""
