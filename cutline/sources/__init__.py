"""Scans and sinks: CSV trees, document text, tables, exports, JSON logs and the run ledger."""
