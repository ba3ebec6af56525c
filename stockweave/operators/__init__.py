"""Reusable relational operators: joins, scans, change capture, data quality."""
