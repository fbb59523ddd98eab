"""Scans and sinks: recursive Parquet scan (S1), layered sinks (S3, S4),
page tables (S2, S5) and the crawl frontier (S9)."""
