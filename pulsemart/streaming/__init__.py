"""Incremental versions of landing, deduplication, merge, rollup and alerts."""
