"""Keyed-record enrichment and layered batch tables as plain Spark transforms."""
