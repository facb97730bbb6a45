"""Whole queries: the adapters that shape input tables, and the registered query set."""
