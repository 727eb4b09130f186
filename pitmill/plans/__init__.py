"""Helpers that shape how a job runs: shared staging tables and lineage cuts."""
