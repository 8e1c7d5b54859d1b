"""Whole jobs: analysis, reconciliation, snapshots and replay checks."""
