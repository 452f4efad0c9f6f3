"""Composed jobs: the daily reconciliation pipeline and driver-table query plans."""
