"""Whole jobs: reports, monthly runs, rebuilds."""
