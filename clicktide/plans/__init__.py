"""Whole jobs: build, incremental refresh, analysis summary."""
