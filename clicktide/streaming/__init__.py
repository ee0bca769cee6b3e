"""Continuous arrival of day shards."""
