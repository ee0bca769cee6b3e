"""Readers, landing and exports."""
