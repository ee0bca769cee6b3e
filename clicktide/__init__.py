"""Clickstream analytics for Spark: nested event exports in, warehouse tables and marts out.

Every operator is a plain ``DataFrame -> DataFrame`` function, so they compose
with each other and with any other Spark code.
"""
