"""DataFrame operators of the cleansed, summary and mart layers."""
