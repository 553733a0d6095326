"""Permit and contractor analytics on Spark: lazy DataFrame operators and their registries."""
