"""Hierarchical classification codes on Spark: build, describe, roll up."""
