"""Terrakern: pixel time series, registries and provenance on Spark DataFrames."""
