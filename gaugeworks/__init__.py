"""Auditable quality metrics over human-evaluated test sets, on Spark DataFrames."""
