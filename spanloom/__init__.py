"""Relational and annotated-text analytics on Spark DataFrames."""
