"""Mapping collections of requirements onto each other with Spark DataFrames."""
