"""Retail data pipelines and dimensional analytics on Spark DataFrames."""
