"""Retail interaction analytics and recommendation on PySpark DataFrames."""
