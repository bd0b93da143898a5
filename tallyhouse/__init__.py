"""Spark-native retail revenue and retention engine.

Every operator takes DataFrames and returns a DataFrame; nothing here collects
rows to the driver or runs Python code per row.
"""
