"""Airline operations analytics on PySpark DataFrames."""
