"""Payments reporting on Spark: report operators that take DataFrames and parameters and return DataFrames."""
