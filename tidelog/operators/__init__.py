"""Operators: functions from DataFrames to a DataFrame, lazy unless noted."""
